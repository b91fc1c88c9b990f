"""Shared-folder storage: intermediate tables that cut lineage, and byte files that tasks write and range-read.

Everything lies below ``spark.checkpoint.dir``, which all executors share.  Only where that setting is missing
and the master is local (tests) is a temporary folder used.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

SEGMENT_ROWS = 50_000  # rows of an Arrow batch that a task makes itself
_local_base: list[str] = []
_made: list[Scratch] = []


def shared_base(spark: SparkSession) -> str:
    """The shared folder's URI without a trailing slash."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_base:
        _local_base.append("file://" + tempfile.mkdtemp(prefix="lifespans-"))
    return _local_base[0]


def bounded_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Bound the Arrow batches sent to Python tasks by bytes, so that very long texts don't pile up in one batch.

    Tasks also get the folder that the driver imported this package from on their path, whatever their working folder,
    and one thread for numpy's products each: a task has one core, and threads that wait for one another would take more.
    """
    home, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])
    environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


class Scratch:
    """A folder of this run's intermediate tables and files in the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_base(spark)}/lifespans-{name}-{uuid.uuid4().hex}"
        _made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: later steps start from files that survive lost executors."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        """Delete one table, or the whole folder."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def made() -> int:
    """How many scratch folders this driver's operators hold."""
    return len(_made)


def release(since: int = 0) -> None:
    """Delete the scratch folders that this driver's operators have made, from the ``since``-th on: intermediate tables, shards, files.

    Results that have not been read yet are computed from them, so call it when those are read or written elsewhere.
    """
    while len(_made) > since:
        _made.pop().drop()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for use inside tasks."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


class FileWriter:
    """A file that appears under its name only when it is closed; what is written goes out as it comes.

    A task that runs again writes the same bytes under the same name, so retries and speculation are harmless.
    """

    def __init__(self, uri: str):
        self.system, self.path = open_fs(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part, self.size = f"{self.path}.{uuid.uuid4().hex}.tmp", 0
        self.out = self.system.open_output_stream(self.part)

    def write(self, chunk: bytes) -> None:
        self.out.write(chunk)
        self.size += len(chunk)

    def close(self) -> int:
        """Give the file its name; the bytes written."""
        self.out.close()
        self.system.move(self.part, self.path)
        return self.size


def write_file(uri: str, chunks) -> int:
    """Write the byte chunks to a file that appears under its name only when complete; the bytes written."""
    writer = FileWriter(uri)
    for chunk in chunks:
        writer.write(chunk)
    return writer.close()
