"""Tables in versioned parts: a change writes the parts that it touches anew, and one small manifest publishes them all."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sync import after_side_by_side, side_by_side

_MANIFEST = "name string, part string, generation bigint"


@dataclass
class Parts:
    """Tables below ``root``, each cut into parts by a column of its own; a generation names a version of every part.

    A version lies in ``root``/name/gen=g/_part=p and never changes.  Generation g is what its manifest lists; it is
    there as soon as the manifest is complete, for all tables at once.  A step that runs again for the same generation
    starts from the one before and writes the same versions, so it may be lost at any point.
    """

    spark: SparkSession
    root: str
    _seen: dict = field(default_factory=dict)

    def generations(self) -> list[int]:
        """The published generations in ascending order."""
        found = []
        for name in _children(self.spark, f"{self.root}/manifest"):
            if name.startswith("gen=") and "_SUCCESS" in _children(self.spark, f"{self.root}/manifest/{name}"):
                found.append(int(name[4:]))
        return sorted(found)

    def before(self, generation: int) -> int | None:
        """The last generation published before ``generation``."""
        return max((g for g in self.generations() if g < generation), default=None)

    def manifest(self, generation: int | None) -> dict[str, dict[str, int]]:
        """Per table, the version of each part; one row a part goes to the driver."""
        if generation is None:
            return {}
        if generation not in self._seen:
            listed: dict[str, dict[str, int]] = {}
            for r in self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifest/gen={generation:012d}").collect():
                listed.setdefault(r["name"], {})[r["part"]] = r["generation"]
            self._seen[generation] = listed
        return self._seen[generation]

    def read(self, name: str, schema: str, generation: int | None, parts: list[str] | None = None) -> DataFrame:
        """A table of a generation, or some parts of it: only their folders are listed and scanned."""
        versions = self.manifest(generation).get(name, {})
        wanted = versions if parts is None else [p for p in parts if p in versions]
        paths = [f"{self.root}/{name}/gen={versions[p]:012d}/_part={p}" for p in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def write(self, name: str, df: DataFrame, part: Column, generation: int) -> None:
        """Write versions of the parts that ``df`` holds; small parts come from one task each, large ones from several."""
        dealt = df.withColumn("_part", part.cast("string")).hint("rebalance", "_part")
        dealt.write.mode("overwrite").partitionBy("_part").parquet(f"{self.root}/{name}/gen={generation:012d}")

    def written(self, name: str, schema: str, generation: int) -> DataFrame:
        """The versions that were written for a generation, published or not."""
        found = [c for c in _children(self.spark, f"{self.root}/{name}/gen={generation:012d}") if c.startswith("_part=")]
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/gen={generation:012d}/{c}" for c in sorted(found)])

    def publish(self, generation: int, touched: dict[str, list[str]]) -> None:
        """Make ``generation``: the one before it, but for the ``touched`` parts, of which those not written are gone."""
        listed = {name: dict(parts) for name, parts in self.manifest(self.before(generation)).items()}
        for name, parts in touched.items():
            own = listed.setdefault(name, {})
            written = {c[6:] for c in _children(self.spark, f"{self.root}/{name}/gen={generation:012d}") if c.startswith("_part=")}
            for p in parts:
                own.pop(p, None)
            own.update(dict.fromkeys(written, generation))
        rows = [(name, p, g) for name, parts in listed.items() for p, g in sorted(parts.items())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/gen={generation:012d}")
        self._seen[generation] = listed

    def forget(self, keep: int = 2) -> None:
        """Delete all generations but the last ``keep``, and the versions that only the others name."""
        known = self.generations()
        kept = [self.manifest(g) for g in known[-keep:]]
        for g in known[:-keep]:
            for name, parts in self.manifest(g).items():
                for p, version in parts.items():
                    if not any(m.get(name, {}).get(p) == version for m in kept):
                        _delete(self.spark, f"{self.root}/{name}/gen={version:012d}/_part={p}")
            _delete(self.spark, f"{self.root}/manifest/gen={g:012d}")


@dataclass
class KeyedTable:
    """Rows by day (or another ``span``) with an index of where each key is: replacing a range reads and writes touched days only."""

    parts: Parts
    schema: str
    key: str
    at: str  # the time that tells a row's day
    keys: tuple[str, ...] = ()  # what a range is of, besides its time
    index_parts: int = 64
    span: str = "day"

    def _part(self, c: str) -> Column:
        return F.date_trunc(self.span, F.col(c)).cast("date").cast("string")

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The rows of the last generation."""
        known = self.parts.generations()
        return self.parts.read("rows", self.schema, known[-1] if known else None, days)

    def changes(self, generation: int) -> DataFrame:
        """key and action of what a generation changed."""
        kind = self.parts.spark.createDataFrame([], self.schema).schema[self.key].dataType.simpleString()
        return self.parts.spark.read.schema(f"`{self.key}` {kind}, action string").parquet(f"{self.parts.root}/changes/gen={generation:012d}")

    def _hash(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.index_parts)).cast("string")

    def reconcile(self, incoming: DataFrame, ranges: DataFrame, generation: int) -> None:
        """Publish ``generation``: completely re-acquired ``ranges`` (keys, start_at, end_at) replaced by ``incoming``.

        Rows in a range that are not incoming go, new keys and rows that differ are written, a key may come in from
        another day or from outside the ranges, identical rows stay; the same acquisition twice changes nothing.  Ranges
        are half-open and within one ``span`` each; rows of a null subject or time are in none.  Of the table, the days of the ranges, of the incoming rows and those where the
        index knows an incoming key are read and written; of the index, the parts of the keys that came or went.
        """
        parts, key, spark = self.parts, self.key, self.parts.spark
        last = parts.before(generation)
        day = self._part
        kind = incoming.schema[key].dataType.simpleString()
        index_schema = f"`{key}` {kind}, day string"
        hashes = [r[0] for r in incoming.select(self._hash(key)).distinct().collect()]  # at most index_parts
        index = parts.read("index", index_schema, last, hashes)
        were = index.join(incoming.select(key), key, "left_semi").select("day")
        days = ranges.select(day("start_at").alias("day")).union(incoming.select(day(self.at))).union(were)
        days = [r[0] for r in days.distinct().collect()]  # calendar days
        current = parts.read("rows", self.schema, last, days)
        by = [*self.keys, "_day"]
        scope = ranges.select(*self.keys, day("start_at").alias("_day"), F.struct("start_at", "end_at").alias("r")).groupBy(*by).agg(F.collect_set("r").alias("_ranges"))
        inside = F.exists("_ranges", lambda r: (F.col(self.at) >= r["start_at"]) & (F.col(self.at) < r["end_at"]))
        marked = current.withColumn("_day", day(self.at)).join(scope, by, "left").select(*current.columns, F.coalesce(inside, F.lit(False)).alias("_in"))
        both = side_by_side(marked, incoming, key, F.col("_in"))
        parts.write("rows", after_side_by_side(both, current, incoming), day(self.at), generation)
        changed = both.where("action in ('insert', 'update', 'delete')").select(F.coalesce(f"r.{key}", f"l.{key}").alias(key), "action")
        changed.write.mode("overwrite").parquet(f"{parts.root}/changes/gen={generation:012d}")
        gone = self.changes(generation).where("action = 'delete'").select(key)
        hashes = sorted(set(hashes) | {r[0] for r in gone.select(self._hash(key)).distinct().collect()})
        kept = parts.read("index", index_schema, last, hashes).join(incoming.select(key).union(gone), key, "left_anti")
        entries = kept.select(key, "day").union(incoming.select(key, day(self.at)))
        parts.write("index", entries, self._hash(key), generation)
        parts.publish(generation, {"rows": days, "index": hashes})


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    system, target = _path(spark, path)
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    system, target = _path(spark, path)
    system.delete(target, True)
