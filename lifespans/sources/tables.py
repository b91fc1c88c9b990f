"""Base tables as Parquet: explicit schemas, partitioned by a date bucket, replaced bucket by bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import schema

BUCKET_OF = {"health_daily": "source_date", "hrv_sample": "sample_at", "sleep_respiratory_summary": "sample_at", "location_point": "observed_at",
             "iphone_screen_time_event": "event_at", "mac_screen_time_event": "event_at"}
UNBUCKETED = {"app", "profile", "place"}


def read_base(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A base table with its declared columns only."""
    return spark.read.schema(schema(name)).parquet(f"{root}/{name}")


def cast_columns(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in order, cast to the declared types; absent ones are null."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name).fields
    ])


def write_base(df: DataFrame, root: str, name: str, bucket: str = "month") -> None:
    """Write rows; only the month buckets that ``df`` holds are replaced."""
    rows = cast_columns(df, name)
    writer = rows if name in UNBUCKETED else rows.withColumn(bucket, F.date_format(F.trunc(F.col(BUCKET_OF.get(name, "start_at")).cast("date"), "month"), "yyyy-MM"))
    out = writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (out if name in UNBUCKETED else out.partitionBy(bucket)).parquet(f"{root}/{name}")


def publish_generation(spark: SparkSession, root: str, generation: str, tables: dict[str, DataFrame]) -> None:
    """Write tables that belong together below a new folder, then point readers at it by one small file.

    Readers see the old generation or the new one whole; a lost run leaves an unreferenced folder behind.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/generations/{generation}/{name}")
    spark.createDataFrame([(generation,)], "generation string").coalesce(1).write.mode("overwrite").json(f"{root}/current")


def read_generation(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the generation that is current."""
    current = spark.read.schema("generation string").json(f"{root}/current").first()["generation"]
    return spark.read.parquet(f"{root}/generations/{current}/{name}")
