"""Streams of landed files into base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sync import adopt_records, adoptable, latest_slots
from ..sources.location import location_points
from ..sources.parts import Parts
from .notify import KEPT, exists

_POINT = (
    "location_point_id string, device_key string, observed_at timestamp_ntz, latitude double, longitude double, accuracy_meters double, "
    "speed_kmh double, motion_activities array<string>, day date, batch int"
)


def stream_location_objects(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Raw location objects as they land."""
    return spark.readStream.schema("object_key string, body string, date date").option("maxFilesPerTrigger", max_files).json(path)


def run_locations(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Objects into ``root``/points by day and batch; a point that is there already is kept, bad objects go to ``root``/failed.

    A point's id holds its time, so a batch meets only the days that it touches, and of those the rows of earlier
    batches; running it again gives the same folders.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = location_points(batch)
        rows.where("reject_reason is not null").select("object_key", "reject_reason").write.mode("overwrite").parquet(f"{root}/failed/batch={batch_id}")
        good = rows.where("reject_reason is null").drop("reject_reason", "object_key").dropDuplicates(["location_point_id"])
        good = good.withColumn("day", F.col("observed_at").cast("date")).withColumn("batch", F.lit(batch_id))
        days = [f"{root}/points/day={r['day']}" for r in good.select("day").distinct().collect()]  # calendar days
        there = [path for path in days if exists(spark, path)]
        if there:
            known = spark.read.schema("location_point_id string, batch int").option("basePath", f"{root}/points").parquet(*there)
            good = good.join(known.where(F.col("batch") < batch_id).select("location_point_id"), "location_point_id", "left_anti")
        good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{root}/points")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_points(spark: SparkSession, root: str) -> DataFrame:
    """The points that ``run_locations`` wrote, with their day and batch; none if nothing landed."""
    return spark.read.schema(_POINT).parquet(f"{root}/points")


def run_usage(
    stream: DataFrame, root: str, checkpoint: str, slot: tuple[str, ...] = ("segment_key", "record_offset"), version: str = "record_metadata_offset", parts: int = 64
) -> StreamingQuery:
    """Usage records into adopted events below ``root``, by hashes of slots and of event keys.

    The latest record of every slot is kept, and by event key what each slot's latest record says, so that the result
    does not depend on how the records were cut into batches.  A batch reads and writes the parts of its own slots, and
    of the events that these slots name or have named; all are published at once, and a batch that runs again publishes
    the same.
    """
    by_slot, by_event = (F.pmod(F.xxhash64(*c), F.lit(parts)).cast("string") for c in (slot, ("event_key",)))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, schema, generation = batch.sparkSession, _ddl(batch), batch_id + 1
        state = Parts(spark, f"{root}/state")
        batch.write.mode("overwrite").parquet(f"{root}/landed-batch")
        records = spark.read.schema(batch.schema).parquet(f"{root}/landed-batch")
        last, slots = state.before(generation), records.select(*slot).distinct()
        slot_parts = [r[0] for r in records.select(by_slot).distinct().collect()]  # at most ``parts``
        known = state.read("slots", schema, last, slot_parts)
        latest = latest_slots(known.unionByName(records), list(slot), version).drop("duplicate_slot")
        state.write("slots", latest, by_slot, generation)
        named = known.join(slots, list(slot), "left_semi").select("event_key").union(records.select("event_key"))
        event_parts = [r[0] for r in named.select(by_event).distinct().collect()]
        others = state.read("claims", schema, last, event_parts).join(slots, list(slot), "left_anti")
        now = latest_slots(latest.join(slots, list(slot), "left_semi"), list(slot), version).where("not duplicate_slot").drop("duplicate_slot")
        state.write("claims", others.unionByName(now.where(adoptable()).select(*batch.columns)), by_event, generation)
        claims = state.written("claims", schema, generation)
        state.write("events", adopt_records(claims, slot, version).withColumn("is_valid", F.lit(True)), by_event, generation)
        state.publish(generation, {"slots": slot_parts, "claims": event_parts, "events": event_parts})
        state.forget(KEPT)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_usage(spark: SparkSession, root: str, records: str) -> DataFrame:
    """The events that ``run_usage`` has adopted so far from records of the schema ``records`` (DDL)."""
    state = Parts(spark, f"{root}/state")
    known = state.generations()
    shape = adopt_records(spark.createDataFrame([], records)).withColumn("is_valid", F.lit(True))
    return state.read("events", _ddl(shape), known[-1] if known else None)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
