"""Change notifications: decoding, grouping into units of work, and the micro-batch drain."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import DEFAULT_ZONE, ceil_minute, floor_minute, ntz
from ..functions.values import reject_if, timestamp_text
from ..operators.intervals import coalesce_intervals, split_windows
from ..sources.parts import Parts

MESSAGE = (
    "message_id bigint, subject_key bigint, data_type string, time_basis string, start_at timestamp_ntz, end_at timestamp_ntz, received_at timestamp_ntz"
)
_INTERVAL = "struct<startTime:string,endTime:string>"
_DELIVERY = (
    "array<struct<data:struct<healthUserId:string,dataType:string,version:string,operation:string,recordId:string,"
    f"intervals:array<struct<physicalTimeInterval:{_INTERVAL},civilIso8601TimeInterval:{_INTERVAL},"
    "civilDateTimeInterval:struct<startDateTime:struct<date:struct<year:int,month:int,day:int>,time:struct<hours:int,minutes:int,seconds:int>>,"
    "endDateTime:struct<date:struct<year:int,month:int,day:int>,time:struct<hours:int,minutes:int,seconds:int>>>>>>>>"
)
MINUTE_TYPES = ("heart-rate",)
KEPT = 8  # generations that readers may still be reading
_KEYS = ("subject_key", "data_type", "time_basis")
_UNIT = "subject_key bigint, data_type string, time_basis string, start_at timestamp_ntz, end_at timestamp_ntz, messages array<bigint>, day date"
_PIECE = "message_id bigint, subject_key bigint, data_type string, time_basis string, start_at timestamp_ntz, end_at timestamp_ntz, day date"


def explode_deliveries(df: DataFrame, body: str = "body") -> DataFrame:
    """A row per interval of every notification of every delivery, with a reject_reason where one can't be used.

    A delivery holds 1 to 99 notifications.  An interval is physical or civil; where several forms are given they must
    agree.  Minute data is rounded outwards to minutes.
    """
    delivered = df.withColumn("_all", F.from_json(body, _DELIVERY)).withColumn("_n", F.size("_all"))
    rows = delivered.select("_n", F.explode_outer("_all").alias("d")).select("_n", "d.data.*").withColumn("i", F.explode_outer("intervals"))

    def civil_text(x: Column) -> Column:
        return F.try_to_timestamp(F.regexp_replace(x, "T", " ")).cast("timestamp_ntz")

    def civil_parts(x: Column) -> Column:
        at = lambda part: F.coalesce(x[f"time"][part], F.lit(0))
        text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", x["date"]["year"], x["date"]["month"], x["date"]["day"], at("hours"), at("minutes"), at("seconds"))
        return F.when(x["date"]["year"].isNotNull(), F.try_to_timestamp(text).cast("timestamp_ntz"))

    p, c, s = F.col("i.physicalTimeInterval"), F.col("i.civilIso8601TimeInterval"), F.col("i.civilDateTimeInterval")
    civil_start, civil_end = civil_text(c["startTime"]), civil_text(c["endTime"])
    parts_start, parts_end = civil_parts(s["startDateTime"]), civil_parts(s["endDateTime"])
    conflict = c.isNotNull() & s.isNotNull() & (~civil_start.eqNullSafe(parts_start) | ~civil_end.eqNullSafe(parts_end))
    start = F.when(p.isNotNull(), timestamp_text(p["startTime"])).otherwise(F.coalesce(civil_start, parts_start))
    end = F.when(p.isNotNull(), timestamp_text(p["endTime"])).otherwise(F.coalesce(civil_end, parts_end))
    minute = F.col("dataType").isin(*MINUTE_TYPES)
    out = rows.select(
        "_n", F.col("healthUserId").alias("subject_key"), F.col("dataType").alias("data_type"), F.col("operation"), F.col("recordId").alias("record_id"),
        F.when(p.isNotNull(), "utc").otherwise("civil").alias("time_basis"), F.when(minute, floor_minute(start)).otherwise(start).alias("start_at"),
        F.when(minute, ceil_minute(end)).otherwise(end).alias("end_at"), F.col("version"), conflict.alias("_conflict"),
    )
    reason = reject_if(
        ("delivery_malformed", F.col("_n").isNull() | (F.col("_n") < 1) | (F.col("_n") > 99)), ("version_unknown", ~F.col("version").eqNullSafe("1")),
        ("operation_unknown", ~F.coalesce(F.col("operation").isin("UPSERT", "DELETE"), F.lit(False))), ("civil_forms_differ", F.col("_conflict")),
        ("interval_malformed", F.col("start_at").isNull() | F.col("end_at").isNull() | (F.col("end_at") <= F.col("start_at"))),
    )
    return out.withColumn("reject_reason", reason).drop("_n", "_conflict", "version")


def reject_future(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): a physical window may not start after it was received."""
    late = (F.col("time_basis") == "utc") & (ntz("start_at") > ntz("received_at"))
    return windows.where(~late), windows.where(late)


def group_notifications(windows: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Units of work: windows cut by day and merged per subject, type, basis and day, with the messages they answer."""
    pieces = split_windows(windows, zone)
    units = pieces.select("subject_key", "data_type", "time_basis", "day", "message_id", F.col("piece_start").alias("start_at"), F.col("piece_end").alias("end_at"))
    return coalesce_intervals(units, ["subject_key", "data_type", "time_basis", "day"], collect="message_id").withColumnRenamed("sources", "messages")


def split_ready(units: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(ready, waiting): a unit waits until the minute in which it ends is complete."""
    until = floor_minute(now.cast("timestamp_ntz"))
    return units.where(F.col("end_at") <= until), units.where(F.col("end_at") > until)


def stream_notifications(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Notification messages as they land, in bounded batches; malformed lines stay in _corrupt_record."""
    return spark.readStream.schema(MESSAGE + ", _corrupt_record string").option("maxFilesPerTrigger", max_files).json(path)


def run_drain(stream: DataFrame, root: str, checkpoint: str, now: str, zone: str = DEFAULT_ZONE) -> StreamingQuery:
    """Drain the available notifications into units below ``root``.

    A batch cuts its messages by day into pieces, puts them to the pieces of the same days, and makes the units of the
    days that it or a waiting unit touches anew: complete ones replace the day's units, days with units that wait are
    noted.  Pieces, units and waiting days are parts by day, published together, so a batch reads and writes touched days
    only, however many came before it.  Units do not depend on how messages fall into batches; a message that lands
    again gives the same pieces and changes nothing, and so does a batch that runs again.  Messages that are malformed,
    lack a field or start after their receipt go to ``rejected``/batch with a reason.  The checkpoint is the
    acknowledgement.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, generation = batch.sparkSession, batch_id + 1
        state = Parts(spark, f"{root}/state")
        last, by_day = state.before(generation), F.col("day").cast("string")
        columns = [c for c in batch.columns if c != "_corrupt_record"]
        lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
        late = (F.col("time_basis") == "utc") & (ntz("start_at") > ntz("received_at"))
        malformed = F.col("_corrupt_record").isNotNull()
        reason = reject_if(("message_malformed", malformed), ("message_incomplete", lacks), ("interval_not_positive", F.col("end_at") <= F.col("start_at")), ("starts_after_receipt", late))
        judged = batch.withColumn("reject_reason", reason)
        judged.where("reject_reason is not null").write.mode("overwrite").parquet(f"{root}/rejected/batch={batch_id}")
        windows = judged.where("reject_reason is null").select(columns)
        own = split_windows(windows, zone).select("message_id", "subject_key", "data_type", "time_basis", F.col("piece_start").alias("start_at"), F.col("piece_end").alias("end_at"), "day")
        came = [r[0] for r in own.select(by_day).distinct().collect()]  # calendar days
        days = sorted({*came, *(r[0] for r in state.read("pending", "day date", last).select(by_day).collect())})
        pieces = state.read("pieces", _PIECE, last, days).unionByName(own).distinct()
        state.write("pieces", pieces, by_day, generation)
        units = coalesce_intervals(state.written("pieces", _PIECE, generation), [*_KEYS, "day"], collect="message_id").withColumnRenamed("sources", "messages")
        ready, waiting = split_ready(units, F.lit(now))
        state.write("units", ready, by_day, generation)
        state.write("pending", waiting.select("day").distinct(), F.lit("all"), generation)
        state.publish(generation, {"pieces": days, "units": days, "pending": ["all"]})
        state.forget(KEPT)
        delay = F.timestamp_diff("MICROSECOND", F.min("received_at"), F.lit(now).cast("timestamp_ntz"))
        windows.agg((delay / 1e6).alias("oldest_lag_seconds"), F.count("*").alias("messages")).write.mode("overwrite").parquet(f"{root}/metrics/batch={batch_id}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_units(spark: SparkSession, root: str) -> DataFrame:
    """The committed units: subject_key, data_type, time_basis, start_at, end_at, messages, day."""
    state = Parts(spark, f"{root}/state")
    known = state.generations()
    return state.read("units", _UNIT, known[-1] if known else None)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def scratch_root(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one; a temporary folder only on a local master without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or 'file://' + tempfile.mkdtemp(prefix='lifespans-')).rstrip('/')}/stream-{uuid.uuid4().hex}"


def drained_units(spark: SparkSession, windows: DataFrame, now: str, again: bool = False, max_files: int = 1000) -> DataFrame:
    """Land ``windows`` as message files, drain them as a stream, and read the committed units back.

    With ``again`` every message lands a second time after the first drain, as a redelivery does.
    """
    root = scratch_root(spark)
    messages = windows.select([F.col(c) for c in ("message_id", "subject_key", "data_type", "time_basis", "start_at", "end_at", "received_at")])
    for _ in range(2 if again else 1):
        messages.write.mode("append").json(f"{root}/landed")
        run_drain(stream_notifications(spark, f"{root}/landed", max_files), root, f"{root}/checkpoint", now).awaitTermination()
    return read_units(spark, root).select("subject_key", "data_type", "time_basis", "day", "start_at", "end_at")
