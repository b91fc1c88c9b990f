"""Usage intervals from start and end events, and what stays unresolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import DEFAULT_ZONE, local_date, ntz, seconds_between
from .intervals import coverage_marks, covered_seconds, split_by_day


def pair_events(
    events: DataFrame, device: str = "device_key", app: str = "bundle_id", at: str = "event_at", state: str = "state", key: str = "event_key",
    valid: str | None = "is_valid", block: str = "day",
) -> DataFrame:
    """Usage intervals: each start is closed by the app's next end, or by the device's next start if that comes first.

    Order on a device is (time, ends before starts, key), and only later events count.  An interval closed by its own
    end is observed, by another start inferred; empty ones are dropped.  The look-ahead runs as a look-back over the
    reversed order, whose frame grows row by row, and carries time and key together, so no join follows.

    Windows are as wide as a device's ``block`` of time.  What lies behind it comes from one row for each device and
    block, its first start, and one for each device, app and block, its first end: carried backwards over the blocks,
    the next ones are put behind the block's own events as bounds.  So no task orders a device's whole history.
    """
    rows = events.where(valid) if valid else events
    rows = rows.where(F.col(state).isin("start", "end")).select(
        F.col(key).alias("key"), F.col(device).alias("device"), F.col(app).alias("app"), ntz(at).alias("at"), F.col(state).alias("state"),
        F.date_trunc(block, ntz(at)).cast("timestamp_ntz").alias("block"),
    )
    mark = F.struct("at", "key")
    own = F.struct(F.col("state"), F.when(F.col("state") == "end", F.col("app")).alias("app"), mark.alias("m"))
    awaited = F.when(F.col("state") == "start", F.struct(F.lit("end").alias("state"), "app", F.lit(None).alias("m")))  # an app that starts here waits for its end
    firsts = rows.select("device", "block", F.explode(F.array_compact(F.array(own, awaited))).alias("f"))
    firsts = firsts.groupBy("device", "f.state", "f.app", "block").agg(F.min("f.m").alias("m"))
    behind = Window.partitionBy("device", "state", "app").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    bounds = firsts.withColumn("m", F.last("m", ignorenulls=True).over(behind)).where("m is not null")
    bounds = bounds.select("m.key", "device", "app", "m.at", "state", "block", F.lit(True).alias("bound"))
    rank = F.when(F.col("state") == "end", 0).otherwise(1)
    backwards = [F.desc("at"), rank.desc(), F.desc("key")]
    later = lambda *by: Window.partitionBy(*by).orderBy(*backwards).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("bound", F.lit(False)).unionByName(bounds).select(
        F.col("key").alias("start_event_key"), F.col("device").alias("device_key"), F.col("app").alias("bundle_id"), F.col("at").alias("started_at"), "state", "bound",
        F.last(F.when(F.col("state") == "start", mark), ignorenulls=True).over(later("device", "block")).alias("_start"),
        F.last(F.when(F.col("state") == "end", mark), ignorenulls=True).over(later("device", "block", "app")).alias("_end"),
    )
    own = F.col("_end").isNotNull() & (F.col("_start").isNull() | (F.col("_end.at") <= F.col("_start.at")))
    closing = F.when(own, F.col("_end")).otherwise(F.col("_start"))
    starts = rows.where("state = 'start' and not bound").withColumn("_bound", closing).withColumn("is_inferred", ~own)
    return starts.where("_bound.at > started_at").select(
        "start_event_key", "device_key", "bundle_id", "started_at", F.col("_bound.at").alias("ended_at"),
        seconds_between("started_at", "_bound.at").alias("duration_seconds"), "is_inferred", F.col("_bound.key").alias("boundary_event_key"),
    )


def unresolved_events(events: DataFrame, intervals: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None) -> DataFrame:
    """Valid starts without an interval and valid ends that close no observed one, counted per local day.

    ``intervals`` are those of ``events``.  A start has one interval at most and an end closes one observed interval at
    most (the one of the device's last start before it), so the events are counted and the resolved ones taken off; no
    event meets another.
    """
    by = [*(keys or []), "activity_date"]
    ended = F.when(~F.col("is_inferred"), F.array(local_date("ended_at", zone))).otherwise(F.array().cast("array<date>"))
    resolved = intervals.select(*(keys or []), F.explode(F.concat(F.array(local_date("started_at", zone)), ended)).alias("activity_date"), F.lit(-1).alias("n"))
    both = _counted(events, zone, keys).unionByName(resolved).groupBy(*by).agg(F.sum("n").alias("unresolved_event_count"))
    return both.where("unresolved_event_count > 0")


def _counted(events: DataFrame, zone: str, keys: list[str] | None) -> DataFrame:
    return events.where("is_valid").where("state in ('start', 'end')").select(*(keys or []), local_date("event_at", zone).alias("activity_date"), F.lit(1).alias("n"))


def daily_usage_total(intervals: DataFrame, events: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None, date_from=None, date_to=None) -> DataFrame:
    """Observed, inferred and total seconds per local day, and unresolved events; observed time wins where both overlap.

    ``intervals`` are those of ``events``.  Days with unresolved events only have null seconds; other days without
    events have no row.  Marks of coverage and counts of events go through one aggregate, so pairing is run once.
    Without ``keys`` a day is one group of all devices, so its marks are swept hour by hour.
    """
    by = [*(keys or []), "activity_date"]
    pieces = split_by_day(intervals, "started_at", "ended_at", zone).withColumn("observed", ~F.col("is_inferred"))
    first = F.col("activity_date") == local_date("started_at", zone)
    marks = [F.struct(F.col("activity_date").alias("day"), m["t"].alias("t"), m["d"].alias("d"), m["o"].alias("o"), n.alias("n"))
             for m, n in zip(coverage_marks(), (F.when(first, -1).otherwise(0), F.lit(0)))]
    nothing = [F.lit(None).cast("timestamp_ntz").alias("t"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("o")]
    closing = F.struct(local_date("ended_at", zone).alias("day"), *nothing, F.lit(-1).alias("n"))
    last = F.col("observed") & (F.col("piece_end") == F.col("ended_at"))
    marks = pieces.select(*(keys or []), F.explode(F.array_compact(F.array(*marks, F.when(last, closing)))).alias("m"))
    marks = marks.select(*(keys or []), F.col("m.day").alias("activity_date"), "m.t", "m.d", "m.o", "m.n")
    both = covered_seconds(marks.unionByName(_counted(events, zone, keys).select(*by, *nothing, "n")), by, spread=not keys, unresolved_event_count="n")
    seen = F.coalesce("observed_seconds", F.lit(0.0))
    known = F.col("total_seconds").isNotNull()
    out = both.where(known | (F.col("unresolved_event_count") > 0)).select(
        *by, F.when(known, seen).alias("observed_seconds"), F.when(known, F.col("total_seconds") - seen).alias("inferred_seconds"),
        "total_seconds", "unresolved_event_count",
    )
    if date_from is not None:
        out = out.where(F.col("activity_date") >= F.lit(date_from).cast("date"))
    return out if date_to is None else out.where(F.col("activity_date") < F.lit(date_to).cast("date"))
