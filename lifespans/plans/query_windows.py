"""Queries of request windows, notifications and their streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals, rollup
from ..streaming import notify
from . import datasets as D

QUERIES: dict = {}


def _query(name: str, sql: str | None):
    def add(run):
        QUERIES[name] = (run, sql)
        return run

    return add


def _merged(keys: str, source: str, name: str) -> str:
    """SQL that merges overlapping or touching windows of ``source`` per ``keys`` into ``name``."""
    return f"""{name}_reach AS (SELECT *, max(end_at) OVER (PARTITION BY {keys} ORDER BY start_at, end_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM {source}),
{name}_marked AS (SELECT *, sum(CASE WHEN r >= start_at THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY start_at, end_at ROWS UNBOUNDED PRECEDING) AS island FROM {name}_reach),
{name} AS (SELECT {keys}, island, min(start_at) AS start_at, max(end_at) AS end_at, list_sort(list_distinct(list(message_id))) AS sources FROM {name}_marked GROUP BY {keys}, island)"""


_SPLIT = f"""{D.WINDOWS}, zoned AS (SELECT *, CASE time_basis WHEN 'civil' THEN INTERVAL 0 HOUR ELSE INTERVAL 9 HOUR END AS z FROM windows),
pieces AS (SELECT w.*, g.d AS day, greatest(w.start_at, g.d::TIMESTAMP - w.z) AS piece_start, least(w.end_at, g.d::TIMESTAMP + INTERVAL 1 DAY - w.z) AS piece_end FROM zoned w,
  LATERAL (SELECT CAST(unnest(generate_series(date_trunc('day', w.start_at + w.z), date_trunc('day', w.end_at + w.z - INTERVAL 1 MICROSECOND), INTERVAL 1 DAY)) AS DATE) AS d) g)"""


@_query("merge_windows", f"""WITH {D.WINDOWS}, {_merged('data_type, time_basis', 'windows', 'm')}
SELECT data_type, time_basis, start_at, end_at, CAST(len(sources) AS INTEGER) AS n_sources FROM m""")
def merge_windows(spark, sf_dir):
    merged = intervals.merge_windows(D.windows(spark, sf_dir), collect="message_id")
    return merged.select("data_type", "time_basis", "start_at", "end_at", F.size("sources").alias("n_sources"))


@_query("split_windows", f"WITH {_SPLIT} SELECT message_id, day, piece_start, piece_end FROM pieces")
def split_windows(spark, sf_dir):
    return intervals.split_windows(D.windows(spark, sf_dir)).select("message_id", "day", "piece_start", "piece_end")


@_query("expand_days", f"""WITH {_SPLIT} SELECT DISTINCT data_type, time_basis, day, day::TIMESTAMP - z AS start_at, day::TIMESTAMP + INTERVAL 1 DAY - z AS end_at FROM pieces""")
def expand_days(spark, sf_dir):
    return intervals.expand_to_days(D.windows(spark, sf_dir))


@_query("chunk_windows", """WITH spans AS (SELECT user_id, min(ts) AS start_at, max(ts) AS end_at FROM events GROUP BY 1),
cut AS (SELECT *, unnest(generate_series(0, CAST(ceil(datediff('microsecond', start_at, end_at) / 432000000000.0) AS BIGINT) - 1)) AS chunk FROM spans WHERE end_at > start_at)
SELECT user_id, CAST(chunk AS INTEGER) AS chunk, start_at + to_days(CAST(chunk * 5 AS INTEGER)) AS chunk_start, least(end_at, start_at + to_days(CAST(chunk * 5 + 5 AS INTEGER))) AS chunk_end FROM cut""")
def chunk_windows(spark, sf_dir):
    spans = D.table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("start_at"), F.max("ts").alias("end_at"))
    return intervals.chunk_windows(spans, 5).select("user_id", "chunk", "chunk_start", "chunk_end")


@_query("round_windows", """WITH w AS (SELECT event_id, ts AS a, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS z FROM events),
i AS (SELECT event_id, 'inward' AS mode, CASE WHEN date_trunc('minute', a) = a THEN a ELSE date_trunc('minute', a) + INTERVAL 1 MINUTE END AS start_at, date_trunc('minute', z) AS end_at FROM w),
o AS (SELECT event_id, 'outward' AS mode, date_trunc('minute', a) AS start_at, CASE WHEN date_trunc('minute', z) = z THEN z ELSE date_trunc('minute', z) + INTERVAL 1 MINUTE END AS end_at FROM w)
SELECT * FROM i WHERE end_at > start_at UNION ALL SELECT * FROM o WHERE end_at > start_at""")
def round_windows(spark, sf_dir):
    e = D.table(spark, sf_dir, "events")
    w = e.select("event_id", F.col("ts").alias("start_at"), F.timestamp_add("MINUTE", F.floor("value"), F.col("ts")).alias("end_at"))
    both = [intervals.round_window(w, mode).select("event_id", F.lit(mode).alias("mode"), "start_at", "end_at") for mode in ("inward", "outward")]
    return both[0].unionByName(both[1])


@_query("civil_envelope", f"WITH {D.WINDOWS} SELECT message_id, start_at - INTERVAL 18 HOUR AS start_at, end_at + INTERVAL 18 HOUR AS end_at FROM windows")
def civil_envelope(spark, sf_dir):
    return intervals.civil_envelope(D.windows(spark, sf_dir)).select("message_id", "start_at", "end_at")


_GROUPED = f"""WITH {_SPLIT}, units AS (SELECT subject_key, data_type, time_basis, day, message_id, piece_start AS start_at, piece_end AS end_at FROM pieces),
{_merged('subject_key, data_type, time_basis, day', 'units', 'g')}"""


@_query("group_notifications", f"{_GROUPED} SELECT subject_key, data_type, time_basis, day, start_at, end_at, CAST(len(sources) AS INTEGER) AS n_messages FROM g")
def group_notifications(spark, sf_dir):
    units = notify.group_notifications(D.windows(spark, sf_dir))
    return units.select("subject_key", "data_type", "time_basis", "day", "start_at", "end_at", F.size("messages").alias("n_messages"))


_NOW = "2024-01-29 12:00:00"


@_query("acknowledged", f"""{_GROUPED}, parts AS (SELECT unnest(sources) AS message_id, end_at <= TIMESTAMP '{_NOW}' AS done FROM g)
SELECT message_id, bool_and(done) AS acknowledged, count(*) AS units FROM parts GROUP BY 1""")
def acknowledged(spark, sf_dir):
    ready, waiting = notify.split_ready(notify.group_notifications(D.windows(spark, sf_dir)), F.lit(_NOW))
    units = ready.withColumn("committed", F.lit(True)).unionByName(waiting.withColumn("committed", F.lit(False)))
    return rollup.all_done(units.select(F.explode("messages").alias("message_id"), "committed"), "message_id", "committed")


@_query("batch_summary", f"""{_GROUPED} SELECT count(*) FILTER (WHERE end_at <= TIMESTAMP '{_NOW}') AS ready, count(*) FILTER (WHERE end_at > TIMESTAMP '{_NOW}') AS deferred FROM g""")
def batch_summary(spark, sf_dir):
    ready, waiting = notify.split_ready(notify.group_notifications(D.windows(spark, sf_dir)), F.lit(_NOW))
    both = ready.select(F.lit("ready").alias("status")).unionByName(waiting.select(F.lit("deferred").alias("status")))
    return rollup.status_counts(both, "status", ["ready", "deferred"])


@_query("explode_deliveries", f"""WITH {D.WINDOWS} SELECT subject_key, data_type, start_at, end_at FROM windows WHERE time_basis = 'utc'
UNION ALL SELECT subject_key, data_type, start_at, end_at FROM windows WHERE time_basis = 'civil'""")
def explode_deliveries(spark, sf_dir):
    w = D.windows(spark, sf_dir)
    text = lambda c: F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")
    physical = F.struct(F.concat(text("start_at"), F.lit("Z")).alias("startTime"), F.concat(text("end_at"), F.lit("Z")).alias("endTime"))
    civil = F.struct(text("start_at").alias("startTime"), text("end_at").alias("endTime"))
    one = F.struct(F.when(F.col("time_basis") == "utc", physical).alias("physicalTimeInterval"), F.when(F.col("time_basis") == "civil", civil).alias("civilIso8601TimeInterval"))
    data = F.struct(F.col("subject_key").cast("string").alias("healthUserId"), F.col("data_type").alias("dataType"), F.lit("1").alias("version"), F.lit("UPSERT").alias("operation"), F.array(one).alias("intervals"))
    body = w.select(F.to_json(F.array(F.struct(data.alias("data")))).alias("body"))
    out = notify.explode_deliveries(body)
    return out.where("reject_reason is null").select(F.col("subject_key").cast("bigint").alias("subject_key"), "data_type", "start_at", "end_at")


@_query("stream_drain", f"{_GROUPED} SELECT subject_key, data_type, time_basis, day, start_at, end_at FROM g WHERE end_at <= TIMESTAMP '{_NOW}'")
def stream_drain(spark, sf_dir):
    """The notifications as a stream of files: every unit that is complete by then, once, from the result table."""
    return notify.drained_units(spark, D.windows(spark, sf_dir), _NOW)


@_query("stream_redelivery", f"{_GROUPED} SELECT subject_key, data_type, time_basis, day, start_at, end_at FROM g WHERE end_at <= TIMESTAMP '{_NOW}'")
def stream_redelivery(spark, sf_dir):
    """Every message lands twice, in two drains; the units are those of one delivery."""
    return notify.drained_units(spark, D.windows(spark, sf_dir), _NOW, again=True)
