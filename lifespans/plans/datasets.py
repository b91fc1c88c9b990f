"""Operator inputs derived from the events, orders and lineitem tables, each with the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import add_micros, micros_between


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device per user, two apps; times cut to the hour, so that ties occur; some events are invalid."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lpad(F.col("event_id").cast("string"), 10, "0").alias("event_key"), F.concat(F.lit("d"), "user_id").alias("device_key"),
        F.concat(F.lit("a"), ((F.col("user_id") + F.col("event_id")) % 2).cast("string")).alias("bundle_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("event_at"),
        F.when(F.col("event_type").isin("view", "click", "signup"), "start").otherwise("end").alias("state"), (F.col("event_id") % 17 != 0).alias("is_valid"),
    )


USAGE_EVENTS = """usage_events AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS event_key, 'd' || CAST(user_id AS VARCHAR) AS device_key,
    'a' || CAST((user_id + event_id) % 2 AS VARCHAR) AS bundle_id, date_trunc('hour', ts) AS event_at,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'start' ELSE 'end' END AS state, event_id % 17 <> 0 AS is_valid
  FROM events)"""

_ZONE = {"view": "FAT_BURN", "click": "Cardio", "signup": "peak", "purchase": "heart_rate_zone_unspecified"}


def timed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step and zone intervals: from ts for value minutes."""
    e = table(spark, sf_dir, "events")
    seconds = F.greatest(F.lit(1), F.floor(F.col("value") * 60)).cast("long")
    category = F.lit("mystery")
    for kind, zone in _ZONE.items():
        category = F.when(F.col("event_type") == kind, zone).otherwise(category)
    return e.select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").alias("start_at"), add_micros("ts", seconds * 1_000_000).alias("end_at"),
        (F.col("event_id") % 500).cast("double").alias("steps"), (F.col("event_id") % 90).cast("double").alias("active_zone_minutes"), category.alias("category"),
    )


TIMED_VALUES = """timed_values AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS start_at, ts + to_seconds(CAST(greatest(1, floor(value * 60)) AS BIGINT)) AS end_at,
    CAST(event_id % 500 AS DOUBLE) AS steps, CAST(event_id % 90 AS DOUBLE) AS active_zone_minutes,
    CASE event_type WHEN 'view' THEN 'FAT_BURN' WHEN 'click' THEN 'Cardio' WHEN 'signup' THEN 'peak'
      WHEN 'purchase' THEN 'heart_rate_zone_unspecified' ELSE 'mystery' END AS category
  FROM events)"""

DAY_PIECES = """day_pieces AS (
  SELECT v.*, g.d AS activity_date, greatest(v.start_at, g.d::TIMESTAMP - INTERVAL 9 HOUR) AS piece_start,
    least(v.end_at, g.d::TIMESTAMP + INTERVAL 15 HOUR) AS piece_end,
    CAST(v.start_at + INTERVAL 9 HOUR AS DATE) <> CAST(v.end_at + INTERVAL 9 HOUR - INTERVAL 1 MICROSECOND AS DATE) AS prorated
  FROM timed_values v, LATERAL (SELECT CAST(unnest(generate_series(date_trunc('day', v.start_at + INTERVAL 9 HOUR),
    date_trunc('day', v.end_at + INTERVAL 9 HOUR - INTERVAL 1 MICROSECOND), INTERVAL 1 DAY)) AS DATE) AS d) g)"""


def sleep_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session an event: main, nap or unknown by type; some minutes are unknown."""
    e = table(spark, sf_dir, "events")
    main = F.when(F.col("event_type").isin("view", "click"), True).when(F.col("event_type").isin("signup", "purchase"), False)
    return e.select(
        F.lpad(F.col("event_id").cast("string"), 10, "0").alias("sleep_session_id"), F.col("user_id"), F.col("ts").alias("start_at"),
        add_micros("ts", (F.greatest(F.lit(1), F.floor(F.col("value"))) * 60_000_000).cast("long")).alias("end_at"),
        F.when(F.col("event_id") % 7 != 0, F.floor(F.col("value")).cast("double")).alias("sleep_minutes"),
        (F.col("event_id") % 11).cast("double").alias("awake_minutes"), main.alias("is_main_sleep"),
    )


SLEEP_SESSIONS = """sleep_sessions AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS sleep_session_id, user_id, ts AS start_at,
    ts + to_minutes(CAST(greatest(1, floor(value)) AS BIGINT)) AS end_at,
    CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value) AS DOUBLE) END AS sleep_minutes, CAST(event_id % 11 AS DOUBLE) AS awake_minutes,
    CASE WHEN event_type IN ('view', 'click') THEN TRUE WHEN event_type IN ('signup', 'purchase') THEN FALSE END AS is_main_sleep
  FROM events)"""


def sleep_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three details a session: the first two overlap, the third touches the second; the last may reach past the session."""
    s = sleep_sessions(spark, sf_dir)
    quarter = F.floor(micros_between("start_at", "end_at") / 4).cast("long")
    k = s.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(3)))).withColumn("_q", quarter)
    category = F.element_at(F.array(F.lit("light"), F.lit("deep"), F.lit(None).cast("string")), (F.col("sleep_session_id").cast("long") % 3 + 1).cast("int"))
    return k.select(
        F.concat_ws("-", "sleep_session_id", F.col("k").cast("string")).alias("sleep_detail_id"), "sleep_session_id", F.lit("stage").alias("kind"),
        add_micros("start_at", F.col("_q") * F.col("k")).alias("start_at"), add_micros("start_at", F.col("_q") * (F.col("k") + 2)).alias("end_at"),
        category.alias("category"),
    )


SLEEP_DETAILS = """sleep_details AS (
  SELECT s.sleep_session_id || '-' || CAST(k.k AS VARCHAR) AS sleep_detail_id, s.sleep_session_id, 'stage' AS kind,
    s.start_at + to_microseconds(q * k.k) AS start_at, s.start_at + to_microseconds(q * (k.k + 2)) AS end_at,
    CASE CAST(s.sleep_session_id AS BIGINT) % 3 WHEN 0 THEN 'light' WHEN 1 THEN 'deep' END AS category
  FROM (SELECT *, datediff('microsecond', start_at, end_at) // 4 AS q FROM sleep_sessions) s, (VALUES (0), (1), (3)) k(k))"""


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request window an event: from its minute for value minutes, UTC or civil by user."""
    e = table(spark, sf_dir, "events")
    start = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return e.select(
        F.col("event_id").alias("message_id"), F.col("event_type").alias("data_type"), F.when(F.col("user_id") % 2 == 0, "utc").otherwise("civil").alias("time_basis"),
        F.col("user_id").alias("subject_key"), start.alias("start_at"), add_micros(start, (F.greatest(F.lit(1), F.ceil("value")) * 60_000_000).cast("long")).alias("end_at"),
        F.col("ts").alias("received_at"),
    )


WINDOWS = """windows AS (
  SELECT event_id AS message_id, event_type AS data_type, CASE WHEN user_id % 2 = 0 THEN 'utc' ELSE 'civil' END AS time_basis, user_id AS subject_key,
    date_trunc('minute', ts) AS start_at, date_trunc('minute', ts) + to_minutes(CAST(greatest(1, ceil(value)) AS BIGINT)) AS end_at, ts AS received_at
  FROM events)"""

RANGE = ("1996-01-01", "1997-01-01")


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as acquired again: some prices changed, some orders gone, some moved by a day."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 13 <> 0")
    key = F.col("o_orderkey")
    return o.withColumn("o_totalprice", F.when(key % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn(
        "o_orderdate", F.when(key % 29 == 0, add_micros("o_orderdate", 86_400_000_000)).otherwise(F.col("o_orderdate"))
    )


ORDERS_V2 = """orders_v2 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 29 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 13 <> 0)"""


def slot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in slots: a segment an order, slots by part, versions by line number."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("segment_key"), (F.col("l_partkey") % 3).alias("record_offset"), F.col("l_linenumber").alias("record_metadata_offset"),
        F.concat(F.lit("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber") % 4).cast("string")).alias("event_key"),
        F.concat(F.lit("d"), (F.col("l_suppkey") % 50).cast("string")).alias("device_key"), F.concat(F.lit("a"), (F.col("l_partkey") % 20).cast("string")).alias("bundle_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_at"), F.when(F.col("l_linestatus") == "O", "WRITTEN").otherwise("DELETED").alias("record_state"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity") > 25).alias("crc_passed"), F.lit("event").alias("record_kind"), (F.col("l_quantity") % 2 == 0).alias("in_foreground"),
    )


SLOT_RECORDS = """slot_records AS (
  SELECT l_orderkey AS segment_key, l_partkey % 3 AS record_offset, l_linenumber AS record_metadata_offset,
    'k' || CAST(l_orderkey * 10 + l_linenumber % 4 AS VARCHAR) AS event_key, 'd' || CAST(l_suppkey % 50 AS VARCHAR) AS device_key,
    'a' || CAST(l_partkey % 20 AS VARCHAR) AS bundle_id, l_shipdate AS event_at, CASE WHEN l_linestatus = 'O' THEN 'WRITTEN' ELSE 'DELETED' END AS record_state,
    CASE WHEN l_returnflag = 'R' THEN l_quantity > 25 END AS crc_passed, 'event' AS record_kind, l_quantity % 2 = 0 AS in_foreground
  FROM lineitem)"""
