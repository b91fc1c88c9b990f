"""Queries of table maintenance, quality rules and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import finite, reject_if, strict_object
from ..operators import quality, sync
from ..operators.intervals import range_predicate
from . import datasets as D

QUERIES: dict = {}


def _query(name: str, sql: str | None):
    def add(run):
        QUERIES[name] = (run, sql)
        return run

    return add


_IN = f"o_orderdate >= TIMESTAMP '{D.RANGE[0]}' AND o_orderdate < TIMESTAMP '{D.RANGE[1]}'"
_RECONCILE = f"""WITH {D.ORDERS_V2}, incoming AS (SELECT * FROM orders_v2 WHERE {_IN}),
changed AS (SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN 'delete' WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS action
  FROM (SELECT * FROM orders WHERE {_IN} OR o_orderkey IN (SELECT o_orderkey FROM incoming)) o FULL OUTER JOIN incoming n ON n.o_orderkey = o.o_orderkey
  WHERE n.o_orderkey IS NULL OR o.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice OR o.o_orderdate <> n.o_orderdate)"""


def _reconciled(spark, sf_dir):
    inside = range_predicate(*D.RANGE, ts="o_orderdate")
    return sync.reconcile_range(D.table(spark, sf_dir, "orders"), D.orders_v2(spark, sf_dir).where(inside), "o_orderkey", inside)


@_query("reconcile_changes", f"{_RECONCILE} SELECT * FROM changed")
def reconcile_changes(spark, sf_dir):
    return _reconciled(spark, sf_dir)[1]


@_query("reconcile_post", f"""{_RECONCILE} SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed)
UNION ALL SELECT * FROM incoming WHERE o_orderkey IN (SELECT o_orderkey FROM changed)""")
def reconcile_post(spark, sf_dir):
    return _reconciled(spark, sf_dir)[0]


def _lines(spark, sf_dir):
    line = D.table(spark, sf_dir, "lineitem")
    n = F.row_number().over(sync.Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), n.cast("string"))
    return line.select(key.alias("line_key"), F.col("l_orderkey").alias("o_orderkey"), "l_quantity")


_LINES = """lines AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS VARCHAR) AS line_key, l_orderkey AS o_orderkey, l_quantity FROM lineitem)"""


@_query("reconcile_children", f"""{_RECONCILE}, {_LINES}, fresh AS (SELECT line_key, l.o_orderkey, CASE WHEN l.o_orderkey % 10 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
  FROM lines l WHERE l.o_orderkey IN (SELECT o_orderkey FROM incoming)),
scope AS (SELECT o_orderkey FROM incoming UNION SELECT o_orderkey FROM orders WHERE {_IN})
SELECT * FROM lines WHERE o_orderkey NOT IN (SELECT o_orderkey FROM scope) UNION ALL SELECT * FROM fresh""")
def reconcile_children(spark, sf_dir):
    inside = range_predicate(*D.RANGE, ts="o_orderdate")
    incoming = D.orders_v2(spark, sf_dir).where(inside)
    lines = _lines(spark, sf_dir)
    fresh = lines.join(incoming.select("o_orderkey"), "o_orderkey", "left_semi").withColumn(
        "l_quantity", F.when(F.col("o_orderkey") % 10 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    ).select("line_key", "o_orderkey", "l_quantity")
    return sync.reconcile_children(D.table(spark, sf_dir, "orders"), incoming, inside, lines, fresh, "o_orderkey", "line_key")[0]


@_query("upsert_distinct", f"""WITH {D.ORDERS_V2} SELECT n.o_orderkey, 'update' AS action FROM orders_v2 n JOIN orders o ON o.o_orderkey = n.o_orderkey
WHERE o.o_totalprice <> n.o_totalprice OR o.o_orderdate <> n.o_orderdate""")
def upsert_distinct(spark, sf_dir):
    return sync.upsert_distinct(D.table(spark, sf_dir, "orders"), D.orders_v2(spark, sf_dir), "o_orderkey")[1]


_DAILY = """daily AS (SELECT CAST(l_shipdate AS DATE) AS source_date, round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS a_quantity,
  round(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 2) AS n_quantity, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS r_quantity FROM lineitem GROUP BY 1)"""


@_query("patch_columns", f"""WITH {_DAILY}, fresh AS (SELECT source_date, a_quantity * 2 AS a_quantity FROM daily WHERE day(source_date) > 10),
patched AS (SELECT coalesce(d.source_date, f.source_date) AS source_date, CASE WHEN f.source_date IS NOT NULL THEN f.a_quantity WHEN d.source_date >= DATE '1996-01-01'
  AND d.source_date < DATE '1997-01-01' THEN NULL ELSE d.a_quantity END AS a_quantity, n_quantity, r_quantity FROM daily d FULL OUTER JOIN fresh f ON f.source_date = d.source_date)
SELECT * FROM patched WHERE coalesce(a_quantity, n_quantity, r_quantity) IS NOT NULL""")
def patch_columns(spark, sf_dir):
    line = D.table(spark, sf_dir, "lineitem")
    per = [F.round(F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))), 2).alias(f"{f.lower()}_quantity") for f in "ANR"]
    daily = line.groupBy(F.col("l_shipdate").cast("date").alias("source_date")).agg(*per)
    fresh = daily.where(F.dayofmonth("source_date") > 10).select("source_date", (F.col("a_quantity") * 2).alias("a_quantity"))
    inside = range_predicate(*D.RANGE, civil=True)
    return sync.patch_columns(daily, fresh, "source_date", ["a_quantity"], ["a_quantity", "n_quantity", "r_quantity"], inside)


@_query("adopt_records", f"""WITH {D.SLOT_RECORDS}, tops AS (SELECT *, rank() OVER (PARTITION BY segment_key, record_offset ORDER BY record_metadata_offset DESC) AS rk FROM slot_records),
latest AS (SELECT *, count(*) OVER (PARTITION BY segment_key, record_offset) AS claims FROM tops WHERE rk = 1),
events_ AS (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY segment_key DESC, record_offset DESC) AS n FROM latest
  WHERE claims = 1 AND record_state = 'WRITTEN' AND crc_passed IS DISTINCT FROM FALSE AND event_at IS NOT NULL)
SELECT event_key, device_key, bundle_id, event_at, CASE WHEN in_foreground THEN 'start' ELSE 'end' END AS state FROM events_ WHERE n = 1""")
def adopt_records(spark, sf_dir):
    return sync.adopt_records(D.slot_records(spark, sf_dir))


@_query("duplicate_slots", f"""WITH {D.SLOT_RECORDS}, tops AS (SELECT *, rank() OVER (PARTITION BY segment_key, record_offset ORDER BY record_metadata_offset DESC) AS rk FROM slot_records)
SELECT segment_key, record_offset, count(*) AS claims FROM tops WHERE rk = 1 GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_slots(spark, sf_dir):
    latest = sync.latest_slots(D.slot_records(spark, sf_dir), ["segment_key", "record_offset"], "record_metadata_offset")
    return latest.where("duplicate_slot").groupBy("segment_key", "record_offset").agg(F.count("*").alias("claims"))


_REFS = """refs AS (SELECT DISTINCT CAST((user_id + s) * 1000 + dayofyear(ts) AS VARCHAR) AS segment_key, 'k' || CAST(event_id AS VARCHAR) AS event_key
FROM events, (VALUES (0), (1)) v(s) WHERE s = 0 OR event_id % 4 = 0)"""
_CANDIDATES = f"""{_REFS}, sole AS (SELECT event_key, min(segment_key) AS segment_key FROM refs GROUP BY 1 HAVING count(*) = 1),
candidates AS (SELECT segment_key, event_key FROM sole WHERE CAST(segment_key AS BIGINT) % 3 = 0 AND event_key NOT IN (SELECT 'k' || CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error'))"""


def _refs(spark, sf_dir):
    """A segment for each user and day, holding the day's events; every fourth event is in the next user's segment too."""
    users = F.when(F.col("event_id") % 4 == 0, F.array("user_id", F.col("user_id") + 1)).otherwise(F.array("user_id"))
    e = D.table(spark, sf_dir, "events").withColumn("u", F.explode(users))
    return e.select((F.col("u") * 1000 + F.dayofyear("ts")).cast("string").alias("segment_key"), F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("event_key")).distinct()


def _candidates(spark, sf_dir):
    segments = _refs(spark, sf_dir).select("segment_key").distinct()
    before = segments.select("segment_key", F.lit("h").alias("content_sha256"), F.lit("1").alias("parser_version"))
    after = segments.select("segment_key", F.lit("h").alias("content_sha256"), F.when(F.col("segment_key").cast("bigint") % 3 == 0, "2").otherwise("1").alias("parser_version"))
    adopted = D.table(spark, sf_dir, "events").where("event_type = 'error'").select(F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("event_key"))
    return sync.invalidation_candidates(_refs(spark, sf_dir), before, after, adopted)


@_query("invalidation_candidates", f"WITH {_CANDIDATES} SELECT * FROM candidates")
def invalidation_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@_query("invalidate", f"""WITH {_CANDIDATES} SELECT 'k' || CAST(event_id AS VARCHAR) AS event_key, event_id % 17 <> 0 AND 'k' || CAST(event_id AS VARCHAR) NOT IN (SELECT event_key FROM candidates) AS is_valid FROM events""")
def invalidate(spark, sf_dir):
    e = D.table(spark, sf_dir, "events")
    current = e.select(F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("event_key"), (F.col("event_id") % 17 != 0).alias("is_valid"))
    nothing = current.where(F.lit(False))
    return sync.invalidate(current, _candidates(spark, sf_dir), nothing)[0]


@_query("replace_references", f"""WITH {_REFS} SELECT * FROM refs WHERE CAST(segment_key AS BIGINT) % 3 <> 0
UNION SELECT segment_key, event_key || 'x' FROM refs WHERE CAST(segment_key AS BIGINT) % 3 = 0""")
def replace_references(spark, sf_dir):
    refs = _refs(spark, sf_dir)
    again = refs.where(F.col("segment_key").cast("bigint") % 3 == 0)
    return sync.replace_references(refs, again, again.withColumn("event_key", F.concat("event_key", F.lit("x"))))


@_query("load_points", f"""WITH {D.ORDERS_V2} SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL
SELECT * FROM orders_v2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')""")
def load_points(spark, sf_dir):
    current = D.table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return sync.load_points(current, D.orders_v2(spark, sf_dir), "o_orderkey")


@_query("reprocess_points", f"""WITH {D.ORDERS_V2} SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v2) UNION ALL SELECT * FROM orders_v2""")
def reprocess_points(spark, sf_dir):
    return sync.load_points(D.table(spark, sf_dir, "orders"), D.orders_v2(spark, sf_dir), "o_orderkey", reprocess=True)


@_query("check_rows", """SELECT event_id, 'value_small' AS rule FROM events WHERE value < 1 UNION ALL SELECT event_id, 'type_unknown' FROM events WHERE event_type NOT IN ('view', 'click')
UNION ALL SELECT event_id, 'minute_misaligned' FROM events WHERE date_trunc('minute', ts) <> ts""")
def check_rows(spark, sf_dir):
    rules = [
        ("value_small", ~finite(F.col("value")) | (F.col("value") < 1)), ("type_unknown", ~F.col("event_type").isin("view", "click")),
        quality.minute_rules("ts", "value", "value", "value")[0],
    ]
    return quality.check_rows(D.table(spark, sf_dir, "events"), rules, "event_id")


@_query("minute_violations", """WITH m AS (SELECT date_trunc('minute', ts) AS start_at, round(avg(value), 6) AS mean_bpm, min(value) AS min_bpm, max(value) * 0.9 AS max_bpm FROM events GROUP BY 1)
SELECT start_at, 'order' AS rule FROM m WHERE min_bpm > mean_bpm OR mean_bpm > max_bpm""")
def minute_violations(spark, sf_dir):
    from ..operators.rollup import minute_rollup

    m = minute_rollup(D.table(spark, sf_dir, "events"), "ts", "value").withColumn("mean_bpm", F.round("mean_bpm", 6)).withColumn("max_bpm", F.col("max_bpm") * 0.9)
    return quality.check_rows(m, quality.minute_rules(), "start_at")


@_query("check_unique", "SELECT l_orderkey, count(*) AS n, 'duplicate' AS problem FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return quality.check_unique(D.table(spark, sf_dir, "lineitem"), "l_orderkey")


@_query("check_overlap", f"""WITH {D.SLEEP_SESSIONS}, {D.SLEEP_DETAILS} SELECT sleep_session_id, sleep_detail_id FROM (SELECT *, max(end_at) OVER (PARTITION BY sleep_session_id
  ORDER BY start_at, end_at, sleep_detail_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sleep_details) WHERE start_at < reach""")
def check_overlap(spark, sf_dir):
    return quality.check_overlap(D.sleep_details(spark, sf_dir), "sleep_session_id")


@_query("check_inside", f"""WITH {D.SLEEP_SESSIONS}, {D.SLEEP_DETAILS} SELECT d.sleep_session_id, d.sleep_detail_id FROM sleep_details d JOIN sleep_sessions s
  ON s.sleep_session_id = d.sleep_session_id WHERE d.start_at < s.start_at OR d.end_at > s.end_at""")
def check_inside(spark, sf_dir):
    return quality.check_inside(D.sleep_details(spark, sf_dir), D.sleep_sessions(spark, sf_dir), "sleep_session_id")


@_query("check_fk", "SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def check_fk(spark, sf_dir):
    customers = D.table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return quality.check_fk(D.table(spark, sf_dir, "orders"), customers, "o_custkey", "o_orderkey").select("o_orderkey", "o_custkey")


@_query("snapshot_verdict", """WITH rows_ AS (SELECT CAST(ts AS DATE) AS day, event_id % 9000 AS k, value, user_id FROM events),
per AS (SELECT day, k, count(*) AS n, sum(CASE WHEN value < 0.05 THEN 1 ELSE 0 END) AS bad FROM rows_ GROUP BY 1, 2)
SELECT day, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(bad) AS BIGINT) AS broken_rules, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
  sum(bad) = 0 AND max(n) = 1 AS accepted FROM per GROUP BY 1""")
def snapshot_verdict(spark, sf_dir):
    e = D.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date")).withColumn("k", F.col("event_id") % 9000)
    e = e.withColumn("window_start", F.col("day").cast("timestamp_ntz")).withColumn("window_end", F.date_add("day", 1).cast("timestamp_ntz"))
    return quality.snapshot_verdict(e, "day", "k", [("value_small", F.col("value") < 0.05)], ts="ts")


@_query("poison_split", """SELECT event_id, CASE WHEN value < 0.5 THEN 'value_small' WHEN event_type = 'error' THEN 'type_error' END AS reject_reason FROM events
WHERE value < 0.5 OR event_type = 'error'""")
def poison_split(spark, sf_dir):
    reason = reject_if(("json_invalid", ~strict_object(F.col("props"))), ("value_small", F.col("value") < 0.5), ("type_error", F.col("event_type") == "error"))
    return quality.split_poison(D.table(spark, sf_dir, "events"), reason)[1].select("event_id", "reject_reason")


@_query("reconcile_keys", """SELECT coalesce(o.k, l.k) AS order_key, CASE WHEN o.k IS NULL THEN 'orphaned' WHEN l.k IS NULL THEN 'missing' ELSE 'live' END AS status
FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P') o FULL OUTER JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'N') l ON o.k = l.k""")
def reconcile_keys(spark, sf_dir):
    raw = D.table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("order_key"))
    base = D.table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("order_key"))
    return quality.reconcile_keys(raw, base, "order_key")


@_query("settle_orphans", """SELECT coalesce(o.k, l.k) AS order_key, CASE WHEN o.k IS NULL AND l.k IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 1000) THEN 'live'
  WHEN o.k IS NULL THEN 'orphaned' WHEN l.k IS NULL THEN 'missing' ELSE 'live' END AS status
FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P') o FULL OUTER JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'N') l ON o.k = l.k""")
def settle_orphans(spark, sf_dir):
    late = D.table(spark, sf_dir, "orders").where("o_totalprice > 1000").select(F.col("o_orderkey").alias("order_key"))
    return quality.settle_orphans(reconcile_keys(spark, sf_dir), late, "order_key")


@_query("inventory", "SELECT count(*) AS rows, count(DISTINCT user_id) AS user_id_count, count(DISTINCT event_type) AS event_type_count, min(ts) AS first_at, max(ts) AS last_at FROM events")
def inventory(spark, sf_dir):
    return quality.inventory(D.table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


@_query("validate_inventory", """WITH k AS (SELECT CASE WHEN event_type = 'error' THEN 'other/' WHEN event_type = 'view' THEN 'raw/v1/X' ELSE 'raw/v1/' END || CAST(user_id AS VARCHAR) || '/' ||
  CAST(event_id % 3000 AS VARCHAR) AS object_key FROM events)
SELECT object_key, CASE WHEN object_key LIKE 'other%' THEN 'foreign' WHEN object_key LIKE '%X%' THEN 'noncanonical' ELSE 'duplicate' END AS problem FROM k GROUP BY 1
HAVING count(*) > 1 OR object_key LIKE 'other%' OR object_key LIKE '%X%'""")
def validate_inventory(spark, sf_dir):
    prefix = F.when(F.col("event_type") == "error", "other/").when(F.col("event_type") == "view", "raw/v1/X").otherwise("raw/v1/")
    keys = D.table(spark, sf_dir, "events").select(F.concat(prefix, F.col("user_id").cast("string"), F.lit("/"), (F.col("event_id") % 3000).cast("string")).alias("object_key"))
    return quality.validate_inventory(keys, ["raw/v1/"], r"^raw/v1/\d+/\d+$")


@_query("touched_buckets", f"""{_RECONCILE}, after_ AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed) UNION ALL SELECT * FROM incoming WHERE o_orderkey IN (SELECT o_orderkey FROM changed))
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS bucket FROM (SELECT o_orderkey, o_orderdate FROM orders UNION ALL SELECT o_orderkey, o_orderdate FROM after_) WHERE o_orderkey IN (SELECT o_orderkey FROM changed)""")
def touched_buckets(spark, sf_dir):
    post, changes = _reconciled(spark, sf_dir)
    return sync.touched_buckets(changes, D.table(spark, sf_dir, "orders"), post, "o_orderkey", F.date_format("o_orderdate", "yyyy-MM"))
