"""Queries of the unit ledger and of stored tables, each with SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.parts import KeyedTable, Parts
from ..streaming import units
from ..streaming.notify import scratch_root
from . import datasets as D

QUERIES: dict = {}


def _query(name: str, sql: str | None):
    def add(run):
        QUERIES[name] = (run, sql)
        return run

    return add


_ROW = "event_id bigint, user_id bigint, ts timestamp_ntz, value double"


def _day() -> Column:
    return F.date_trunc("day", "ts").cast("timestamp_ntz")


def _key(suffix: str = "") -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"), *([F.lit(suffix)] if suffix else []))


_KEY = "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')"


def _units(spark: SparkSession, sf_dir: str, suffix: str = "") -> DataFrame:
    """A unit for every user and day of the events, 100 bytes an event; its place among the user's days."""
    own = D.table(spark, sf_dir, "events").groupBy(_key(suffix).alias("unit_key"), F.col("user_id").cast("string").alias("source"), _day().alias("start_at")).agg((F.count("*") * 100).alias("bytes"))
    place = F.row_number().over(Window.partitionBy("source").orderBy("start_at")) - 1  # a row a day
    return own.select("unit_key", "source", place.cast("long").alias("position"), "start_at", F.timestamp_add("DAY", F.lit(1), F.col("start_at")).alias("end_at"), "bytes")


def _rows(spark: SparkSession, sf_dir: str, suffix: str = "") -> DataFrame:
    e = D.table(spark, sf_dir, "events")
    return e.select(_key(suffix).alias("unit_key"), F.col("event_id").cast("long"), F.col("user_id").cast("long"), F.col("ts").cast("timestamp_ntz"), F.col("value").cast("double"))


def _landed(spark: SparkSession, root: str, new: DataFrame, files: int = 4, at_once: int = 1000) -> DataFrame:
    """The units as a stream of files; how they fall into files has nothing to do with their order."""
    new.repartition(files, F.xxhash64("unit_key")).write.mode("append").parquet(f"{root}/landed")
    return spark.readStream.schema(new.schema).option("maxFilesPerTrigger", at_once).parquet(f"{root}/landed")


def _table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(Parts(spark, f"{root}/table"), _ROW, "event_id", "ts", ("user_id",))


_ALL = 1 << 40


@_query("stream_isolated", f"""WITH u AS (SELECT {_KEY} AS unit_key, bool_or(event_id % 97 = 5) AS bad, bool_or(event_id % 97 = 5 AND event_id % 2 = 1) AS still_bad,
  bool_or((user_id + day(ts)) % 11 = 0) AS part, count(*) AS n FROM events GROUP BY 1)
SELECT unit_key, CASE WHEN still_bad THEN 'failed' ELSE 'done' END AS state, CAST(CASE WHEN bad OR part THEN 2 ELSE 1 END AS INTEGER) AS tries,
  CASE WHEN still_bad THEN 'value_malformed' END AS reason, CASE WHEN still_bad THEN 0 ELSE n END AS n_rows FROM u""")
def stream_isolated(spark, sf_dir):
    """Some units' rows are malformed and some acquisitions incomplete: these fail, all others commit; then some are corrected and tried again."""
    root = scratch_root(spark)
    table, rows = _table(spark, root), _rows(spark, sf_dir)
    bad = F.col("event_id") % 97 == 5
    broken = F.when(bad, "value_malformed")
    all_units = _units(spark, sf_dir)
    part = (F.col("source").cast("long") + F.dayofmonth("start_at")) % 11 == 0
    check, commit = units.acquisition(table, "user_id", all_units.select("unit_key", (~part).alias("complete")), rows.withColumn("reject_reason", broken))
    ledger = units.Ledger(Parts(spark, f"{root}/ledger"), check, commit, all_units.count(), _ALL)
    units.run_units(_landed(spark, root, all_units), ledger, f"{root}/checkpoint").awaitTermination()
    corrected = F.when(bad & (F.col("event_id") % 2 == 1), "value_malformed")
    ledger.check, ledger.commit = units.acquisition(table, "user_id", all_units.select("unit_key", F.lit(True).alias("complete")), rows.withColumn("reject_reason", corrected))
    ledger.work_off()
    done = ledger.done_units().select("unit_key", F.lit("done").alias("state"), "tries", F.lit(None).cast("string").alias("reason"))
    states = done.unionByName(ledger.open_units().select("unit_key", "state", "tries", "reason"))
    n = table.read().groupBy(_key().alias("unit_key")).agg(F.count("*").alias("n_rows"))
    return states.join(n, "unit_key", "left").na.fill(0, ["n_rows"])


@_query("stream_capped", f"SELECT {_KEY} AS unit_key, count(*) * 100 AS bytes, CAST(1 AS INTEGER) AS tries, TRUE AS within_caps FROM events GROUP BY 1")
def stream_capped(spark, sf_dir):
    """Turns of a quarter of the units and a third of the bytes at most; after enough of them all units are done, each once."""
    root, all_units = scratch_root(spark), _units(spark, sf_dir)
    n, size = all_units.agg(F.count("*"), F.sum("bytes")).first()
    nothing = spark.createDataFrame([], "unit_key string, reason string")
    ledger = units.Ledger(Parts(spark, f"{root}/ledger"), lambda taken: nothing, lambda good, generation: None, n // 4 + 1, size // 3 + 1)
    units.run_units(_landed(spark, root, all_units), ledger, f"{root}/checkpoint").awaitTermination()
    ledger.work_off()
    done = ledger.done_units()
    turns = done.groupBy("turn").agg(((F.count("*") <= ledger.max_units) & (F.sum("bytes") <= ledger.max_bytes)).alias("within_caps"))
    return done.join(turns, "turn").select("unit_key", "bytes", "tries", "within_caps")


@_query("stream_ordered", """SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM event_type""")
def stream_ordered(spark, sf_dir):
    """Users' days land in any order, a file a batch; observations are compared with the one before, whatever landed first."""
    root, all_units = scratch_root(spark), _units(spark, sf_dir)
    observed = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz"
    e = D.table(spark, sf_dir, "events")
    rows = e.select(_key().alias("unit_key"), F.col("event_id").cast("long"), F.col("user_id").cast("long"), "event_type", F.col("ts").cast("timestamp_ntz"))
    changes = Parts(spark, f"{root}/changes")
    nothing = spark.createDataFrame([], "unit_key string, reason string")
    commit = units.changes_in_order(changes, rows, ["ts", "event_id"], ["event_type"], observed)
    ledger = units.Ledger(Parts(spark, f"{root}/ledger"), lambda taken: nothing, commit, all_units.count(), _ALL, ordered=True)
    units.run_units(_landed(spark, root, all_units, files=3, at_once=1), ledger, f"{root}/checkpoint").awaitTermination()
    return changes.read("changes", f"source string, {observed}", changes.generations()[-1]).select("event_id", "user_id", "event_type")


_LATE = "day(ts) % 5 = 0"


@_query("stream_repair", f"""SELECT event_id, user_id, ts, value FROM events WHERE NOT ({_LATE}) UNION ALL
SELECT event_id, user_id, ts, CASE WHEN event_id % 4 = 0 THEN value + 1 ELSE value END AS value FROM events WHERE {_LATE} AND event_id % 7 <> 0 UNION ALL
SELECT -event_id, user_id, ts, value FROM events WHERE {_LATE} AND event_id % 9 = 0 AND event_id > 0""")
def stream_repair(spark, sf_dir):
    """Every user's days are acquired once; then every fifth day again, where values have changed, rows are gone and others have come."""
    root = scratch_root(spark)
    table, first, again = _table(spark, root), _units(spark, sf_dir), _units(spark, sf_dir, "late").where(F.dayofmonth("start_at") % 5 == 0)
    late = _rows(spark, sf_dir, "late").where(F.dayofmonth("ts") % 5 == 0)
    changed = late.where("event_id % 7 <> 0").withColumn("value", F.when(F.col("event_id") % 4 == 0, F.col("value") + 1).otherwise(F.col("value")))
    more = late.where("event_id % 9 = 0 and event_id > 0").withColumn("event_id", -F.col("event_id"))
    rows = _rows(spark, sf_dir).unionByName(changed).unionByName(more).withColumn("reject_reason", F.lit(None).cast("string"))
    every = first.select("unit_key").unionByName(again.select("unit_key")).withColumn("complete", F.lit(True))
    check, commit = units.acquisition(table, "user_id", every, rows)
    ledger = units.Ledger(Parts(spark, f"{root}/ledger"), check, commit, first.count() + again.count(), _ALL)
    for new in (first, again):
        units.run_units(_landed(spark, root, new), ledger, f"{root}/checkpoint").awaitTermination()
    return table.read()


_IN = f"o_orderdate >= TIMESTAMP '{D.RANGE[0]}' AND o_orderdate < TIMESTAMP '{D.RANGE[1]}'"


@_query("reconcile_stored", f"""WITH {D.ORDERS_V2}, incoming AS (SELECT o_orderkey, o_totalprice, o_orderdate FROM orders_v2 WHERE {_IN})
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE NOT ({_IN}) AND o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL SELECT * FROM incoming""")
def reconcile_stored(spark, sf_dir):
    """Orders stored by month; a year of them is acquired again and replaced, which touches that year's months and where its keys were."""
    orders = D.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    table = KeyedTable(Parts(spark, f"{scratch_root(spark)}/orders"), schema, "o_orderkey", "o_orderdate", span="month")
    none = spark.createDataFrame([], "start_at timestamp_ntz, end_at timestamp_ntz")
    table.reconcile(orders, none, 1)
    months = spark.sql(f"SELECT CAST(m AS TIMESTAMP_NTZ) AS start_at, CAST(add_months(m, 1) AS TIMESTAMP_NTZ) AS end_at FROM (SELECT explode(sequence(DATE '{D.RANGE[0]}', date_sub(DATE '{D.RANGE[1]}', 1), INTERVAL 1 MONTH)) AS m)")
    inside = D.orders_v2(spark, sf_dir).where(f"o_orderdate >= '{D.RANGE[0]}' and o_orderdate < '{D.RANGE[1]}'")
    table.reconcile(inside.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz")), months, 2)
    return table.read()
