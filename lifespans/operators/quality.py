"""Row rules, cross-row rules, reconciliation of keys, inventories.  Results are rows, never exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import floor_minute, ntz
from ..functions.values import finite

Rules = list[tuple[str, Column]]


def interval_rules(start: str = "start_at", end: str = "end_at") -> Rules:
    return [("start_missing", F.col(start).isNull()), ("end_missing", F.col(end).isNull()), ("interval_not_positive", ntz(end) <= ntz(start))]


def measure_rules(*columns: str) -> Rules:
    return [(f"{c}_invalid", ~finite(F.col(c)) | (F.col(c) < 0)) for c in columns]


def minute_rules(ts: str = "start_at", low: str = "min_bpm", mean: str = "mean_bpm", high: str = "max_bpm") -> Rules:
    return [
        ("minute_misaligned", floor_minute(ts) != ntz(ts)),
        ("order", (F.col(low) > F.col(mean)) | (F.col(mean) > F.col(high))),
        *[(f"{c}_missing", F.col(c).isNull()) for c in (low, mean, high)],
    ]


def location_rules(lat: str = "latitude", lon: str = "longitude") -> Rules:
    return [
        ("latitude_invalid", F.col(lat).isNull() | ~F.col(lat).between(-90, 90)),
        ("longitude_invalid", F.col(lon).isNull() | ~F.col(lon).between(-180, 180)),
    ]


def state_rules(state: str = "state", allowed: tuple[str, ...] = ("start", "end")) -> Rules:
    return [("state_unknown", F.col(state).isNull() | ~F.col(state).isin(*allowed))]


def health_rules() -> Rules:
    """Daily metrics: percentages and VO2 up to 100, none below zero; temperatures and signal-to-noise may be negative."""
    percent = ["spo2_average_percent", "spo2_lower_bound_percent", "spo2_upper_bound_percent", "spo2_standard_deviation_percent"]
    return [
        *measure_rules("resting_heart_rate_bpm", "hrv_rmssd_ms", "respiratory_rate_breaths_per_minute", "vo2_max_ml_kg_min"),
        *[(f"{c}_range", ~finite(F.col(c)) | ~F.col(c).between(0, 100)) for c in percent],
        ("vo2_max_range", F.col("vo2_max_ml_kg_min") > 100),
    ]


def hrv_rules() -> Rules:
    return [("hrv_empty", F.col("rmssd_ms").isNull() & F.col("sdnn_ms").isNull()), *measure_rules("rmssd_ms", "sdnn_ms")]


def check_rows(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """A row for each rule that a row breaks: key, rule.  An unknown result breaks nothing."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Null keys and keys of several rows: key, n, problem."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    problem = F.when(F.col(key).isNull(), "null").when(F.col("n") > 1, "duplicate")
    return counts.withColumn("problem", problem).where("problem is not null")


def check_overlap(df: DataFrame, parent: str, start: str = "start_at", end: str = "end_at", key: str = "sleep_detail_id") -> DataFrame:
    """Children of a parent that start before an earlier one has ended."""
    w = Window.partitionBy(parent).orderBy(start, end, key).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_reach", F.max(end).over(w)).where(F.col(start) < F.col("_reach")).select(parent, key)


def check_inside(children: DataFrame, parents: DataFrame, parent: str, start: str = "start_at", end: str = "end_at", key: str = "sleep_detail_id") -> DataFrame:
    """Children that reach beyond their parent."""
    span = parents.select(parent, F.col(start).alias("_from"), F.col(end).alias("_to"))
    return children.join(span, parent).where((F.col(start) < F.col("_from")) | (F.col(end) > F.col("_to"))).select(parent, key)


def check_fk(children: DataFrame, parents: DataFrame, parent: str, key: str) -> DataFrame:
    """Children without a parent row."""
    return children.join(parents.select(parent), parent, "left_anti").select(parent, key)


def snapshot_verdict(rows: DataFrame, window: str, key: str, rules: Rules, ts: str = "start_at", start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Per window, whether its snapshot may be applied: one malformed, duplicate or outlying row rejects it all."""
    outlying = (ntz(ts) < ntz(start)) | (ntz(ts) >= ntz(end))
    bad = F.array_distinct(F.filter(F.array(*[F.when(x, F.lit(n)) for n, x in [*rules, ("outside_window", outlying)]]), lambda x: x.isNotNull()))
    marked = rows.select(window, F.col(key).alias("_key"), bad.alias("_bad"))
    per_key = marked.groupBy(window, "_key").agg(F.count("*").alias("_n"), F.sum(F.size("_bad")).alias("_broken"))
    return per_key.groupBy(window).agg(
        F.sum("_n").alias("rows"), F.sum("_broken").alias("broken_rules"), F.sum((F.col("_n") > 1).cast("int")).alias("duplicate_keys")
    ).withColumn("accepted", (F.col("broken_rules") == 0) & (F.col("duplicate_keys") == 0))


def split_poison(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows with their reason): one bad object never stops the rest."""
    marked = df.withColumn("reject_reason", reason)
    return marked.where("reject_reason is null").drop("reject_reason"), marked.where("reject_reason is not null")


def reconcile_keys(raw: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Every key with its status: live in both, missing from base, or orphaned in base."""
    left = raw.select(F.col(key)).distinct().withColumn("_raw", F.lit(True))
    right = base.select(F.col(key)).distinct().withColumn("_base", F.lit(True))
    status = F.when(F.col("_raw") & F.col("_base"), "live").when(F.col("_raw"), "missing").otherwise("orphaned")
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def settle_orphans(found: DataFrame, late_raw: DataFrame, key: str) -> DataFrame:
    """Orphans looked up again among raw keys that arrived since: those are live after all."""
    late = late_raw.select(key).distinct().withColumn("_late", F.lit(True))
    status = F.when((F.col("status") == "orphaned") & F.col("_late"), "live").otherwise(F.col("status"))
    return found.join(late, key, "left").select(key, status.alias("status"))


def inventory(df: DataFrame, devices: str, ts: str, *distinct: str) -> DataFrame:
    """One row: rows, distinct devices and other columns, first and last time."""
    return df.agg(
        F.count("*").alias("rows"), *[F.countDistinct(c).alias(f"{c}_count") for c in (devices, *distinct)],
        F.min(ts).alias("first_at"), F.max(ts).alias("last_at"),
    )


def check_relations(spark: SparkSession, names: list[str]) -> DataFrame:
    """Names of required relations and whether each exists and can be read."""

    def readable(name: str) -> bool:
        if not spark.catalog.tableExists(name):
            return False
        try:
            spark.table(name).limit(0).collect()
        except Exception:  # a relation that cannot be planned or opened is what this reports
            return False
        return True

    return spark.createDataFrame([(n, readable(n)) for n in names], "relation string, available boolean")


def validate_inventory(keys: DataFrame, prefixes: list[str], pattern: str, key: str = "object_key") -> DataFrame:
    """Keys outside the namespaces, not in canonical form, or listed twice: object_key, problem."""
    inside = F.lit(False)
    for p in prefixes:
        inside = inside | F.col(key).startswith(p)
    counts = keys.groupBy(key).agg(F.count("*").alias("n"))
    problem = F.when(~inside, "foreign").when(~F.col(key).rlike(pattern), "noncanonical").when(F.col("n") > 1, "duplicate")
    return counts.select(key, problem.alias("problem")).where("problem is not null")
