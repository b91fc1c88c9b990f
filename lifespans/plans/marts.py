"""Daily result tables over base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import DEFAULT_ZONE, local_date, micros_between
from ..operators.intervals import coalesce_intervals, overlapping, prorate_by_day
from ..operators.pairing import daily_usage_total, pair_events


def screen_time_interval(events: DataFrame) -> DataFrame:
    """Usage intervals of valid events."""
    return pair_events(events)


def daily_screen_time_total(events: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None) -> DataFrame:
    """Daily usage of the union of all devices, or per ``keys``."""
    return daily_usage_total(pair_events(events), events, zone, keys)


def daily_steps(intervals: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None, date_from=None, date_to=None) -> DataFrame:
    """Steps per local day, prorated over midnight."""
    parts = prorate_by_day(overlapping(intervals, "start_at", "end_at", date_from, date_to, zone), "steps", zone=zone)
    return parts.groupBy(*(keys or []), "activity_date").agg(
        F.sum("part_value").cast("double").alias("steps"), F.count("*").alias("interval_part_count"), F.bool_or("prorated").alias("has_prorated_intervals")
    )


ZONES = {"fat_burn": "fat_burn", "cardio": "cardio", "peak": "peak", "unspecified": "heart_rate_zone_unspecified"}


def daily_active_zone(intervals: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None, date_from=None, date_to=None) -> DataFrame:
    """Active zone minutes per local day, in total and per zone; unknown zones count in the total alone."""
    parts = prorate_by_day(overlapping(intervals, "start_at", "end_at", date_from, date_to, zone), "active_zone_minutes", zone=zone)
    by_zone = [F.sum(F.when(F.lower("category") == category, F.col("part_value"))).cast("double").alias(f"{name}_azm_minutes") for name, category in ZONES.items()]
    return parts.groupBy(*(keys or []), "activity_date").agg(
        F.sum("part_value").cast("double").alias("active_zone_minutes"), *by_zone, F.count("*").alias("interval_part_count"),
        F.bool_or("prorated").alias("has_prorated_intervals"),
    )


def daily_sleep(sessions: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None) -> DataFrame:
    """The main sleep that ends on each local day, and the minutes of its naps.

    Sessions of unknown kind belong to neither.  Without naps nap_minutes is 0; a nap of unknown length makes it null.
    """
    by = [*(keys or []), "sleep_date"]
    dated = sessions.withColumn("sleep_date", local_date("end_at", zone))
    best = Window.partitionBy(*by).orderBy(F.desc_nulls_last("sleep_minutes"), F.desc("end_at"), "sleep_session_id")
    main = dated.where("is_main_sleep IS TRUE").withColumn("_n", F.row_number().over(best)).where("_n = 1")
    main = main.select(*by, "sleep_session_id", "start_at", "end_at", "sleep_minutes", "awake_minutes")
    whole = F.when(F.count("sleep_minutes") == F.count("*"), F.sum("sleep_minutes"))
    naps = dated.where("is_main_sleep IS FALSE").groupBy(*by).agg(whole.alias("_nap"), F.lit(True).alias("_naps"))
    both = main.join(naps, by, "full_outer")
    return both.select(*by, "sleep_session_id", "start_at", "end_at", "sleep_minutes", "awake_minutes", F.when(F.col("_naps"), F.col("_nap")).otherwise(F.lit(0.0)).alias("nap_minutes"))


def daily_sleep_detail(sessions: DataFrame, details: DataFrame, zone: str = DEFAULT_ZONE, keys: list[str] | None = None) -> DataFrame:
    """Minutes per sleep date, kind and category; overlapping and touching details count once."""
    by = [*(keys or []), "sleep_date", "kind", "category"]
    dates = sessions.select("sleep_session_id", *(keys or []), local_date("end_at", zone).alias("sleep_date"))
    merged = coalesce_intervals(details.join(dates, "sleep_session_id").select(*by, "start_at", "end_at"), by)
    return merged.groupBy(*by).agg((F.sum(micros_between("start_at", "end_at")) / 60e6).alias("total_minutes"))


def usage_last_days(daily: DataFrame, last_day, days: int = 7, keys: list[str] | None = None) -> DataFrame:
    """Usage minutes of the latest ``days`` local days up to ``last_day``."""
    last = F.lit(last_day).cast("date")
    recent = daily.where((F.col("activity_date") > F.date_sub(last, days)) & (F.col("activity_date") <= last))
    return recent.select(*(keys or []), "activity_date", (F.col("total_seconds") / 60).alias("total_minutes"), "unresolved_event_count")


def usage_by_app(intervals: DataFrame, apps: DataFrame, platform: str) -> DataFrame:
    """Usage seconds per app with its display name; apps without a name keep their bundle id's row."""
    names = apps.where(F.col("platform") == platform).select("bundle_id", "app_name")
    totals = intervals.groupBy("bundle_id").agg(F.sum("duration_seconds").alias("total_seconds"), F.count("*").alias("intervals"))
    return totals.join(names, "bundle_id", "left").select("bundle_id", "app_name", "total_seconds", "intervals")


def daily_joined(sleep: DataFrame, steps: DataFrame, zones: DataFrame, usage: DataFrame) -> DataFrame:
    """One row per day over sleep (by wake date), steps, active zones and usage, each already of daily grain."""
    parts = [
        sleep.select(F.col("sleep_date").alias("day"), "sleep_minutes", "nap_minutes"), steps.select(F.col("activity_date").alias("day"), "steps"),
        zones.select(F.col("activity_date").alias("day"), "active_zone_minutes"), usage.select(F.col("activity_date").alias("day"), "total_seconds"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "day", "full_outer")
    return out
