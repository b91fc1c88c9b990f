"""Half-open intervals: splitting at local midnight, prorating, union coverage, coalescing, request windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import DEFAULT_ZONE, add_micros, ceil_minute, floor_minute, last_instant, local_date, local_midnight, micros_between, ntz


def overlapping(df: DataFrame, start: str, end: str, date_from=None, date_to=None, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Rows that touch the civil days [date_from, date_to); plain comparisons with literals, so they reach the scan."""
    if date_from is not None:
        df = df.where(ntz(end) > local_midnight(F.lit(date_from).cast("date"), zone))
    if date_to is not None:
        df = df.where(ntz(start) < local_midnight(F.lit(date_to).cast("date"), zone))
    return df


def split_by_day(df: DataFrame, start: str = "start_at", end: str = "end_at", zone: str | Column = DEFAULT_ZONE, day: str = "activity_date") -> DataFrame:
    """One row per local day that an interval covers, with piece_start and piece_end.

    An interval that ends at midnight has no piece on the next day; empty and reversed intervals have none at all.
    """
    valid = df.where(ntz(end) > ntz(start))
    days = F.sequence(local_date(start, zone), local_date(last_instant(end), zone))
    pieces = valid.withColumn(day, F.explode(days))
    return pieces.withColumn("piece_start", F.greatest(ntz(start), local_midnight(day, zone))).withColumn(
        "piece_end", F.least(ntz(end), local_midnight(F.date_add(day, 1), zone))
    )


def prorate_by_day(df: DataFrame, value: str, start: str = "start_at", end: str = "end_at", zone: str = DEFAULT_ZONE, day: str = "activity_date") -> DataFrame:
    """Day pieces with ``part_value``, the value's share by time, and ``prorated``, whether the interval crosses midnight."""
    pieces = split_by_day(df, start, end, zone, day)
    share = micros_between("piece_start", "piece_end") / micros_between(start, end)
    return pieces.withColumn("part_value", F.col(value) * share).withColumn(
        "prorated", local_date(start, zone) != local_date(last_instant(end), zone)
    )


def daily_coverage(pieces: DataFrame, keys: list[str] | None = None, day: str = "activity_date", start: str = "piece_start", end: str = "piece_end", observed: str = "observed") -> DataFrame:
    """Seconds covered by the union of pieces per day, and seconds that an observed piece covers.

    Pieces become +1/-1 marks that are summed per instant before the shuffle ends; a running sum over a day's instants
    tells which stretches are covered.  Nothing is compared pairwise.  Without ``keys`` a day is one group of all pieces,
    so its marks are swept hour by hour.
    """
    by = [*(keys or []), day]
    marks = pieces.select(*by, F.explode(F.array(*coverage_marks(start, end, observed))).alias("m")).select(*by, "m.*")
    return covered_seconds(marks, by, spread=not keys).where("total_seconds is not null")


def coverage_marks(start: str = "piece_start", end: str = "piece_end", observed: str = "observed") -> list[Column]:
    """The two marks of a piece: instant t, change d of the pieces that cover it and change o of the observed ones."""
    seen = F.col(observed).cast("long")
    return [F.struct(ntz(at).alias("t"), F.lit(sign).cast("long").alias("d"), (seen * sign).alias("o")) for at, sign in ((start, 1), (end, -1))]


def covered_seconds(marks: DataFrame, by: list[str], spread: bool = False, **sums: str) -> DataFrame:
    """observed_seconds and total_seconds that the marks of each group cover, null where none do.

    ``sums`` adds the sums of other columns of ``marks``; rows that carry nothing else have a null t.  With ``spread`` no
    window is wider than an hour of a group: changes are summed per hour, the hours' sums carried forward, and each hour
    begins with a mark that opens with what covers it and ends with the hour.
    """
    marks = marks.groupBy(*by, "t").agg(F.sum("d").alias("d"), F.sum("o").alias("o"), *[F.sum(c).alias(n) for n, c in sums.items()])
    group, until = by, F.lit(None).cast("timestamp_ntz")
    if spread:
        marks = marks.withColumn("hour", F.date_trunc("hour", "t").cast("timestamp_ntz"))
        hours = marks.where("t is not null").groupBy(*by, "hour").agg(F.sum("d").alias("d"), F.sum("o").alias("o"))
        forward = Window.partitionBy(*by).orderBy("hour")  # a row an hour
        following = F.coalesce(F.lead("hour").over(forward), F.col("hour") + F.expr("INTERVAL 1 HOUR"))
        covered = hours.select(*by, F.col("hour").alias("at"), following.alias("next"), *[F.sum(c).over(forward).alias(f"_{c}") for c in "do"], "d", "o")
        later = F.filter(F.sequence("at", F.col("next") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR")), lambda h: h > F.col("at"))
        inside = covered.select(*by, F.col("at").alias("hour"), (F.col("_d") - F.col("d")).alias("d"), (F.col("_o") - F.col("o")).alias("o"))
        between = covered.where("_d > 0").select(*by, F.explode(later).alias("hour"), F.col("_d").alias("d"), F.col("_o").alias("o"))
        opening = inside.unionByName(between).select(*by, F.col("hour").alias("t"), "d", "o", *[F.lit(None).cast("long").alias(n) for n in sums], "hour")
        group, until = [*by, "hour"], F.col("hour") + F.expr("INTERVAL 1 HOUR")
        marks = marks.unionByName(opening).groupBy(*group, "t").agg(F.sum("d").alias("d"), F.sum("o").alias("o"), *[F.sum(n).alias(n) for n in sums])
    w = Window.partitionBy(*group).orderBy("t")
    run = marks.select(
        *by, *sums, micros_between("t", F.coalesce(F.lead("t").over(w), until)).alias("us"), F.sum("d").over(w).alias("active"), F.sum("o").over(w).alias("seen")
    )
    return run.groupBy(*by).agg(
        (F.sum(F.when(F.col("seen") > 0, F.col("us"))) / 1e6).alias("observed_seconds"),
        (F.sum(F.when(F.col("active") > 0, F.col("us"))) / 1e6).alias("total_seconds"), *[F.sum(n).alias(n) for n in sums],
    )


def coalesce_intervals(df: DataFrame, keys: list[str], start: str = "start_at", end: str = "end_at", collect: str | None = None) -> DataFrame:
    """Merge overlapping or touching intervals of a group; null keys are a group of their own.

    With ``collect`` the merged row keeps the sorted set of that column's values, its lineage.
    """
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("_opens", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    island = opened.withColumn("_island", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = [F.min(start).alias(start), F.max(end).alias(end)]
    if collect:
        out.append(F.array_sort(F.collect_set(collect)).alias("sources"))
    return island.groupBy(*keys, "_island").agg(*out).drop("_island")


def coalesce_spread(df: DataFrame, keys: list[str], start: str = "start_at", end: str = "end_at", collect: str | None = None) -> DataFrame:
    """The rows of ``coalesce_intervals`` for keys of few, large groups: no window is wider than a day of a group.

    Rows are merged within the day of their start first.  Of these islands, those that begin before everything earlier
    has ended belong to the island that is open when their day begins; how far the earlier days reach, and which island
    they leave open, comes from one row for each group and day.  Rows are shuffled once, and only islands after that.
    """
    by = [*keys, "_day"]
    islands = coalesce_intervals(df.withColumn("_day", F.date_trunc("day", F.col(start))), by, start, end, collect)
    earlier = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # over a row a day

    def carried(rows: DataFrame, value: Column, name: str) -> DataFrame:
        """``rows`` with the greatest ``value`` of all earlier days of their group."""
        days = rows.groupBy(*by).agg(F.max(value).alias("_most")).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.max("_most").over(earlier).alias(name))
        same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
        return rows.join(days, same).drop(*[f"_k{i}" for i in range(len(by))])

    opens = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), F.col(start))
    reached = carried(islands, F.col(end), "_reach").withColumn("_opens", opens)
    placed = carried(reached, F.col("_opens"), "_open").withColumn("_island", F.coalesce("_opens", "_open"))
    out = [F.min(start).alias(start), F.max(end).alias(end)]
    if collect:
        out.append(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"))
    return placed.groupBy(*keys, "_island").agg(*out).drop("_island")


def merge_windows(windows: DataFrame, keys: tuple[str, ...] = ("data_type", "time_basis"), collect: str | None = None) -> DataFrame:
    """Request windows merged per type and time basis; UTC and civil windows never merge."""
    return coalesce_spread(windows, list(keys), "start_at", "end_at", collect)


def split_windows(windows: DataFrame, zone: str = DEFAULT_ZONE, cap: int | None = None, received: str | None = None) -> DataFrame:
    """Windows cut at day borders: of ``zone`` for UTC windows, of their own wall time for civil ones.

    With ``received`` days that start at or after receipt are left out; with ``cap`` the column too_many tells windows
    of more pieces.
    """
    own = F.when(F.col("time_basis") == "civil", F.lit("UTC")).otherwise(F.lit(zone))
    pieces = split_by_day(windows, "start_at", "end_at", own, "day")
    if received:
        pieces = pieces.where(local_midnight("day", own) < ntz(received))
    if cap is not None:
        pieces = pieces.withColumn("too_many", F.date_diff(local_date(last_instant("end_at"), own), local_date("start_at", own)) + 1 > cap)
    return pieces


def expand_to_days(windows: DataFrame, keys: tuple[str, ...] = ("data_type", "time_basis"), zone: str = DEFAULT_ZONE) -> DataFrame:
    """The whole local days that windows touch, each once."""
    days = split_windows(windows, zone).select(*keys, "day").distinct()
    own = F.when(F.col("time_basis") == "civil", F.lit("UTC")).otherwise(F.lit(zone))
    return days.select(*keys, "day", local_midnight("day", own).alias("start_at"), local_midnight(F.date_add("day", 1), own).alias("end_at"))


def chunk_windows(windows: DataFrame, max_days: Column | int, start: str = "start_at", end: str = "end_at") -> DataFrame:
    """Windows cut into chunks of at most ``max_days`` days from their start: chunk_start, chunk_end."""
    length = (F.lit(max_days) if isinstance(max_days, int) else max_days).cast("long") * F.lit(86_400_000_000)
    count = F.ceil(micros_between(start, end) / length).cast("int")
    valid = windows.where(ntz(end) > ntz(start)).withColumn("chunk", F.explode(F.sequence(F.lit(0), count - 1)))
    return valid.withColumn("chunk_start", add_micros(start, F.col("chunk") * length)).withColumn(
        "chunk_end", F.least(ntz(end), add_micros(start, (F.col("chunk") + 1) * length))
    )


def round_window(df: DataFrame, mode: str = "outward", start: str = "start_at", end: str = "end_at") -> DataFrame:
    """Windows on whole minutes: ``outward`` covers the window, ``inward`` keeps complete minutes (none left: no row)."""
    if mode not in ("outward", "inward"):
        raise ValueError("mode is outward or inward")
    a, z = (floor_minute(start), ceil_minute(end)) if mode == "outward" else (ceil_minute(start), floor_minute(end))
    return df.withColumns({start: a, end: z}).where(F.col(end) > F.col(start))


def civil_envelope(df: DataFrame, start: str = "start_at", end: str = "end_at", hours: int = 18) -> DataFrame:
    """Physical range that surely holds a civil range when no offset is known."""
    us = hours * 3_600_000_000
    return df.withColumns({start: add_micros(start, -us), end: add_micros(end, us)})


def range_predicate(start, end, ts: str = "start_at", day: str = "source_date", civil: bool = False) -> Column:
    """Half-open range by instant, or by the provider's date; a null date is outside every civil range."""
    if civil:
        return F.coalesce((F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date")), F.lit(False))
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))
