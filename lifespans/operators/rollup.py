"""Minute rollups, observation sequences, counters and step levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import DEFAULT_ZONE, add_micros, floor_minute, local_midnight, micros_between, month_window_start
from ..functions.values import level


def minute_rollup(df: DataFrame, ts: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Mean, least and greatest value of every UTC minute that has one."""
    return df.groupBy(*(keys or []), floor_minute(ts).alias("start_at")).agg(
        F.avg(value).alias("mean_bpm"), F.min(value).alias("min_bpm"), F.max(value).alias("max_bpm")
    )


def drop_consecutive_duplicates(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Rows that differ from the row before; in A, B, A all stay."""
    w = Window.partitionBy(*keys).orderBy(*order)
    now = F.struct(*columns)
    before = F.lag(now).over(w)
    return df.withColumn("_same", before.isNotNull() & now.eqNullSafe(before)).where("not _same").drop("_same")


def monotonic_time(df: DataFrame, keys: list[str], order: list[str], ts: str, out: str = "recorded_at") -> DataFrame:
    """Strictly increasing times: a time that does not exceed the one before becomes that plus a microsecond.

    Closed form of the recurrence: with n rows before, the running maximum of time - n, plus n.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    n = F.row_number().over(w)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    numbered = df.withColumn("_n", n).withColumn("_base", micros_between(epoch, ts) - F.col("_n"))
    reach = F.max("_base").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return numbered.withColumn(out, add_micros(epoch, reach + F.col("_n"))).drop("_n", "_base")


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def completed_segments(df: DataFrame, directory: str, number: str) -> DataFrame:
    """Segments that a later one of the same directory has followed."""
    return df.withColumn("_last", F.max(number).over(Window.partitionBy(directory))).where(F.col(number) < F.col("_last")).drop("_last")


def allowed(df: DataFrame, allow: DataFrame, key: str, required: bool = False) -> DataFrame:
    """Rows of allowed keys; with ``required`` a ValueError, after a look for one row, if no row's key is allowed."""
    rows = df.join(allow.select(key).distinct(), key, "left_semi")
    if required and rows.isEmpty():
        raise ValueError(f"no row has an allowed {key}")
    return rows


def app_counters(events: DataFrame, keys: list[str]) -> DataFrame:
    """Starts, ends, and first and last event per group."""
    return events.groupBy(*keys).agg(
        F.count_if(F.col("state") == "start").alias("starts"), F.count_if(F.col("state") == "end").alias("ends"),
        F.min("event_at").alias("first_at"), F.max("event_at").alias("last_at"),
    )


def status_counts(df: DataFrame, status: str, values: list[str]) -> DataFrame:
    """One row with the number of rows of each status."""
    return df.agg(*[F.count_if(F.col(status) == v).alias(v) for v in values])


def all_done(units: DataFrame, message: str, committed: str) -> DataFrame:
    """Messages and whether every one of their units has been committed."""
    return units.groupBy(message).agg(F.bool_and(committed).alias("acknowledged"), F.count("*").alias("units"))


def oldest_pending(df: DataFrame, pending: Column, order: list[str]) -> DataFrame:
    """The row that may be acknowledged next: the first pending one in ``order``; none if nothing is pending."""
    return df.where(pending).orderBy(*order).limit(1)  # each task keeps its first row


def earliest_incomplete(windows: DataFrame, incomplete: Column, keys: list[str]) -> DataFrame:
    """(keys, start_at, data_type) of the earliest incomplete window of each group; ties by data type."""
    first = F.min(F.struct("start_at", "data_type"))
    return windows.where(incomplete).groupBy(*keys).agg(first.alias("_w")).select(*keys, "_w.start_at", "_w.data_type")


def linear_quantiles(values: DataFrame, value: str, shares: list[float], keys: list[str] | None = None) -> DataFrame:
    """(keys, n, quantiles array<double>): exact linear quantiles of the positive finite values of each group, by their digits.

    A positive double's exponent and mantissa are in the order of the values.  They are looked at as three digits, one
    after another: counts per digit are combined before the shuffle, a running sum over them tells which digits hold the
    wanted ranks, and only rows with those digits go on.  So a task orders counts of one group's digits (the exponents in
    use times 4096, then two times up to 2**20), never the group's values.  Rows with a null key are left out.
    """
    keys = keys or []
    v = F.col(value).cast("double")
    guess = F.floor(F.log2("_v"))  # may be off by one beside a power of two
    half = F.floor(F.col("_e") / 2)  # two factors, so that neither leaves the range of doubles
    rows = values.where((v > 0) & (v < float("inf"))).select(*keys, v.alias("_v")).withColumn("_g", guess)
    rows = rows.withColumn("_e", F.when(F.pow(F.lit(2.0), "_g") > F.col("_v"), F.col("_g") - 1).when(F.pow(F.lit(2.0), F.col("_g") + 1) <= F.col("_v"), F.col("_g") + 1).otherwise(F.col("_g")))
    rows = rows.withColumn("_m", ((F.col("_v") / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), F.col("_e") - half) - 1) * float(1 << 52)).cast("long"))
    digits = [(F.col("_e") + 1100) * 4096 + F.shiftright("_m", 40), F.shiftright("_m", 20).bitwiseAND(F.lit((1 << 20) - 1)), F.col("_m").bitwiseAND(F.lit((1 << 20) - 1))]
    rows = rows.select(*keys, "_v", *[d.cast("long").alias(f"_d{k}") for k, d in enumerate(digits)])
    chosen, by = None, list(keys)
    for k in range(3):
        here = rows if chosen is None else rows.join(chosen, by)
        own = [] if chosen is None else [F.first("_n").alias("_n"), F.first("_ranks").alias("_ranks")]
        counts = here.groupBy(*by, f"_d{k}").agg(F.count("*").alias("_c"), F.min("_v").alias("_least"), *own)
        group = Window.partitionBy(*by)
        before = F.coalesce(F.sum("_c").over(group.orderBy(f"_d{k}").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
        if chosen is None:
            counts = counts.withColumn("_n", F.sum("_c").over(group))
            at = [(F.col("_n") - 1) * F.lit(float(q)) for q in shares]
            ranks = F.array(*[F.struct(F.lit(2 * i + side).alias("of"), f(p).cast("long").alias("rank")) for i, p in enumerate(at) for side, f in enumerate((F.floor, F.ceil))])
            counts = counts.withColumn("_ranks", ranks)
        inside = F.filter("_ranks", lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_c")))
        left = F.transform(inside, lambda r: F.struct(r["of"].alias("of"), (r["rank"] - F.col("_before")).alias("rank")))
        by = [*by, f"_d{k}"]
        chosen = counts.select(*by, "_c", "_least", "_n", "_ranks", before).select(*by, "_least", "_n", left.alias("_ranks")).where(F.size("_ranks") > 0)
        chosen = chosen if k == 2 else chosen.drop("_least")
    found = chosen.select(*keys, "_n", "_least", F.explode("_ranks.of").alias("_of")).groupBy(*keys).agg(
        F.first("_n").alias("n"), *[F.max(F.when(F.col("_of") == k, F.col("_least"))).alias(f"_q{k}") for k in range(2 * len(shares))]
    )

    def between(i: int, q: float) -> Column:
        at = (F.col("n") - 1) * F.lit(float(q))
        low, high = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}")
        return F.when(F.floor(at) == at, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return found.select(*keys, "n", F.array(*[between(i, q) for i, q in enumerate(shares)]).alias("quantiles"))


def upper_fence(values: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Greatest positive value within Q3 + 1.5 IQR (linear quantiles); with fewer than four values the plain greatest.

    The quantiles are exact and found by counting digits, so no task holds a group's values.
    """
    keys = keys or []
    positive = values.where(F.col(value) > 0)
    stats = linear_quantiles(positive, value, [0.25, 0.75], keys)
    fence = F.when(F.col("n") >= 4, F.col("quantiles")[1] + 1.5 * (F.col("quantiles")[1] - F.col("quantiles")[0]))
    stats = stats.select(*keys, fence.alias("_fence"))
    fenced = positive.join(stats, keys) if keys else positive.join(F.broadcast(stats))  # one row without keys
    return fenced.where(F.col("_fence").isNull() | (F.col(value) <= F.col("_fence"))).groupBy(*keys).agg(F.max(value).alias("top"))


def step_levels(daily: DataFrame, end_day, day: str = "activity_date", value: str = "steps", months: int = 10) -> DataFrame:
    """Calendar cells of a window of months: column (week), row (weekday, Sunday 0) and level 0 to 4.

    Levels split the range up to the fenced maximum in quarters.  Days without a value have no cell.
    """
    last = F.lit(end_day).cast("date")
    first = month_window_start(last, months)
    days = daily.where((F.col(day) >= first) & (F.col(day) <= last) & F.col(value).isNotNull())
    top = upper_fence(days, value)
    bounds = [F.col("top") * q for q in (0.25, 0.5, 0.75)]
    grid = F.date_sub(first, F.dayofweek(first) - 1)
    cells = days.join(F.broadcast(top), how="left")  # one row, an aggregate without keys
    return cells.select(
        F.col(day), F.floor(F.date_diff(F.col(day), grid) / 7).cast("int").alias("week_column"), (F.dayofweek(day) - 1).alias("weekday_row"),
        level(F.col(value), [F.coalesce(b, F.lit(float("inf"))) for b in bounds]).cast("int").alias("level"),
    )


def sync_windows(spark: SparkSession, start: str, end: str, types: dict[str, str], zone: str = DEFAULT_ZONE) -> DataFrame:
    """A window for every type: types on the civil calendar get whole local days, others the exact range."""
    rows = spark.createDataFrame(sorted(types.items()), "data_type string, time_basis string")
    a, z = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    own = lambda t: F.convert_timezone(F.lit("UTC"), F.lit(zone), t)
    up = F.when(own(z) == F.date_trunc("day", own(z)), own(z)).otherwise(F.date_trunc("day", own(z)) + F.expr("INTERVAL 1 DAY"))
    civil = F.col("time_basis") == "civil"
    return rows.select(
        "data_type", "time_basis", F.when(civil, F.date_trunc("day", own(a))).otherwise(a).cast("timestamp_ntz").alias("start_at"),
        F.when(civil, up).otherwise(z).cast("timestamp_ntz").alias("end_at"),
    )


def completed_days(spark: SparkSession, now: str, count: int = 2, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The latest completed local days: day, start_at, end_at."""
    today = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(now).cast("timestamp_ntz")).cast("date")
    days = spark.range(1, count + 1).select(F.date_sub(today, F.col("id").cast("int")).alias("day"))
    return days.select("day", local_midnight("day", zone).alias("start_at"), local_midnight(F.date_add("day", 1), zone).alias("end_at"))
