"""Operators that keep no group whole in a task: the same rows as plain loops, and plans that show it."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifespans.functions.values import utc_offset
from lifespans.operators import intervals, pairing, rollup
from lifespans.sources import health

START = datetime(2024, 1, 1)


def plain_pairs(events):
    """(start key, end time, inferred, bounding key) by looking ahead event by event."""
    out = []
    by_device = {}
    for e in events:
        if e[5]:
            by_device.setdefault(e[1], []).append(e)
    for rows in by_device.values():
        rows.sort(key=lambda e: (e[3], e[4] != "end", e[0]))
        for k, (key, _, app, at, state, _) in enumerate(rows):
            if state != "start":
                continue
            start = next((e for e in rows[k + 1 :] if e[4] == "start"), None)
            end = next((e for e in rows[k + 1 :] if e[4] == "end" and e[2] == app), None)
            own = end is not None and (start is None or end[3] <= start[3])
            bound = end if own else start
            if bound and bound[3] > at:
                out.append((key, bound[3], not own, bound[0]))
    return sorted(out)


def random_events(seed, n=300, days=40):
    r = random.Random(seed)
    return [
        (f"{k:05d}", f"d{r.randrange(3)}", r.choice([None, "a", "b", "c"]) if k % 9 == 0 else r.choice("abc"), START + timedelta(hours=r.randrange(24 * days)), r.choice(["start", "end"]), r.random() < 0.9)
        for k in range(n)
    ]


@pytest.mark.parametrize(("seed", "block"), [(1, "day"), (2, "hour"), (3, "month"), (4, "day")])
def test_pairing_over_block_borders(spark, seed, block):
    events = [e for e in random_events(seed, n=[300, 40][seed == 4]) if e[2]]
    df = spark.createDataFrame(events, "event_key string, device_key string, bundle_id string, event_at timestamp_ntz, state string, is_valid boolean")
    got = pairing.pair_events(df, block=block).select("start_event_key", "ended_at", "is_inferred", "boundary_event_key").collect()
    assert sorted(map(tuple, got)) == plain_pairs(events)


def test_no_window_of_pairing_is_a_whole_device(spark):
    df = spark.createDataFrame([], "event_key string, device_key string, bundle_id string, event_at timestamp_ntz, state string, is_valid boolean")
    plan = pairing.pair_events(df)._jdf.queryExecution().optimizedPlan().toString()
    over_events = [line for line in plan.splitlines() if "Window" in line and "_start" in line or "Window" in line and "_end" in line]
    assert over_events and all("block" in line.rsplit("], [", 2)[1] for line in over_events)


@pytest.mark.parametrize("seed", range(3))
def test_sweep_by_hours_gives_the_rows_of_the_plain_sweep(spark, seed):
    r = random.Random(seed)
    rows = []
    for k in range(200):
        a = START + timedelta(minutes=r.randrange(60 * 24 * 2), seconds=r.choice([0, 0, 17]))
        rows.append((k % 3, a.date(), a, min(a + timedelta(minutes=r.choice([0, 1, 30, 60, 400])), datetime(a.year, a.month, a.day) + timedelta(days=1)), r.random() < 0.5))
    df = spark.createDataFrame(rows, "k int, activity_date date, piece_start timestamp_ntz, piece_end timestamp_ntz, observed boolean")
    marks = df.select("activity_date", F.explode(F.array(*intervals.coverage_marks())).alias("m")).select("activity_date", "m.*", F.lit(1).alias("x"))
    nothing = df.limit(5).select("activity_date", F.lit(None).cast("timestamp_ntz").alias("t"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("o"), F.lit(7).alias("x"))
    for source in (marks, marks.unionByName(nothing)):
        plain, swept = (sorted(map(tuple, intervals.covered_seconds(source, ["activity_date"], spread, n="x").collect())) for spread in (False, True))
        assert plain == swept
    assert intervals.daily_coverage(df).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_by_digits_are_exact(spark, seed):
    r = np.random.default_rng(seed)
    groups = {
        "normal": r.lognormal(0, 3, 501), "ties": r.choice([1.0, 2.0, 3.5], 400), "one": np.array([7.25]), "two": np.array([0.1, 0.3]), "powers": 2.0 ** r.integers(-1074, 1023, 300),
        "beside": np.nextafter(2.0 ** r.integers(-40, 40, 200), r.choice([0, np.inf], 200)), "equal": np.full(50, 1 / 3), "tiny": np.array([5e-324, 1e-310, 2e-308, 1.7e308]), "whole": r.integers(1, 10**15, 99).astype(float),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("normal", -1.0), ("normal", 0.0), ("normal", None), ("none", None), ("normal", float("inf"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    shares = [0.25, 0.75, 0.5, 0.0, 1.0, 0.9]
    got = {x.g: x for x in rollup.linear_quantiles(df, "x", shares, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        xs = np.sort(xs)
        for q, value in zip(shares, got[g].quantiles):
            at = q * (len(xs) - 1)
            low, high = xs[int(np.floor(at))], xs[int(np.ceil(at))]
            assert value == (low if at == int(at) else (np.ceil(at) - at) * low + (at - np.floor(at)) * high), (g, q)
    plan = rollup.upper_fence(df, "x", ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower() and "collect" not in plan.lower()


def test_other_states_neither_close_nor_bound(spark):
    events = random_events(7)
    paused = [(f"p{k}", d, a, at + timedelta(minutes=1), "pause", True) for k, (_, d, a, at, _, _) in enumerate(events)]
    names = "event_key string, device_key string, bundle_id string, event_at timestamp_ntz, state string, is_valid boolean"
    got = pairing.pair_events(spark.createDataFrame(events + paused, names)).collect()
    assert sorted((r.start_event_key, r.ended_at, r.is_inferred, r.boundary_event_key) for r in got) == plain_pairs(events)


def test_offsets_at_the_ends_of_integers(spark):
    texts = ["-2147483648s", "2147483647s", "99999999999s", "-64800s", "64800.00s", "64801s", "s", "", "1.5s", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", utc_offset(F.col("t")).alias("o")).orderBy("k").collect()
    assert [r.o for r in rows] == [None, None, None, -64800, 64800, None, None, None, None, None]


def test_values_of_a_point_are_read_once_however_it_is_filtered(spark):
    body = '{"dataPointName":"users/u/dataTypes/steps/dataPoints/p-1","steps":{"interval":{"startTime":"2024-01-01T00:00:00Z","endTime":"2024-01-01T00:05:00Z","startUtcOffset":"0s","endUtcOffset":"0s"},"count":"7"}}'
    points = health.parse_points(spark.createDataFrame([(1, body)], "k int, body string"), kind="steps")
    good = health.normalize(points, "steps").where("reject_reason is null").select("k", "steps", "start_at")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and all("startTime" not in line for line in plan.splitlines() if "Filter" in line)
    assert [(r.k, r.steps) for r in good.collect()] == [(1, 7.0)]
