"""Known cases by value, and properties."""

import datetime as dt
import gzip
import hashlib
import hmac
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lifespans.functions import time as T
from lifespans.functions import values as V
from lifespans.operators import intervals, pairing, quality, rollup, sync
from lifespans.plans import marts
from lifespans.schemas import COLUMNS, KEYS, schema
from lifespans.sources import health, location, tables
from lifespans.sources import usage as usage_source
from lifespans.streaming import files, notify

EVENT = "event_key string, device_key string, bundle_id string, event_at timestamp, state string, is_valid boolean"


def at(text):
    return dt.datetime.fromisoformat(text)


def usage(spark, rows):
    return spark.createDataFrame([(k, d, a, at(t), s, v) for k, d, a, t, s, v in rows], EVENT)


CASE = [
    ("a", "one", "app", "2026-01-01 14:59:59.500", "start", True), ("b", "one", "app", "2026-01-01 15:00:01.500", "end", True),
    ("c", "two", "app", "2026-01-01 15:00:00", "start", True), ("d", "two", "other", "2026-01-01 15:00:02", "start", True),
    ("e", "two", "other", "2026-01-01 15:00:03", "end", True), ("f", "two", "app", "2026-01-02 16:00:00", "end", True),
]


def totals(df):
    return [tuple(r) for r in marts.daily_screen_time_total(df).orderBy("activity_date").collect()]


def test_usage_coverage_over_midnight(spark):
    day = lambda d: dt.date(2026, 1, d)
    assert totals(usage(spark, CASE)) == [(day(1), 0.5, 0.0, 0.5, 0), (day(2), 2.5, 0.5, 3.0, 0), (day(3), None, None, None, 1)]


def test_usage_correction(spark):
    rows = [(*r[:5], r[0] != "b") for r in CASE]
    assert totals(usage(spark, rows))[0][3] is None


def test_ties_and_zero_length(spark):
    t = lambda s: f"2026-01-01 00:00:{s:02d}"
    rows = [("a", "x", "app", t(0), "start", True), ("b", "x", "app", t(10), "end", True), ("c", "x", "other", t(10), "start", True),
            ("d", "x", "other", t(15), "end", True), ("e", "x", "app", "2026-01-02 00:00:00", "start", True), ("f", "x", "app", "2026-01-02 00:00:00", "end", True)]
    got = pairing.pair_events(usage(spark, rows)).orderBy("started_at").select("start_event_key", "boundary_event_key", "is_inferred").collect()
    assert [tuple(r) for r in got] == [("a", "b", False), ("c", "d", False)]
    assert [r[3:] for r in totals(usage(spark, rows))] == [(15.0, 0), (None, 2)]


def _pairs_by_loop(events):
    order = sorted((e for e in events if e[5]), key=lambda e: (e[3], e[4] != "end", e[0]))
    out = set()
    for i, (k, d, a, t, s, _) in enumerate(order):
        if s != "start":
            continue
        n = next((e for e in order[i + 1 :] if e[1] == d and e[4] == "start"), None)
        e = next((e for e in order[i + 1 :] if e[1] == d and e[2] == a and e[4] == "end"), None)
        own = e is not None and (n is None or e[3] <= n[3])
        b = e if own else n
        if b is not None and b[3] > t:
            out.add((k, b[0], not own))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pairing_matches_a_plain_loop(spark, seed):
    r = random.Random(seed)
    rows = [(f"k{i}", f"d{r.randrange(2)}", f"a{r.randrange(2)}", f"2026-01-01 00:{r.randrange(20):02d}:00", r.choice(["start", "end"]), r.random() > 0.1) for i in range(120)]
    got = pairing.pair_events(usage(spark, rows)).select("start_event_key", "boundary_event_key", "is_inferred").collect()
    assert {tuple(x) for x in got} == _pairs_by_loop(rows)


SPAN = "id string, start_at timestamp, end_at timestamp, steps double"


def test_steps_are_prorated(spark):
    df = spark.createDataFrame([("s", at("2026-01-01 14:59:00"), at("2026-01-01 15:01:00"), 100.0)], SPAN)
    got = marts.daily_steps(df).orderBy("activity_date").collect()
    assert [tuple(r)[1:] for r in got] == [(50.0, 1, True), (50.0, 1, True)]


def test_interval_to_midnight_and_empty_intervals(spark):
    rows = [("m", at("2026-01-01 14:00:00"), at("2026-01-01 15:00:00"), 1.0), ("e", at("2026-01-01 14:00:00"), at("2026-01-01 14:00:00"), 1.0),
            ("r", at("2026-01-01 14:00:00"), at("2026-01-01 13:00:00"), 1.0), ("n", None, at("2026-01-01 13:00:00"), 1.0)]
    got = intervals.split_by_day(spark.createDataFrame(rows, SPAN)).select("id", "activity_date").collect()
    assert [tuple(r) for r in got] == [("m", dt.date(2026, 1, 1))]


def test_zones_are_prorated(spark):
    rows = [("a", at("2026-01-01 14:59:00"), at("2026-01-01 15:01:00"), 20.0, "Cardio"), ("b", at("2026-01-01 15:00:00"), at("2026-01-01 15:01:00"), 3.0, "mystery")]
    df = spark.createDataFrame(rows, "id string, start_at timestamp, end_at timestamp, active_zone_minutes double, category string")
    got = marts.daily_active_zone(df).orderBy("activity_date").select("active_zone_minutes", "cardio_azm_minutes", "fat_burn_azm_minutes").collect()
    assert [tuple(r) for r in got] == [(10.0, 10.0, None), (13.0, 10.0, None)]


def test_daily_sleep(spark):
    z = [("main", "01-01 14:30", "01-01 22:30", 420.0, 15.0, True), ("earlier", "01-01 13:00", "01-01 21:00", 420.0, 20.0, True), ("short", "01-01 23:00", "01-02 01:00", 100.0, 0.0, True),
         ("missing", "01-02 14:00", "01-02 22:00", None, 0.0, True), ("nap-with-main", "01-02 03:00", "01-02 03:30", 25.0, None, False), ("nap-overnight", "01-03 14:45", "01-03 15:15", 20.0, None, False),
         ("nap", "01-04 03:00", "01-04 04:00", 50.0, None, False), ("nap-zero", "01-05 03:00", "01-05 03:10", 0.0, None, False), ("nap-known", "01-06 03:00", "01-06 03:30", 25.0, None, False),
         ("nap-missing", "01-06 07:00", "01-06 07:30", None, None, False), ("unknown", "01-07 03:00", "01-07 04:00", 50.0, None, None)]
    rows = [(i, at(f"2026-{a}:00"), at(f"2026-{b}:00"), m, w, k) for i, a, b, m, w, k in z]
    df = spark.createDataFrame(rows, "sleep_session_id string, start_at timestamp, end_at timestamp, sleep_minutes double, awake_minutes double, is_main_sleep boolean")
    got = marts.daily_sleep(df).orderBy("sleep_date").select("sleep_session_id", "sleep_minutes", "nap_minutes").collect()
    assert [tuple(r) for r in got] == [("main", 420.0, 25.0), ("missing", None, 0.0), (None, None, 70.0), (None, None, 0.0), (None, None, None)]


def test_sleep_detail_merges_and_keeps_null_category(spark):
    s = spark.createDataFrame([("s", at("2026-01-01 13:00:00"), at("2026-01-01 16:00:00"))], "sleep_session_id string, start_at timestamp, end_at timestamp")
    d = spark.createDataFrame([("a", "s", "sleep-stage", at("2026-01-01 13:00:00"), at("2026-01-01 14:00:00"), None), ("b", "s", "sleep-stage", at("2026-01-01 13:30:00"), at("2026-01-01 13:45:00"), None)],
                              "sleep_detail_id string, sleep_session_id string, kind string, start_at timestamp, end_at timestamp, category string")
    assert [tuple(r) for r in marts.daily_sleep_detail(s, d).collect()] == [(dt.date(2026, 1, 2), "sleep-stage", None, 60.0)]


def test_reconcile_twice_changes_nothing_and_keeps_what_is_outside(spark):
    rows = lambda *x: spark.createDataFrame([(k, at(f"2026-01-01 {h:02d}:00:00"), v) for k, h, v in x], "id string, start_at timestamp_ntz, v double")
    current = rows(("a", 0, 1.0), ("b", 8, 2.0), ("c", 16, 3.0))
    inside = intervals.range_predicate("2026-01-01 08:00:00", "2026-01-01 16:00:00")
    post, changes = sync.reconcile_range(current, rows(("b", 9, 5.0), ("c", 9, 3.0)), "id", inside)
    assert sorted((r.id, r.action) for r in changes.collect()) == [("b", "update"), ("c", "update")]
    assert sorted(r.id for r in post.collect()) == ["a", "b", "c"]
    assert sync.reconcile_range(post, rows(("b", 9, 5.0), ("c", 9, 3.0)), "id", inside)[1].count() == 0
    gone, change = sync.reconcile_range(current, rows().where("false"), "id", inside)
    assert sorted(r.id for r in gone.collect()) == ["a", "c"] and change.count() == 1


def test_civil_range_never_deletes_rows_without_a_date(spark):
    df = spark.createDataFrame([("a", None), ("b", dt.date(2026, 1, 1))], "id string, source_date date")
    post, _ = sync.reconcile_range(df, df.where("false"), "id", intervals.range_predicate("2026-01-01", "2026-01-02", civil=True))
    assert [r.id for r in post.collect()] == ["a"]


def test_deleted_slot_hides_only_itself(spark):
    rows = [("s1", 0, 0, "WRITTEN"), ("s1", 0, 1, "DELETED"), ("s1", 1, 0, "WRITTEN")]
    df = spark.createDataFrame(rows, "segment_key string, record_offset int, record_metadata_offset int, record_state string")
    full = df.select("*", F.lit("e").alias("event_key"), F.lit("d").alias("device_key"), F.lit("a").alias("bundle_id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("event_at"),
                     F.lit(True).alias("in_foreground"), F.lit(None).cast("boolean").alias("crc_passed"), F.lit("event").alias("record_kind"))
    assert [r.event_key for r in sync.adopt_records(full).collect()] == ["e"]
    assert sync.adopt_records(full.where("record_offset = 0")).count() == 0


def test_step_levels_fence_the_outlier(spark):
    steps = [0.0, 2.0, 4.0, 6.0, 8.0, 100.0, None]
    df = spark.createDataFrame([(dt.date(2026, 1, 1 + i), s) for i, s in enumerate(steps)], "activity_date date, steps double")
    got = rollup.step_levels(df, "2026-01-31").orderBy("activity_date").collect()
    assert [r.level for r in got] == [0, 2, 3, 4, 4, 4]


def test_monotonic_time_and_consecutive_duplicates(spark):
    rows = [("s", i, at(f"2026-01-01 00:00:0{s}"), h) for i, (s, h) in enumerate([(1, "A"), (1, "A"), (0, "B"), (2, "A")])]
    df = spark.createDataFrame(rows, "seg string, n int, ts timestamp, h string")
    times = [r.recorded_at for r in rollup.monotonic_time(df, ["seg"], ["n"], "ts").orderBy("n").collect()]
    assert all(a < b for a, b in zip(times, times[1:])) and times[3] == at("2026-01-01 00:00:02")
    assert [r.n for r in rollup.drop_consecutive_duplicates(df, ["seg"], ["n"], ["h"]).orderBy("n").collect()] == [0, 2, 3]


def test_strict_values(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("-3",), ("x",), (None,), ("99999999999999999999",), ("NaN",)], "t string")
    assert [r[0] for r in df.select(V.strict_integer(F.col("t"), 0)).collect()] == [12, None, None, None, None, None, None]
    texts = ["12", "1.5", "-3e2", '"1.5"', "true", '"true"', "null", "1e400", "[1]", "123456789012345678901234567890"]
    typed = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("v"))
    got = typed.select(V.json_number(F.col("v")), V.json_boolean(F.col("v")), V.json_given(F.col("v")), V.json_number(F.col("v"), 0, 12)).collect()
    assert [r[0] for r in got] == [12.0, 1.5, -300.0, None, None, None, None, None, None, 123456789012345678901234567890.0]
    assert [r[1] for r in got] == [None, None, None, None, True, None, None, None, None, None] and [r[2] for r in got] == [True] * 6 + [False] + [True] * 3
    assert [r[3] for r in got][:3] == [12.0, 1.5, None]
    stamps = spark.createDataFrame([("2026-01-01T00:00:00.123456Z",), ("2026-01-01T00:00:00.1234567Z",), ("2026-01-01T09:00:00+09:00",), ("2026-13-01T00:00:00Z",)], "t string")
    assert [r[0] for r in stamps.select(V.timestamp_text(F.col("t"))).collect()] == [at("2026-01-01 00:00:00.123456"), None, at("2026-01-01 00:00:00"), None]
    objects = spark.createDataFrame([('{"a":1}',), ('{"a":1,"a":2}',), ("[1]",), ('{"a":NaN}',), (None,)], "t string")
    assert [r[0] for r in objects.select(V.strict_object(F.col("t"))).collect()] == [True, False, False, False, False]


def test_identities(spark):
    r = spark.range(1).select(V.identity(F.lit("a"), F.lit("b")), V.hmac_sha256(F.lit("message"), b"key", b"d|")).first()
    assert r[0] == hashlib.sha256(b"a\x1fb").hexdigest() and r[1] == hmac.new(b"key", b"d|message", "sha256").hexdigest()


def test_points_reject_conflicts(spark):
    rows = [('{"steps":{"interval":{"startTime":"2026-09-01T00:00:00Z","endTime":"2026-09-01T00:01:00Z","startUtcOffset":"32400s","endUtcOffset":"32400s"}}}',),
            ('{"steps":{"interval":{"startTime":"2026-09-01T00:01:00Z","endTime":"2026-09-01T00:01:00Z","startUtcOffset":"0s","endUtcOffset":"0s"}},"distance":{"millimeters":"1"}}',), ("{}",)]
    got = health.normalize(health.parse_points(spark.createDataFrame(rows, "body string")), "steps").collect()
    assert [(r.steps, r.reject_reason) for r in got] == [(0.0, None), (0.0, "payload_conflict"), (0.0, "payload_missing")]


def test_quality_rules(spark):
    df = spark.createDataFrame([("a", 1.0, 91.0), ("b", float("nan"), 0.0), ("c", None, None)], "id string, v double, lat double").withColumn("lon", F.lit(0.0))
    got = {(r.id, r.rule) for r in quality.check_rows(df, [*quality.measure_rules("v"), *quality.location_rules("lat", "lon")], "id").collect()}
    assert got == {("a", "latitude_invalid"), ("b", "v_invalid"), ("c", "latitude_invalid")}


def test_base_tables_round_trip_and_replace_touched_months(spark, tmp_path):
    for name in COLUMNS:
        assert KEYS[name][0] in schema(name).fieldNames() and all(f.metadata["comment"] for f in schema(name).fields)
    rows = [("p1", "d", at("2026-01-05 00:00:00"), 1.0, 2.0), ("p2", "d", at("2026-02-05 00:00:00"), 1.0, 2.0)]
    df = spark.createDataFrame(rows, "location_point_id string, device_key string, observed_at timestamp, latitude double, longitude double")
    tables.write_base(df, str(tmp_path), "location_point")
    tables.write_base(df.where("location_point_id = 'p2'").withColumn("latitude", F.lit(9.0)), str(tmp_path), "location_point")
    got = tables.read_base(spark, str(tmp_path), "location_point").orderBy("location_point_id").collect()
    assert [(r.location_point_id, r.latitude) for r in got] == [("p1", 1.0), ("p2", 9.0)]
    tables.publish_generation(spark, str(tmp_path / "g"), "g1", {"a": df, "b": df})
    assert tables.read_generation(spark, str(tmp_path / "g"), "b").count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 3000), st.booleans()), min_size=1, max_size=25))
def test_coverage_and_coalescing_properties(spark, spans):
    base = at("2026-01-01 10:00:00")
    rows = [(base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=a + n), o, float(n)) for a, n, o in spans]
    df = spark.createDataFrame(rows, "start_at timestamp_ntz, end_at timestamp_ntz, observed boolean, v double").withColumn("k", F.lit(1))
    once = intervals.coalesce_intervals(df, ["k"])
    twice = intervals.coalesce_intervals(once, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    covered = intervals.daily_coverage(intervals.split_by_day(df)).collect()
    minutes = lambda keep: len({m for a, n, o in spans if keep(o) for m in range(a, a + n)})
    assert sum(r.total_seconds for r in covered) == 60 * minutes(lambda o: True)
    assert sum(r.observed_seconds or 0 for r in covered) == 60 * minutes(lambda o: o)
    parts = intervals.prorate_by_day(df, "v").agg(F.sum("part_value")).first()[0]
    assert abs(parts - sum(r[3] for r in rows)) < 1e-6


def _message(lat, lon, seconds, extra=""):
    return f'{{"_type":"location","tst":{seconds},"lat":{lat},"lon":{lon}{extra}}}'


def test_location_objects_files_and_rebuild(spark, tmp_path):
    body = _message(1.5, 2.5, 1767225600, ',"motionactivities":[],"secret":"x"')
    rows = [("d", body), ("d", body), ("d", _message(91, 0, 1767225600)), ("d", "[1]"), ("d", None), ("e", _message(0, 0, 1767225660))]
    objects = location.raw_objects(spark.createDataFrame(rows, "device_key string, body string"))
    good = objects.where("reject_reason is null").dropDuplicates(["object_key"])
    assert good.count() == 2 and objects.where("reject_reason is not null").count() == 3
    assert good.where("body like '%secret%'").count() == 0
    location.write_location_raw(objects, str(tmp_path / "sink"))
    stored = spark.read.schema("object_key string, body string, date date").json(str(tmp_path / "sink"))
    location.write_location_raw(objects, str(tmp_path / "sink"), stored)
    assert spark.read.json(str(tmp_path / "sink")).count() == 2
    for r in good.collect():  # one file an object, as devices upload them
        path = tmp_path / "files" / (r.object_key + ".gz")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(r.body.encode()))
    raw = location.read_location_raw(spark, str(tmp_path / "files"))
    assert location.check_raw_keys(raw).count() == 0
    tampered = raw.withColumn("body", F.regexp_replace("body", "1.5", "1.6"))
    assert [r.reject_reason for r in location.check_raw_keys(tampered).collect()] == ["digest_differs"]
    assert location.rebuild(raw, str(tmp_path / "base")).count() == 0
    points = tables.read_base(spark, str(tmp_path / "base"), "location_point").orderBy("latitude").collect()
    assert [(p.latitude, p.motion_activities) for p in points] == [(0.0, None), (1.5, [])]
    with pytest.raises(ValueError):
        location.rebuild(raw, str(tmp_path / "base"))


def test_sync_windows_and_completed_days(spark):
    got = rollup.sync_windows(spark, "2026-01-01 16:00:00", "2026-01-02 16:00:00", {"steps": "utc", "sleep": "civil"}).orderBy("data_type").collect()
    assert [(r.start_at, r.end_at) for r in got] == [(at("2026-01-02 00:00:00"), at("2026-01-04 00:00:00")), (at("2026-01-01 16:00:00"), at("2026-01-02 16:00:00"))]
    days = rollup.completed_days(spark, "2026-01-03 16:00:00").orderBy("day").collect()
    assert [(r.day, r.start_at) for r in days] == [(dt.date(2026, 1, 2), at("2026-01-01 15:00:00")), (dt.date(2026, 1, 3), at("2026-01-02 15:00:00"))]


def test_relations_and_inventory_keys(spark):
    spark.range(3).createOrReplaceTempView("there")
    assert [r.available for r in quality.check_relations(spark, ["missing_relation", "there"]).orderBy("relation").collect()] == [False, True]


def test_deliveries_reject_what_does_not_fit(spark):
    ok = '[{"data":{"healthUserId":"u","dataType":"heart-rate","version":"1","operation":"UPSERT","intervals":[{"physicalTimeInterval":{"startTime":"2026-01-01T00:00:30Z","endTime":"2026-01-01T00:01:10Z"}}]}}]'
    civil = '{"civilIso8601TimeInterval":{"startTime":"2026-01-01T00:00:00","endTime":"2026-01-02T00:00:00"},"civilDateTimeInterval":{"startDateTime":{"date":{"year":2026,"month":1,"day":%d}},"endDateTime":{"date":{"year":2026,"month":1,"day":2}}}}'
    wrap = lambda i, v="1": '[{"data":{"healthUserId":"u","dataType":"steps","version":"%s","operation":"UPSERT","intervals":[%s]}}]' % (v, i)
    bodies = [(ok,), (wrap(civil % 1),), (wrap(civil % 2),), (wrap(civil % 1, "2"),), ("nope",)]
    got = notify.explode_deliveries(spark.createDataFrame(bodies, "body string")).collect()
    assert [r.reject_reason for r in got] == [None, None, "civil_forms_differ", "version_unknown", "delivery_malformed"]
    assert (got[0].start_at, got[0].end_at) == (at("2026-01-01 00:00:00"), at("2026-01-01 00:02:00"))


def test_drain_gives_the_same_units_in_one_batch_or_many(spark, tmp_path):
    rows = [(k, 1, "steps", "utc", at(f"2026-01-01 {k:02d}:00:00"), at(f"2026-01-01 {k:02d}:30:00"), at("2026-01-02 00:00:00")) for k in range(6)]
    rows.append((6, 1, "steps", "utc", at("2026-01-01 06:00:00"), at("2026-01-09 00:00:00"), at("2026-01-02 00:00:00")))
    rows.append((7, 1, "steps", "utc", at("2026-01-03 00:00:00"), at("2026-01-03 01:00:00"), at("2026-01-02 00:00:00")))  # starts after it was received
    frame = spark.createDataFrame(rows, notify.MESSAGE)
    results = []
    for files_at_once in (1, 100):
        root = str(tmp_path / f"n{files_at_once}")
        frame.repartition(4, "message_id").write.json(f"{root}/landed")
        for _ in range(2):  # a second run finds nothing new
            notify.run_drain(notify.stream_notifications(spark, f"{root}/landed", files_at_once), root, f"{root}/cp", "2026-01-05 00:00:00").awaitTermination()
        units = notify.read_units(spark, root).collect()
        results.append(sorted((u.day, u.start_at, u.end_at, tuple(u.messages)) for u in units))
        assert spark.read.parquet(f"{root}/rejected").count() == 1
    assert results[0] and results[0] == results[1]
    # the same messages in other files, one of them with a neighbour that lands later
    frame.repartition(2).write.mode("append").json(f"{root}/landed")
    notify.run_drain(notify.stream_notifications(spark, f"{root}/landed", 1), root, f"{root}/cp", "2026-01-05 00:00:00").awaitTermination()
    assert sorted((u.day, u.start_at, u.end_at, tuple(u.messages)) for u in notify.read_units(spark, root).collect()) == results[0]


def test_no_message_is_lost(spark, tmp_path):
    """Malformed and incomplete messages are kept with a reason, and a neighbour that lands later joins its unit."""
    root = str(tmp_path)
    (tmp_path / "landed").mkdir()
    good = '{"message_id": %d, "subject_key": 1, "data_type": "steps", "time_basis": "utc", "start_at": "2026-01-01T0%d:00:00", "end_at": "2026-01-01T0%d:00:00", "received_at": "2026-01-02T00:00:00"}'
    lands = [[good % (1, 1, 2), "{not json", '{"message_id": 5}'], [good % (2, 2, 3), good % (3, 7, 6)]]
    for k, lines in enumerate(lands):
        (tmp_path / "landed" / f"{k}.json").write_text("\n".join(lines))
        notify.run_drain(notify.stream_notifications(spark, f"{root}/landed"), root, f"{root}/cp", "2026-01-05 00:00:00").awaitTermination()
    reasons = sorted(r.reject_reason for r in spark.read.parquet(f"{root}/rejected").collect())
    assert reasons == ["interval_not_positive", "message_incomplete", "message_malformed"]
    assert [(u.start_at, u.end_at, u.messages) for u in notify.read_units(spark, root).collect()] == [(at("2026-01-01 01:00:00"), at("2026-01-01 03:00:00"), [1, 2])]


def test_names_offsets_and_stages_are_strict(spark):
    steps = '{"dataPointName": "%s", "steps": {"interval": {"startTime": "2026-01-01T00:00:00Z", "endTime": "2026-01-01T00:01:00Z", "startUtcOffset": "%s", "endUtcOffset": "%s"}, "count": "5"}}'
    name = "users/u/dataTypes/steps/dataPoints/p1"
    bodies = [steps % (name, "32400.0s", "32400s"), steps % ("users/u/dataTypes/sleep/dataPoints/p1", "0s", "0s"), steps % ("x/dataPoints/p", "0s", "0s"), steps % ("", "0s", "0s"), steps % (name, "1.5s", "0s")]
    got = health.normalize(health.parse_points(spark.createDataFrame([(b,) for b in bodies], "body string")), "steps").collect()
    assert [r.reject_reason for r in got] == [None, "id_malformed", "id_malformed", None, "offset_malformed"]
    assert got[0].steps_interval_id == "p1" and len(got[3].steps_interval_id) == 64 and got[0].offset_seconds == 32400
    stage = lambda a, z: '{"startTime": "2026-01-01T0%d:00:00Z", "endTime": "2026-01-01T0%d:00:00Z", "startUtcOffset": "0s", "endUtcOffset": "0s", "type": "LIGHT"}' % (a, z)
    sleep = '{"name": "users/u/dataTypes/sleep/dataPoints/s", "sleep": {"interval": {"startTime": "2026-01-01T00:00:00Z", "endTime": "2026-01-01T08:00:00Z", "startUtcOffset": "0s", "endUtcOffset": "0s"}, "stages": [%s]}}'
    bodies = [sleep % ",".join(x) for x in ([stage(3, 4), stage(1, 3)], [stage(1, 3), stage(2, 4)], [stage(1, 2)], [])]
    got = health.normalize(health.parse_points(spark.createDataFrame([(b,) for b in bodies], "body string")), "sleep").collect()
    assert [r.reject_reason for r in got] == [None, "stages_overlap", None, None]


def test_spread_merging_gives_the_rows_of_plain_merging(spark):
    """Long windows over many days, null keys, touching and equal ones."""
    r = random.Random(9)
    base = dt.datetime(2026, 1, 1)
    rows = []
    for k in range(400):
        start = base + dt.timedelta(minutes=r.randrange(60 * 24 * 40))
        length = r.choice([0, 5, 30, 60, 1440, 1440 * 6]) if k % 20 == 0 else r.choice([0, 5, 20])
        rows.append((k, r.choice(["a", "b", None]), start, start + dt.timedelta(minutes=length)))
    df = spark.createDataFrame(rows, "message_id long, data_type string, start_at timestamp_ntz, end_at timestamp_ntz")
    want = intervals.coalesce_intervals(df, ["data_type"], collect="message_id").collect()
    got = intervals.coalesce_spread(df, ["data_type"], collect="message_id").collect()
    key = lambda x: (x.data_type or "", x.start_at, x.end_at, tuple(x.sources))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_location_stream_keeps_a_point_once(spark, tmp_path):
    """Objects that land again, in the same batch or a later one, change nothing; other days and bad objects stay."""
    text = '{"_type":"location","tst":%d,"lat":%d,"lon":2}'
    rows = [("d", text % (1_767_225_600 + 3600 * k, k)) for k in range(40)] + [("d", "{}")]
    objects = location.raw_objects(spark.createDataFrame(rows, "device_key string, body string")).where("body is not null").select("object_key", "body", "date")
    out = []
    for n in (1, 100):
        root = str(tmp_path / str(n))
        for _ in range(2):
            objects.repartition(3).write.mode("append").json(f"{root}/raw")
        files.run_locations(files.stream_location_objects(spark, f"{root}/raw", n), root, f"{root}/cp").awaitTermination()
        out.append(sorted(map(str, files.read_points(spark, root).drop("batch", "day").collect())))
        assert spark.read.parquet(f"{root}/failed").count() == 2
    assert out[0] == out[1] and len(out[0]) == len(set(out[0])) == 40
    root = str(tmp_path / "none")
    objects.where("false").write.json(f"{root}/raw")
    files.run_locations(files.stream_location_objects(spark, f"{root}/raw"), root, f"{root}/cp").awaitTermination()
    assert files.read_points(spark, root).isEmpty()


def test_usage_stream_does_not_depend_on_batches(spark, tmp_path):
    rows = [("s", i % 3, i, "WRITTEN" if i % 4 else "DELETED", f"k{i % 5}") for i in range(24)]
    df = spark.createDataFrame(rows, "segment_key string, record_offset int, record_metadata_offset int, record_state string, event_key string").select(
        "*", F.lit("d").alias("device_key"), F.lit("a").alias("bundle_id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("event_at"), F.lit(True).alias("in_foreground"),
        F.lit(None).cast("boolean").alias("crc_passed"), F.lit("event").alias("record_kind"))
    out = []
    for n in (1, 100):
        root = str(tmp_path / str(n))
        df.repartition(4, "record_metadata_offset").write.parquet(f"{root}/landed")
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", n).parquet(f"{root}/landed")
        files.run_usage(stream, root, f"{root}/cp").awaitTermination()
        out.append(sorted(map(tuple, files.read_usage(spark, root, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)).collect())))
    assert out[0] == out[1] == sorted(map(tuple, sync.adopt_records(df).withColumn("is_valid", F.lit(True)).collect()))


def test_pages_of_points_and_rollups(spark, tmp_path):
    """Points of every page are read; rollups of another type are rejected, those without any value skipped."""
    (tmp_path / "points").mkdir()
    (tmp_path / "rollups").mkdir()
    point = '{"name": "users/u/dataTypes/daily-vo2-max/dataPoints/%d", "dailyVo2Max": {"date": {"year": 2026, "month": "1", "day": 2}, "vo2Max": %s, "estimated": %s}}'
    pages = [[point % (1, "41.5", "true"), point % (2, '"41.5"', "false")], [point % (3, "40", '"true"'), point % (4, "101", "false"), point % (5, "40", "null")]]
    for k, page in enumerate(pages):
        (tmp_path / "points" / f"{k}.json").write_text('{"dataPoints": [\n%s], "nextPageToken": ""}' % ",\n".join(page))
    got = health.normalize(health.read_points(spark, str(tmp_path / "points")), "daily-vo2-max").orderBy("page", "vo2_max_ml_kg_min").collect()
    assert sorted((r.page[-6], str(r.vo2_max_ml_kg_min), str(r.reject_reason)) for r in got) == [
        ("0", "41.5", "None"), ("0", "None", "vo2_max_ml_kg_min_invalid"), ("1", "40.0", "None"), ("1", "40.0", "vo2_max_estimated_invalid"), ("1", "None", "vo2_max_ml_kg_min_invalid")]
    rollup_ = '{"startTime": "2026-01-01T00:0%d:00Z", "endTime": "2026-01-01T00:0%d:00Z"%s}'
    rate = ', "heartRate": {"beatsPerMinuteAvg": %s, "beatsPerMinuteMin": 50, "beatsPerMinuteMax": 70.5}'
    points = [(1, 2, rate % "60"), (2, 3, ""), (3, 4, rate % "60" + ', "steps": {"countSum": "4"}'), (4, 5, ', "floors": {}'), (5, 6, rate % '"60"'), (6, 7, rate % "80")]
    (tmp_path / "rollups" / "0.json").write_text('{"rollupDataPoints": [%s]}' % ",".join(rollup_ % p for p in points))
    got = health.normalize_minutes(health.read_rollups(spark, str(tmp_path / "rollups"))).orderBy("start_at").collect()
    assert [(r.start_at.minute, r.reject_reason) for r in got] == [(1, None), (3, "payload_conflict"), (4, "payload_conflict"), (5, "value_malformed"), (6, "order")]


def test_usage_records_are_read_and_applied(spark, tmp_path):
    """Decoded records from Parquet, changed observations, and a batch of records put into the event table."""
    columns = [c.split()[0] for c in usage_source.RECORD.split(", ")]
    base = dict.fromkeys(columns) | {"device_key": "d", "segment_key": "s", "record_state": "WRITTEN", "bundle_id": "app", "in_foreground": True, "crc_passed": True, "record_kind": "event"}
    rows = [base | {"event_key": k, "record_offset": o, "record_metadata_offset": m, "event_at": at("2026-01-01 00:00:00")} for k, o, m in (("a", 1, 1), ("b", 2, 2))]
    spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], usage_source.RECORD).write.parquet(str(tmp_path / "r"))
    records = usage_source.read_usage_records(spark, str(tmp_path / "r"))
    assert records.columns == columns and records.count() == 2
    known = spark.createDataFrame([("a", "d", "app", at("2026-01-01 00:00:00"), "end", False), ("z", "d", "app", at("2026-01-01 00:00:00"), "end", True)], EVENT)
    after = usage_source.apply_records(known, records, spark.createDataFrame([("z",)], "event_key string"))
    assert sorted((r.event_key, r.state, r.is_valid) for r in after.collect()) == [("a", "start", True), ("b", "start", True), ("z", "end", False)]
    states = spark.createDataFrame([("s", at(f"2026-01-0{n} 00:00:00"), h, "1") for n, h in ((1, "x"), (2, "x"), (3, "y"), (4, "x"))], "segment_key string, observed_at timestamp, content_sha256 string, parser_version string")
    assert [r.observed_at.day for r in usage_source.changed_observations(states).orderBy("observed_at").collect()] == [1, 3, 4]


def test_allowed_keys_must_match(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert [r.n for r in rollup.allowed(df, spark.createDataFrame([("a",), ("a",), ("c",)], "k string"), "k").collect()] == [1]
    with pytest.raises(ValueError, match="allowed"):
        rollup.allowed(df, spark.createDataFrame([("c",)], "k string"), "k", required=True)


def test_event_identity_times_and_digests(spark):
    parts = [F.lit(x) for x in ("d", "s", "app")] + [F.lit(800000000.5).cast("double"), F.lit("in"), F.lit(1)]
    row = spark.range(1).select(V.event_identity(*parts), T.apple_time(F.lit(0.25)), T.apple_time(F.lit(-978307200.0)),
                                *[V.interval_digest(F.array(*[F.struct(F.lit(x).alias("a"), F.lit(x + 1).alias("z")) for x in order])) for order in ((1, 5), (5, 1), (1, 6))]).first()
    assert row[0] == hashlib.sha256("\x1f".join(["d", "s", "app", "8.000000005E8", "in", "1"]).encode()).hexdigest()
    assert row[1] == at("2001-01-01 00:00:00.250000") and row[2] == at("1970-01-01 00:00:00")
    assert row[3] == row[4] != row[5]


def test_health_and_state_rules(spark):
    names = [c.split()[0] for c in COLUMNS["health_daily"].replace("!", "").split(", ")]
    day = dt.date(2026, 1, 1)
    good = {"spo2_average_percent": 97.0, "vo2_max_ml_kg_min": 40.0, "nightly_skin_temperature_celsius": -0.5}
    cases = [good, good | {"spo2_lower_bound_percent": 100.5}, good | {"vo2_max_ml_kg_min": 101.0}, good | {"hrv_rmssd_ms": -1.0}, good | {"respiratory_rate_breaths_per_minute": float("nan")}]
    rows = [tuple({"source_date": day + dt.timedelta(n)} .get(c, case.get(c)) for c in names) for n, case in enumerate(cases)]
    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema("health_daily").fields)
    got = {(r.source_date.day, r.rule) for r in quality.check_rows(spark.createDataFrame(rows, plain), quality.health_rules(), "source_date").collect()}
    assert got == {(2, "spo2_lower_bound_percent_range"), (3, "vo2_max_range"), (4, "hrv_rmssd_ms_invalid"), (5, "respiratory_rate_breaths_per_minute_invalid")}
    hrv = spark.createDataFrame([("a", 1.0, None), ("b", None, None), ("c", None, -2.0)], "id string, rmssd_ms double, sdnn_ms double")
    assert {tuple(r) for r in quality.check_rows(hrv, quality.hrv_rules(), "id").collect()} == {("b", "hrv_empty"), ("c", "sdnn_ms_invalid")}
    states = spark.createDataFrame([("a", "start"), ("b", "on"), ("c", None)], "id string, state string")
    assert {tuple(r) for r in quality.check_rows(states, quality.state_rules(), "id").collect()} == {("b", "state_unknown"), ("c", "state_unknown")}
