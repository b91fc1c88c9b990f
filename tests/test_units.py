"""The unit ledger, admission, order and the stored table, against plain loops and by the parts that they touch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lifespans.sources.parts import KeyedTable, Parts
from lifespans.streaming import units

START = datetime(2024, 1, 1)


def frame(spark, rows):
    """Units of (key, source, position, bytes)."""
    return spark.createDataFrame([(k, s, p, START, START + timedelta(hours=1), b, 0) for k, s, p, b in rows], units.UNIT)


def landed(spark, path, df):
    df.write.mode("append").parquet(path)
    return spark.read.schema(units.UNIT).parquet(path)


def ledger(spark, tmp_path, bad=lambda: set(), log=None, **options):
    def check(taken):
        return taken.where(F.col("unit_key").isin(sorted(bad()) or [""])).select("unit_key", F.lit("broken").alias("reason"))

    def commit(good, generation):
        if log is not None:
            log.append((generation, [r.unit_key for r in good.orderBy("position", "unit_key").collect()]))

    return units.Ledger(Parts(spark, str(tmp_path / "ledger")), check, commit, **options)


def test_a_failed_unit_stops_no_other_and_is_tried_again(spark, tmp_path):
    bad, log = {"b", "d"}, []
    own = ledger(spark, tmp_path, lambda: bad, log)
    new = landed(spark, str(tmp_path / "in"), frame(spark, [(k, "s", i, 1) for i, k in enumerate("abcd")]))
    assert own.turn(new, 1) == 4
    state = lambda: {r.unit_key: (r.state, r.tries, r.reason) for r in own.open_units().collect()}
    assert state() == {"b": ("failed", 1, "broken"), "d": ("failed", 1, "broken")}
    assert {r.unit_key: r.tries for r in own.done_units().collect()} == {"a": 1, "c": 1}
    own.turn(new, 2)  # redelivered: nothing done is done again
    assert state() == {"b": ("failed", 2, "broken"), "d": ("failed", 2, "broken")} and log[-1] == (2, [])
    bad.discard("b")
    own.turn(new, 3)
    own.turn(new, 3)  # a turn that runs again gives the same
    assert state() == {"d": ("failed", 3, "broken")}
    assert {r.unit_key: (r.tries, r.turn) for r in own.done_units().collect()} == {"a": (1, 1), "c": (1, 1), "b": (3, 3)}
    assert own.work_off() == 1 and state()["d"][1] == 4


def test_caps_carry_the_rest_over(spark, tmp_path):
    r, log = random.Random(1), []
    rows = [(f"u{k:03d}", "s", k, r.choice([1, 5, 40, 200])) for k in range(16)]
    own = ledger(spark, tmp_path, log=log, max_units=7, max_bytes=100)
    own.turn(landed(spark, str(tmp_path / "in"), frame(spark, rows)), 10)
    turns = own.work_off()
    assert own.open_units().isEmpty() and turns + 1 == len(log)
    want, left = [], sorted(rows)
    while left:  # greedy, in order
        take, size = [], 0
        for row in left[:7]:
            if take and size + row[3] > 100:
                break
            take.append(row[0])
            size += row[3]
        want.append(take)
        left = left[len(take) :]
    assert [keys for _, keys in log] == want
    assert own.work_off() == 0


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_only_units_without_a_gap_are_in_turn(spark, block):
    r = random.Random(block)
    rows, nexts = [], {f"s{k}": r.randrange(4) for k in range(8)}
    for s in [*nexts, "new"]:
        rows += [(f"{s}-{p}", s, p, 1) for p in range(15) if r.random() < 0.8]
    got = {x.unit_key for x in units.in_turn(frame(spark, rows), spark.createDataFrame(list(nexts.items()), "source string, next bigint"), block).collect()}
    want, have = set(), {(s, p) for _, s, p, _ in rows}
    for s in [*nexts, "new"]:
        p = nexts.get(s, 0)
        while (s, p) in have:
            want.add(f"{s}-{p}")
            p += 1
    assert got == want


def test_nothing_overtakes_within_a_source(spark, tmp_path):
    bad, log = {"x1"}, []
    own = ledger(spark, tmp_path, lambda: bad, log, ordered=True)
    path = str(tmp_path / "in")
    own.turn(landed(spark, path, frame(spark, [("x2", "x", 2, 1), ("y1", "y", 1, 1), ("x0", "x", 0, 1)])), 1)
    assert log == [(1, ["x0"])]  # x1 and y0 are not there yet
    own.turn(landed(spark, path, frame(spark, [("x1", "x", 1, 1), ("y0", "y", 0, 1), ("x3", "x", 3, 1)])), 2)
    assert log[-1] == (2, ["y0", "y1"])
    assert {r.unit_key: (r.state, r.tries) for r in own.open_units().collect()} == {"x1": ("failed", 1), "x2": ("deferred", 0), "x3": ("deferred", 0)}
    bad.clear()
    own.work_off()
    assert log[-1] == (own.parts.generations()[-1], ["x1", "x2", "x3"]) and own.open_units().isEmpty()


SCHEMA = "id string, subject int, at timestamp_ntz, value int"


def plain_replace(table, incoming, ranges):
    gone = {k for k, (s, at, _) in table.items() if any(s == x and a <= at < z for x, a, z in ranges)}
    after = {k: v for k, v in table.items() if k not in gone} | {r[0]: r[1:] for r in incoming}
    actions = {k: "delete" for k in gone if k not in after} | {r[0]: "insert" if r[0] not in table else "update" for r in incoming if table.get(r[0]) != r[1:]}
    return after, actions


@pytest.mark.parametrize("seed", range(2))
def test_stored_ranges_are_replaced_as_in_a_plain_table(spark, tmp_path, seed):
    r = random.Random(seed)
    table = KeyedTable(Parts(spark, str(tmp_path / "t")), SCHEMA, "id", "at", ("subject",), index_parts=8)
    plain = {}
    for generation in range(1, 4):
        days = sorted(r.sample(range(12), 2))
        ranges = [(s, START + timedelta(days=d, hours=r.choice([0, 6])), START + timedelta(days=d + 1)) for d in days for s in r.sample(range(3), 2)]
        incoming = [(f"k{k}", s, (a + timedelta(minutes=r.randrange(300))), r.randrange(3)) for k in r.sample(range(60), 8) for s, a, _ in [r.choice(ranges)]]
        df = spark.createDataFrame(incoming, SCHEMA)
        spans = spark.createDataFrame(ranges, "subject int, start_at timestamp_ntz, end_at timestamp_ntz")
        plain, actions = plain_replace(plain, incoming, ranges)
        for _ in range(1 + (generation == 2)):  # a generation that runs again gives the same
            table.reconcile(df, spans, generation)
            assert {x.id: tuple(x)[1:] for x in table.read().collect()} == plain
            assert {x.id: x.action for x in table.changes(generation).collect()} == actions
    table.parts.forget()
    assert {x.id: tuple(x)[1:] for x in table.read().collect()} == plain and table.parts.generations() == [2, 3]


def test_only_touched_days_are_scanned_and_written(spark, tmp_path):
    table = KeyedTable(Parts(spark, str(tmp_path / "t")), SCHEMA, "id", "at", ("subject",), index_parts=4)
    days = [START + timedelta(days=d) for d in range(30)]
    whole = spark.createDataFrame([(f"k{d}", 1, at, d) for d, at in enumerate(days)], SCHEMA)
    table.reconcile(whole, spark.createDataFrame([(1, days[0], days[0] + timedelta(hours=1))], "subject int, start_at timestamp_ntz, end_at timestamp_ntz"), 1)
    scanned = []
    read = Parts.read

    def watched(self, name, schema, generation, parts=None):
        scanned.append((name, None if parts is None else sorted(parts)))
        return read(self, name, schema, generation, parts)

    Parts.read = watched
    try:
        # k7 moves from day 7 to day 3: days 3 (range and rows) and 7 (where the index knows the key)
        table.reconcile(spark.createDataFrame([("k7", 1, days[3] + timedelta(hours=2), 70)], SCHEMA), spark.createDataFrame([(1, days[3], days[4])], "subject int, start_at timestamp_ntz, end_at timestamp_ntz"), 2)
    finally:
        Parts.read = read
    assert ("rows", ["2024-01-04", "2024-01-08"]) in scanned and all(p is not None for _, p in scanned)
    assert {p: g for p, g in table.parts.manifest(2)["rows"].items() if g == 2} == {"2024-01-04": 2} and "2024-01-08" not in table.parts.manifest(2)["rows"]
    assert {x.id: x.action for x in table.changes(2).collect()} == {"k3": "delete", "k7": "update"} and table.read().count() == 29
    plan = table.read(["2024-01-04"])._jdf.queryExecution().executedPlan().toString()
    assert table.read(["2024-01-04"]).inputFiles() and all("2024-01-04" in f for f in table.read(["2024-01-04"]).inputFiles()) and "2024-01-05" not in plan


def test_units_that_acquire_ranges(spark, tmp_path):
    """Bad acquisitions leave their range as it was; corrections of a range replace it later."""
    table = KeyedTable(Parts(spark, str(tmp_path / "t")), SCHEMA, "id", "at", ("subject",))
    hour = lambda d, h: START + timedelta(days=d, hours=h)
    make = lambda rows: spark.createDataFrame(rows, f"unit_key string, reject_reason string, {SCHEMA}")
    rows = [("a", None, "i1", 1, hour(0, 1), 1), ("a", None, "i2", 1, hour(0, 2), 1), ("b", "value_malformed", "i3", 2, hour(0, 1), 1), ("c", None, "i4", 1, hour(5, 1), 1), ("d", None, "i5", 2, hour(1, 3), 1)]
    snaps = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", False)], "unit_key string, complete boolean")
    todo = [("a", "1", 0), ("b", "2", 0), ("c", "1", 1), ("d", "2", 1), ("e", "2", 2)]
    new = landed(spark, str(tmp_path / "in"), spark.createDataFrame([(k, s, d, hour(d, 0), hour(d + 1, 0), 1, 0) for k, s, d in todo], units.UNIT))
    check, commit = units.acquisition(table, "subject", snaps, make(rows))
    own = units.Ledger(Parts(spark, str(tmp_path / "ledger")), check, commit)
    own.turn(new, 1)
    assert {r.unit_key: r.reason for r in own.open_units().collect()} == {"b": "value_malformed", "c": "outside_range", "d": "range_incomplete", "e": "not_acquired"}
    assert {r.id for r in table.read().collect()} == {"i1", "i2"}
    later = landed(spark, str(tmp_path / "later"), spark.createDataFrame([("a2", "1", 9, hour(0, 0), hour(1, 0), 1, 1)], units.UNIT))
    own.check, own.commit = units.acquisition(table, "subject", spark.createDataFrame([("a2", True), ("b", True)], "unit_key string, complete boolean"), make([("a2", None, "i2", 1, hour(0, 2), 5), ("b", None, "i3", 2, hour(0, 1), 1)]))
    own.turn(later, 2)
    assert {(r.id, r.value) for r in table.read().collect()} == {("i2", 5), ("i3", 1)}


def test_a_drain_and_a_usage_stream_touch_their_own_parts(spark, tmp_path, monkeypatch):
    """However many batches came before, a batch writes the parts of its own days, slots and events, and old versions go."""
    from lifespans.streaming import files, notify

    monkeypatch.setattr(notify, "KEPT", 2)
    root = str(tmp_path / "n")
    for k in range(5):
        at = START + timedelta(days=k % 3, hours=k)
        frame = spark.createDataFrame([(k, 1, "steps", "utc", at, at + timedelta(minutes=30), START + timedelta(days=9))], notify.MESSAGE)
        frame.coalesce(1).write.mode("append").json(f"{root}/landed")
        notify.run_drain(notify.stream_notifications(spark, f"{root}/landed"), root, f"{root}/cp", "2024-02-01 00:00:00", zone="UTC").awaitTermination()
    state = Parts(spark, f"{root}/state")
    assert len(state.generations()) == notify.KEPT and state.generations()[-1] == 5
    newest = state.manifest(5)["pieces"]
    assert sorted(newest.values()) == [3, 4, 5] and len(newest) == 3
    assert len(list((tmp_path / "n" / "state" / "pieces").glob("gen=*/_part=*"))) <= notify.KEPT + 3
    assert notify.read_units(spark, root).count() == 5

    shape = "segment_key string, record_offset int, record_metadata_offset int, record_state string, event_key string, device_key string, bundle_id string, event_at timestamp_ntz, in_foreground boolean, crc_passed boolean, record_kind string"
    record = lambda s, v, e: ("s", s, v, "WRITTEN", e, "d", "a", START, True, None, "event")
    root = str(tmp_path / "u")
    for n, rows in enumerate([[record(k, 0, f"e{k}") for k in range(40)], [record(3, 1, "other")]]):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        files.run_usage(spark.readStream.schema(shape).parquet(f"{root}/landed"), root, f"{root}/cp").awaitTermination()
    state = Parts(spark, f"{root}/state")
    second = {name: [p for p, g in parts.items() if g == 2] for name, parts in state.manifest(2).items()}
    assert len(second["slots"]) == 1 and 1 <= len(second["events"]) <= 2 and len(second["claims"]) <= 2
    assert {r.event_key for r in files.read_usage(spark, root, shape).collect()} == {f"e{k}" for k in range(40) if k != 3} | {"other"}
