"""Queries of raw inputs and their normalizers: JSON is built from the events table and read back by the rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import time as T
from ..functions import values as V
from ..operators import quality, rollup
from ..sources import health, location, usage
from ..sources.tables import read_base
from ..streaming import files
from ..streaming.notify import scratch_root
from . import datasets as D

QUERIES: dict = {}


def _query(name: str, sql: str | None):
    def add(run):
        QUERIES[name] = (run, sql)
        return run

    return add


def _utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _text(c: Column) -> Column:
    return c.cast("string")




def _interval() -> Column:
    later = F.timestamp_add("SECOND", F.col("event_id") % 5 * 60, F.col("ts"))
    return F.struct(_utc(F.col("ts")).alias("startTime"), _utc(later).alias("endTime"), F.lit("32400s").alias("startUtcOffset"), F.lit("32400s").alias("endUtcOffset"))


def _sample() -> Column:
    return F.struct(_utc(F.col("ts")).alias("physicalTime"), F.lit("32400s").alias("utcOffset"))


def _date() -> Column:
    day = lambda f: _text(f(F.col("ts")))
    return F.struct(day(F.year).alias("year"), day(F.month).alias("month"), day(F.dayofmonth).alias("day"))


def _whole(k: int) -> Column:
    return _text(F.col("event_id") % k)


_SPAN = "ts AS start_at, ts + to_seconds(event_id % 5 * 60) AS end_at, CAST(ts + INTERVAL 9 HOUR AS DATE) AS source_date, 32400 AS offset_seconds"
_AT = "ts AS sample_at, CAST(ts + INTERVAL 9 HOUR AS DATE) AS source_date, 32400 AS offset_seconds"
_DAY = "CAST(ts AS DATE) AS source_date"
_POSITIVE = "event_id % 5 <> 0"


def _value() -> Column:
    return F.col("value")


def _either(good: Column, value: Column, bad) -> Column:
    """``value`` where ``good``, else ``bad``, whatever their JSON types."""
    return F.when(good, value.cast("variant")).otherwise(F.lit(bad).cast("variant"))


#: Per kind: payload fields (built inside a session), columns to compare, their SQL, and the SQL of what is accepted.
_CASES = {
    "steps": (lambda: [_interval().alias("interval"), F.when(F.col("event_id") % 3 != 0, _whole(500)).alias("count")], ["steps"],
              f"{_SPAN}, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE CAST(event_id % 500 AS DOUBLE) END AS steps", _POSITIVE),
    "active-zone-minutes": (lambda: [_interval().alias("interval"), _whole(90).alias("activeZoneMinutes"), F.when(F.col("event_type") == "view", "CARDIO").when(F.col("event_type") == "click", "PEAK").otherwise("mystery").alias("heartRateZone")],
                            ["active_zone_minutes", "category"], f"{_SPAN}, CAST(event_id % 90 AS DOUBLE) AS active_zone_minutes, CASE event_type WHEN 'view' THEN 'cardio' ELSE 'peak' END AS category", f"{_POSITIVE} AND event_type IN ('view', 'click')"),
    "sleep": (lambda: [_interval().alias("interval"), F.upper("event_type").alias("type"), F.struct(_whole(480).alias("minutesAsleep"), F.when(F.col("event_id") % 2 == 0, _whole(30)).alias("minutesAwake")).alias("summary"),
                       F.struct(F.when(F.col("event_id") % 4 != 1, _either(F.col("event_id") % 11 != 0, F.col("event_id") % 2 == 0, "true")).alias("mainSleep")).alias("metadata")], ["sleep_minutes", "awake_minutes", "sleep_type", "is_main_sleep"],
              f"{_SPAN.replace('ts + INTERVAL 9 HOUR AS', 'ts + to_seconds(event_id % 5 * 60) + INTERVAL 9 HOUR AS')}, CAST(event_id % 480 AS DOUBLE) AS sleep_minutes, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 30 AS DOUBLE) END AS awake_minutes, event_type AS sleep_type, CASE WHEN event_id % 4 <> 1 THEN event_id % 2 = 0 END AS is_main_sleep", f"{_POSITIVE} AND (event_id % 4 = 1 OR event_id % 11 <> 0)"),
    "daily-resting-heart-rate": (lambda: [_date().alias("date"), _whole(320).alias("beatsPerMinute")], ["resting_heart_rate_bpm"], f"{_DAY}, CAST(event_id % 320 AS DOUBLE) AS resting_heart_rate_bpm", "event_id % 320 BETWEEN 1 AND 300"),
    "daily-heart-rate-variability": (lambda: [_date().alias("date"), F.when(F.col("event_id") % 2 == 0, _value()).alias("averageHeartRateVariabilityMilliseconds"), F.when(F.col("event_id") % 3 == 0, _whole(99)).alias("nonRemHeartRateBeatsPerMinute")],
                                     ["hrv_rmssd_ms", "non_rem_heart_rate_bpm"], f"{_DAY}, CASE WHEN event_id % 2 = 0 THEN value END AS hrv_rmssd_ms, CASE WHEN event_id % 3 = 0 THEN event_id % 99 END AS non_rem_heart_rate_bpm", "event_id % 2 = 0 OR event_id % 3 = 0"),
    "daily-respiratory-rate": (lambda: [_date().alias("date"), _either(F.col("event_id") % 7 != 0, _value(), "12.5").alias("breathsPerMinute")], ["respiratory_rate_breaths_per_minute"], f"{_DAY}, value AS respiratory_rate_breaths_per_minute", "event_id % 7 <> 0"),
    "daily-oxygen-saturation": (lambda: [_date().alias("date"), _value().alias("averagePercentage"), F.lit(90).alias("lowerBoundPercentage"), F.lit(99.5).alias("upperBoundPercentage")],
                                ["spo2_average_percent", "spo2_lower_bound_percent", "spo2_upper_bound_percent"], f"{_DAY}, value AS spo2_average_percent, 90.0::DOUBLE AS spo2_lower_bound_percent, 99.5::DOUBLE AS spo2_upper_bound_percent", "value <= 100"),
    "daily-sleep-temperature-derivations": (lambda: [_date().alias("date"), (-F.col("value")).alias("nightlyTemperatureCelsius"), F.when(F.col("event_id") % 2 == 0, _value()).alias("relativeNightlyStddev30dCelsius")],
                                            ["nightly_skin_temperature_celsius", "relative_nightly_stddev_30d_celsius"], f"{_DAY}, -value AS nightly_skin_temperature_celsius, CASE WHEN event_id % 2 = 0 THEN value END AS relative_nightly_stddev_30d_celsius", "TRUE"),
    "daily-vo2-max": (lambda: [_date().alias("date"), _value().alias("vo2Max"), _either(F.col("event_id") % 13 != 0, F.col("event_id") % 2 == 0, "true").alias("estimated"), F.col("event_type").alias("cardioFitnessLevel")],
                      ["vo2_max_ml_kg_min", "vo2_max_estimated", "cardio_fitness_level"], f"{_DAY}, value AS vo2_max_ml_kg_min, event_id % 2 = 0 AS vo2_max_estimated, event_type AS cardio_fitness_level", "value <= 100 AND event_id % 13 <> 0"),
    "heart-rate-variability": (lambda: [_sample().alias("sampleTime"), _value().alias("rootMeanSquareOfSuccessiveDifferencesMilliseconds")], ["rmssd_ms"], f"{_AT}, value AS rmssd_ms", "TRUE"),
    "respiratory-rate-sleep-summary": (lambda: [_sample().alias("sampleTime"), F.struct(_value().alias("breathsPerMinute"), (-F.col("value")).alias("signalToNoise")).alias("fullSleepStats"),
                                                F.when(F.col("event_id") % 2 == 0, F.struct((F.col("event_id") % 40).alias("breathsPerMinute"))).alias("deepSleepStats")], ["full_breaths_per_minute", "full_signal_to_noise", "deep_breaths_per_minute"],
                                       f"{_AT}, value AS full_breaths_per_minute, -value AS full_signal_to_noise, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 40 AS DOUBLE) END AS deep_breaths_per_minute", "TRUE"),
    "exercise": (lambda: [_interval().alias("interval"), F.upper("event_type").alias("exerciseType"), F.col("event_type").alias("displayName"), F.concat(_whole(900), F.lit(".5s")).alias("activeDuration")], ["exercise_type", "exercise_name", "active_seconds"],
                 f"{_SPAN}, upper(event_type) AS exercise_type, event_type AS exercise_name, event_id % 900 + 0.5::DOUBLE AS active_seconds", _POSITIVE),
    "sedentary-period": (lambda: [_interval().alias("interval")], [], _SPAN, _POSITIVE),
    "distance": (lambda: [_interval().alias("interval"), F.when(F.col("event_id") % 3 != 0, _whole(5000)).alias("millimeters")], ["distance_meters"], f"{_SPAN}, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE event_id % 5000 / 1000.0 END AS distance_meters", _POSITIVE),
    "time-in-heart-rate-zone": (lambda: [_interval().alias("interval"), F.col("event_type").alias("heartRateZoneType")], ["zone"], f"{_SPAN}, event_type AS zone", _POSITIVE),
}


def _point(kind: str) -> Column:
    """An event as a point of this kind."""
    name = F.concat(F.lit(f"users/u/dataTypes/{kind}/dataPoints/p-"), _text(F.col("event_id")))
    return F.struct(name.alias("dataPointName"), F.struct(*_CASES[kind][0]()).alias(health.PAYLOADS[kind][0]))


def _normalized(kind: str):
    _, columns, sql, accepted = _CASES[kind]

    def run(spark, sf_dir):
        body = F.to_json(_point(kind))
        points = health.parse_points(D.table(spark, sf_dir, "events").select("event_id", body.alias("body")), kind=kind)
        rows = health.normalize(points, kind).where("reject_reason is null")
        times = [c for c in ("start_at", "end_at", "sample_at", "source_date", "offset_seconds") if c in rows.columns]
        return rows.select("event_id", *times, *columns)

    return run, f"SELECT event_id, {sql} FROM events WHERE {accepted}"


for _kind in _CASES:
    QUERIES[f"normalize_{_kind.replace('-', '_')}"] = _normalized(_kind)


def _minute_point() -> Column:
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    start = F.when(F.col("event_id") % 6 == 0, F.timestamp_add("SECOND", F.lit(1), minute)).otherwise(minute)
    lowest = _either(F.col("event_id") % 25 != 1, F.col("value") * 0.5, "0")
    stats = F.struct(_value().alias("beatsPerMinuteAvg"), lowest.alias("beatsPerMinuteMin"), (F.col("value") * 2).alias("beatsPerMinuteMax"))
    other = F.when(F.col("event_id") % 10 == 0, F.struct(F.lit("1").alias("countSum")))
    return F.struct(_utc(start).alias("startTime"), _utc(F.timestamp_add("MINUTE", F.lit(1), start)).alias("endTime"), stats.alias("heartRate"), other.alias("steps"))


_MINUTES = """SELECT date_trunc('minute', ts) AS start_at, value AS mean_bpm, value * 0.5 AS min_bpm, value * 2 AS max_bpm FROM events
WHERE event_id % 6 <> 0 AND event_id % 10 <> 0 AND event_id % 25 <> 1"""


@_query("normalize_heart_rate_minute", _MINUTES)
def normalize_minutes(spark, sf_dir):
    rows = health.normalize_minutes(health.parse_rollups(D.table(spark, sf_dir, "events").select(F.to_json(_minute_point()).alias("body"))))
    return rows.where("reject_reason is null").select("start_at", "mean_bpm", "min_bpm", "max_bpm")


def _pages(spark, sf_dir, point: Column, field: str) -> str:
    """A folder of page files, each with the points of a thousand event ids."""
    path = f"{scratch_root(spark)}/pages"
    pages = D.table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 1000).alias("page")).agg(F.collect_list(point).alias(field))
    pages.select("page", F.to_json(F.struct(field, F.lit("").alias("nextPageToken"))).alias("value")).write.partitionBy("page").text(path)
    return path


@_query("point_pages", f"SELECT 'p-' || CAST(event_id AS VARCHAR) AS steps_interval_id, event_id // 1000 AS page, {_CASES['steps'][2]} FROM events WHERE {_POSITIVE}")
def point_pages(spark, sf_dir):
    """Pages of points as files, read back and normalized."""
    points = health.read_points(spark, _pages(spark, sf_dir, _point("steps"), "dataPoints"), "steps")
    rows = health.normalize(points, "steps").where("reject_reason is null")
    page = F.regexp_extract("page", r"page=(\d+)", 1).cast("long").alias("page")
    return rows.select("steps_interval_id", page, "start_at", "end_at", "source_date", "offset_seconds", "steps")


@_query("rollup_pages", _MINUTES)
def rollup_pages(spark, sf_dir):
    """Pages of minute rollups as files, read back and normalized."""
    rows = health.normalize_minutes(health.read_rollups(spark, _pages(spark, sf_dir, _minute_point(), "rollupDataPoints")))
    return rows.where("reject_reason is null").select("start_at", "mean_bpm", "min_bpm", "max_bpm")


@_query("normalize_sleep_details", """SELECT event_id, k.kind, CASE k.kind WHEN 'sleep-stage' THEN 'light' ELSE 'short-awakening' END AS category, ts AS start_at,
  ts + to_seconds(event_id % 5 * 60) AS end_at FROM events, (VALUES ('sleep-stage'), ('sleep-wake')) k(kind) WHERE event_id % 5 <> 0""")
def normalize_sleep_details(spark, sf_dir):
    i = _interval()
    stage = F.struct(i["startTime"].alias("startTime"), i["endTime"].alias("endTime"), i["startUtcOffset"].alias("startUtcOffset"), i["endUtcOffset"].alias("endUtcOffset"), F.lit("LIGHT").alias("type"))
    wake = F.struct(i["startTime"].alias("startTime"), i["endTime"].alias("endTime"))
    sleep = F.struct(i.alias("interval"), F.array(stage).alias("stages"), F.array(wake).alias("shortAwakenings"))
    name = F.concat(F.lit("users/u/dataTypes/sleep/dataPoints/"), _text(F.col("event_id")))
    body = F.to_json(F.struct(name.alias("dataPointName"), sleep.alias("sleep")))
    points = health.parse_points(D.table(spark, sf_dir, "events").select(body.alias("body")), kind="sleep")
    rows = health.normalize_sleep_details(points).where("reject_reason is null")
    return rows.select(F.col("sleep_session_id").cast("bigint").alias("event_id"), "kind", "category", "start_at", "end_at")


def _messages(spark, sf_dir):
    """A location message an event; some lie outside the globe, some hold the same key twice."""
    lat, lon = F.col("event_id") % 200 - 100, F.col("event_id") % 340 - 170
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    twice = F.when(F.col("event_id") % 50 == 7, F.lit(',"lat":1')).otherwise("")
    body = F.concat(F.lit('{"_type":"location","tst":'), _text(seconds), F.lit(',"lat":'), _text(lat), F.lit(',"lon":'), _text(lon), F.lit(',"acc":'), _text(F.col("user_id")), F.lit(',"extra":1'), twice, F.lit("}"))
    return D.table(spark, sf_dir, "events").select(F.concat(F.lit("d"), _text(F.col("user_id"))).alias("device_key"), body.alias("body"))


_LOCATIONS = """SELECT DISTINCT sha256('d' || CAST(user_id AS VARCHAR)) AS device_key, date_trunc('second', ts) AS observed_at, CAST(event_id % 200 - 100 AS DOUBLE) AS latitude,
  CAST(event_id % 340 - 170 AS DOUBLE) AS longitude, CAST(user_id AS DOUBLE) AS accuracy_meters FROM events WHERE event_id % 200 - 100 BETWEEN -90 AND 90 AND event_id % 50 <> 7"""


@_query("location_points", _LOCATIONS)
def location_points(spark, sf_dir):
    raw = location.raw_objects(_messages(spark, sf_dir)).where("reject_reason is null").dropDuplicates(["object_key"])
    rows = location.location_points(raw.select("object_key", "body"))
    return rows.where("reject_reason is null").select("device_key", "observed_at", "latitude", "longitude", "accuracy_meters")


@_query("location_rejects", """SELECT CASE WHEN event_id % 50 = 7 THEN 'json_invalid' ELSE 'latitude_invalid' END AS reject_reason, count(*) AS n FROM events
WHERE event_id % 50 = 7 OR event_id % 200 - 100 NOT BETWEEN -90 AND 90 GROUP BY 1""")
def location_rejects(spark, sf_dir):
    objects = location.raw_objects(_messages(spark, sf_dir)).where("reject_reason is not null")
    return objects.groupBy("reject_reason").agg(F.count("*").alias("n"))


@_query("rebuild_locations", _LOCATIONS)
def rebuild_locations(spark, sf_dir):
    """The table made anew from an inventory of raw objects in any order."""
    raw = location.raw_objects(_messages(spark, sf_dir)).where("reject_reason is null").dropDuplicates(["object_key"])
    root = scratch_root(spark)
    location.rebuild(raw.select("object_key", "body").repartition(7), root)
    return read_base(spark, root, "location_point").select("device_key", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "latitude", "longitude", "accuracy_meters")


@_query("raw_key_checks", """SELECT reject_reason, count(*) AS n FROM (SELECT DISTINCT 'd' || CAST(user_id AS VARCHAR) AS device, date_trunc('second', ts) AS t, event_id % 200 AS a, event_id % 340 AS b, user_id,
  CASE event_id % 200 % 3 WHEN 0 THEN 'digest_differs' WHEN 1 THEN 'key_noncanonical' END AS reject_reason FROM events
  WHERE event_id % 200 - 100 BETWEEN -90 AND 90 AND event_id % 50 <> 7) WHERE reject_reason IS NOT NULL GROUP BY 1""")
def raw_key_checks(spark, sf_dir):
    """Raw objects of which some have another content than their key's digest and some no canonical key."""
    raw = location.raw_objects(_messages(spark, sf_dir)).where("reject_reason is null").dropDuplicates(["object_key"])
    third = (F.get_json_object("body", "$.lat").cast("double") + 100).cast("int") % 3
    body = F.when(third == 0, F.concat("body", F.lit(" "))).otherwise(F.col("body"))
    key = F.when(third == 1, F.regexp_replace("object_key", "raw/location", "raw/other")).otherwise(F.col("object_key"))
    return location.check_raw_keys(raw.select(key.alias("object_key"), body.alias("body"))).groupBy("reject_reason").agg(F.count("*").alias("n"))


@_query("stream_locations", _LOCATIONS)
def stream_locations(spark, sf_dir):
    """Messages written to the raw sink, then streamed into points."""
    root = scratch_root(spark)
    location.write_location_raw(location.raw_objects(_messages(spark, sf_dir)), f"{root}/raw")
    files.run_locations(files.stream_location_objects(spark, f"{root}/raw"), root, f"{root}/checkpoint").awaitTermination()
    return files.read_points(spark, root).select("device_key", "observed_at", "latitude", "longitude", "accuracy_meters")


@_query("stream_usage", f"""WITH {D.SLOT_RECORDS}, tops AS (SELECT *, rank() OVER (PARTITION BY segment_key, record_offset ORDER BY record_metadata_offset DESC) AS rk FROM slot_records),
latest AS (SELECT *, count(*) OVER (PARTITION BY segment_key, record_offset) AS claims FROM tops WHERE rk = 1),
events_ AS (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY segment_key DESC, record_offset DESC) AS n FROM latest
  WHERE claims = 1 AND record_state = 'WRITTEN' AND crc_passed IS DISTINCT FROM FALSE AND event_at IS NOT NULL)
SELECT event_key, device_key, bundle_id, event_at, CASE WHEN in_foreground THEN 'start' ELSE 'end' END AS state FROM events_ WHERE n = 1""")
def stream_usage(spark, sf_dir):
    """Slot records landed as files, streamed in several batches; the events after the last one."""
    root = scratch_root(spark)
    D.slot_records(spark, sf_dir).write.parquet(f"{root}/landed")
    shape = spark.read.parquet(f"{root}/landed").schema
    landed = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1000).parquet(f"{root}/landed")
    files.run_usage(landed, root, f"{root}/checkpoint").awaitTermination()
    return files.read_usage(spark, root, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape)).drop("is_valid")


_ADOPTED = f"""{D.SLOT_RECORDS}, tops AS (SELECT *, rank() OVER (PARTITION BY segment_key, record_offset ORDER BY record_metadata_offset DESC) AS rk FROM slot_records),
latest AS (SELECT *, count(*) OVER (PARTITION BY segment_key, record_offset) AS claims FROM tops WHERE rk = 1),
adopted AS (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY CAST(segment_key AS VARCHAR) DESC, record_offset DESC) AS n FROM latest
  WHERE claims = 1 AND record_state = 'WRITTEN' AND crc_passed IS DISTINCT FROM FALSE AND event_at IS NOT NULL)"""


@_query("usage_records", f"""WITH {_ADOPTED}, a AS (SELECT * FROM adopted WHERE n = 1),
known AS (SELECT DISTINCT event_key, segment_key % 10 = 0 AS gone FROM slot_records WHERE segment_key % 5 = 0)
SELECT event_key, device_key, bundle_id, event_at, CASE WHEN in_foreground THEN 'start' ELSE 'end' END AS state, TRUE AS is_valid FROM a UNION ALL
SELECT event_key, 'd', 'a', TIMESTAMP '2020-01-01', 'end', NOT gone FROM known WHERE event_key NOT IN (SELECT event_key FROM a)""")
def usage_records(spark, sf_dir):
    """Decoded records written and read with their declared schema, then put into an event table of which some events are disproved."""
    path = f"{scratch_root(spark)}/records"
    slots = D.slot_records(spark, sf_dir)
    fields = [c.split() for c in usage.RECORD.split(", ")]
    slots.select(*[(F.col(c) if c in slots.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields]).write.parquet(path)
    old = slots.where("segment_key % 5 = 0").select("event_key", "segment_key").distinct()
    at = F.lit("2020-01-01").cast("timestamp").alias("event_at")
    known = old.select("event_key", F.lit("d").alias("device_key"), F.lit("a").alias("bundle_id"), at, F.lit("end").alias("state"), F.lit(True).alias("is_valid")).distinct()
    after = usage.apply_records(known, usage.read_usage_records(spark, path), old.where("segment_key % 10 = 0").select("event_key"))
    return after.withColumn("event_at", F.col("event_at").cast("timestamp_ntz"))


_SECRET, _DOMAIN = b"a key of this query", b"device:"
_PAD = [bytes(b ^ x for b in _SECRET.ljust(64, b"\0")) for x in (0x36, 0x5C)]
_BLOB = ["".join(f"\\x{b:02X}" for b in x) for x in (_PAD[0] + _DOMAIN, _PAD[1])]


@_query("identities", f"""SELECT event_id, sha256('owner' || chr(31) || 'steps' || chr(31) || event_type || chr(31) || CAST(user_id AS VARCHAR)) AS stable_id,
  sha256('["owner","heart-rate","' || event_type || CAST(user_id AS VARCHAR) || '"]') AS array_id, sha256(event_type || ':' || CAST(user_id AS VARCHAR)) AS logical_id,
  sha256(concat_ws(chr(31), 'd' || CAST(user_id AS VARCHAR), 'stream', event_type, CAST(event_id AS VARCHAR), 'in', '1')) AS event_key,
  TIMESTAMP '2001-01-01' + to_microseconds(event_id * 250000) AS apple_at,
  sha256('{_BLOB[1]}'::BLOB || unhex(sha256('{_BLOB[0]}'::BLOB || encode(CAST(user_id AS VARCHAR))))) AS pseudonym,
  sha256('[{{"a":' || CAST(event_id AS VARCHAR) || ',"z":1}},{{"a":' || CAST(event_id + 1 AS VARCHAR) || ',"z":2}}]') AS digest FROM events""")
def identities(spark, sf_dir):
    """Every identity and digest of an event."""
    text, user = F.lit, _text(F.col("user_id"))
    one, two = (F.struct((F.col("event_id") + k).alias("a"), F.lit(k + 1).alias("z")) for k in (0, 1))
    either = F.when(F.col("event_id") % 2 == 0, F.array(one, two)).otherwise(F.array(two, one))  # the order doesn't matter
    return D.table(spark, sf_dir, "events").select(
        "event_id", V.identity(text("owner"), text("steps"), F.col("event_type"), user).alias("stable_id"),
        V.json_identity(text("owner"), text("heart-rate"), F.concat("event_type", user)).alias("array_id"), V.location_id(F.col("event_type"), user).alias("logical_id"),
        V.event_identity(F.concat(text("d"), user), text("stream"), F.col("event_type"), F.col("event_id"), text("in"), text(1)).alias("event_key"),
        T.apple_time(F.col("event_id") * 0.25).cast("timestamp_ntz").alias("apple_at"), V.hmac_sha256(user, _SECRET, _DOMAIN).alias("pseudonym"), V.interval_digest(either).alias("digest"),
    )


@_query("health_violations", """WITH h AS (SELECT event_id, value - 5 AS hrv, CASE WHEN event_id % 3 = 0 THEN 'nan'::DOUBLE ELSE value END AS spo2, value * 1.5 AS vo2, -value AS temperature FROM events)
SELECT event_id, 'hrv_rmssd_ms_invalid' AS rule FROM h WHERE hrv < 0 UNION ALL SELECT event_id, 'spo2_average_percent_range' FROM h WHERE isnan(spo2) OR spo2 NOT BETWEEN 0 AND 100
UNION ALL SELECT event_id, 'vo2_max_range' FROM h WHERE vo2 > 100""")
def health_violations(spark, sf_dir):
    """Daily metrics against their rules; temperatures may be negative."""
    own = {"hrv_rmssd_ms": F.col("value") - 5, "spo2_average_percent": F.when(F.col("event_id") % 3 == 0, float("nan")).otherwise(F.col("value")),
           "vo2_max_ml_kg_min": F.col("value") * 1.5, "nightly_skin_temperature_celsius": -F.col("value")}
    named = ("resting_heart_rate_bpm", "respiratory_rate_breaths_per_minute", "spo2_lower_bound_percent", "spo2_upper_bound_percent", "spo2_standard_deviation_percent")
    rows = D.table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in own.items()], *[F.lit(None).cast("double").alias(n) for n in named])
    return quality.check_rows(rows, quality.health_rules(), "event_id")


@_query("allowed_events", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50)")
def allowed_events(spark, sf_dir):
    """Events of users that a list allows; at least one must be."""
    events = D.table(spark, sf_dir, "events")
    return rollup.allowed(events, events.where("event_type = 'purchase' and value > 50"), "user_id", required=True).select("event_id", "user_id")
