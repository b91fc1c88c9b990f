"""Health data points: pages of JSON whose points hold one of many payloads, normalized to base-table rows.

Scalars are read as text, numbers and booleans as variants, so that the rules here decide what is valid.  A normalizer returns the table's columns
and reject_reason; rejected rows keep what could be read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ntz, provider_date
from ..functions.values import alias_conflict, alias_value, date_parts, duration_seconds, identity, json_boolean, json_given, json_identity, json_number, only_payload, point_id, point_id_malformed, reject_if, strict_integer, timestamp_text, utc_offset

_DATE = "struct<year:string,month:string,day:string>"
_CIVIL = f"struct<date:{_DATE}>"
_INTERVAL = f"struct<startTime:string,endTime:string,startUtcOffset:string,endUtcOffset:string,civilStartTime:{_CIVIL},civilEndTime:{_CIVIL}>"
_SAMPLE = f"struct<physicalTime:string,utcOffset:string,civilTime:{_CIVIL}>"
_CHILD = "array<struct<startTime:string,endTime:string,startUtcOffset:string,endUtcOffset:string,type:string>>"
_STATS = "struct<breathsPerMinute:variant,standardDeviation:variant,signalToNoise:variant>"

#: Payload field and its shape, by kind.
PAYLOADS = {
    "steps": ("steps", f"struct<interval:{_INTERVAL},count:string>"),
    "active-zone-minutes": ("activeZoneMinutes", f"struct<interval:{_INTERVAL},activeZoneMinutes:string,heartRateZone:string>"),
    "sleep": ("sleep", f"struct<interval:{_INTERVAL},type:string,stages:{_CHILD},shortAwakenings:{_CHILD},outOfBedSegments:{_CHILD},"
              "summary:struct<minutesAsleep:string,minutesAwake:string,minutesInSleepPeriod:string,minutesToFallAsleep:string,minutesAfterWakeUp:string>,"
              "metadata:struct<mainSleep:variant,main:variant>>"),
    "daily-resting-heart-rate": ("dailyRestingHeartRate", f"struct<date:{_DATE},beatsPerMinute:string>"),
    "daily-heart-rate-variability": ("dailyHeartRateVariability", f"struct<date:{_DATE},averageHeartRateVariabilityMilliseconds:variant,"
                                     "deepSleepRootMeanSquareOfSuccessiveDifferencesMilliseconds:variant,nonRemHeartRateBeatsPerMinute:string,entropy:variant>"),
    "daily-respiratory-rate": ("dailyRespiratoryRate", f"struct<date:{_DATE},breathsPerMinute:variant>"),
    "daily-oxygen-saturation": ("dailyOxygenSaturation", f"struct<date:{_DATE},averagePercentage:variant,lowerBoundPercentage:variant,upperBoundPercentage:variant,standardDeviationPercentage:variant>"),
    "daily-sleep-temperature-derivations": ("dailySleepTemperatureDerivations", f"struct<date:{_DATE},nightlyTemperatureCelsius:variant,baselineTemperatureCelsius:variant,relativeNightlyStddev30dCelsius:variant>"),
    "daily-vo2-max": ("dailyVo2Max", f"struct<date:{_DATE},vo2Max:variant,estimated:variant,cardioFitnessLevel:string,vo2MaxCovariance:variant>"),
    "heart-rate-variability": ("heartRateVariability", f"struct<sampleTime:{_SAMPLE},rootMeanSquareOfSuccessiveDifferencesMilliseconds:variant,standardDeviationMilliseconds:variant>"),
    "respiratory-rate-sleep-summary": ("respiratoryRateSleepSummary", f"struct<sampleTime:{_SAMPLE},fullSleepStats:{_STATS},deepSleepStats:{_STATS},lightSleepStats:{_STATS},remSleepStats:{_STATS}>"),
    "exercise": ("exercise", f"struct<interval:{_INTERVAL},exerciseType:string,displayName:string,activeDuration:string>"),
    "sedentary-period": ("sedentaryPeriod", f"struct<interval:{_INTERVAL}>"),
    "distance": ("distance", f"struct<interval:{_INTERVAL},millimeters:string>"),
    "time-in-heart-rate-zone": ("timeInHeartRateZone", f"struct<interval:{_INTERVAL},heartRateZoneType:string>"),
}


def point_shape(kind: str | None = None) -> str:
    """The shape of a point; with ``kind`` the payloads of other kinds are not read but kept as text, which tells that they are there."""
    shapes = [f"{field}:{shape if kind in (None, other) else 'string'}" for other, (field, shape) in PAYLOADS.items()]
    return "struct<name:string,dataPointName:string,heartRate:string," + ",".join(shapes) + ">"


#: The other types that a rollup point can hold, by their field.
ROLLUP_OTHERS = (
    "steps", "floors", "weight", "altitude", "distance", "bodyFat", "totalCalories", "activeZoneMinutes", "sedentaryPeriod", "runVo2Max",
    "caloriesInHeartRateZone", "activityLevel", "nutritionLog", "hydrationLog", "timeInHeartRateZone", "activeMinutes", "swimLengthsData",
    "coreBodyTemperature", "activeEnergyBurned", "bloodGlucose",
)
_ROLLUP = (
    "struct<startTime:string,endTime:string,heartRate:struct<beatsPerMinuteAvg:variant,beatsPerMinuteMin:variant,beatsPerMinuteMax:variant>,"
    + ",".join(f"{field}:string" for field in ROLLUP_OTHERS) + ">"
)
#: Zones and sleep stages that exist; other categories of exercise and zone time pass through.
AZM_ZONES = ("fat_burn", "cardio", "peak", "heart_rate_zone_unspecified")
SLEEP_STAGES = ("awake", "light", "deep", "rem", "asleep", "restless", "sleep_stage_type_unspecified")


def read_points(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """A row for each point of every page: point, and the page's path; for one ``kind`` only its payload is read."""
    pages = spark.read.schema(f"dataPoints array<{point_shape(kind)}>, nextPageToken string").option("multiLine", True).json(path)
    return pages.select(F.explode("dataPoints").alias("point"), F.col("_metadata.file_path").alias("page"))


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    """A row for each minute rollup that has a heart rate or, wrongly, another type's value."""
    pages = spark.read.schema(f"rollupDataPoints array<{_ROLLUP}>").option("multiLine", True).json(path)
    return pages.select(F.explode("rollupDataPoints").alias("point")).where(F.col("point.heartRate").isNotNull() | _other_type())


def parse_rollups(df: DataFrame, text: str = "body") -> DataFrame:
    """Minute rollups from a column of JSON texts, one each; kept and skipped as ``read_rollups`` does."""
    return df.withColumn("point", F.explode(F.array(F.from_json(text, _ROLLUP)))).where(F.col("point.heartRate").isNotNull() | _other_type())


def _other_type() -> Column:
    return F.coalesce(*[F.col(f"point.{field}") for field in ROLLUP_OTHERS]).isNotNull()


def parse_points(df: DataFrame, text: str = "body", kind: str | None = None) -> DataFrame:
    """Points from a column of JSON texts, one point each; for one ``kind`` only its payload is read.

    The explode of one element keeps the optimizer from parsing the text anew for every field that is read.
    """
    return df.withColumn("point", F.explode(F.array(F.from_json(text, point_shape(kind)))))


@dataclass
class _Reading:
    """What a kind reads from a point: times, columns, and rules that reject it.

    Rules and identity parts name what was read (``_read``), so that a value is parsed once, not once for every rule.
    """

    times: dict[str, Column]
    columns: dict[str, Column]
    rules: list[tuple[str, Column]]
    parts: list[Column]


def _read(name: str) -> Column:
    return F.col(f"_r.{name}")


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _civil_date(civil: Column) -> Column:
    d = civil["date"]
    return date_parts(d["year"], d["month"], d["day"])


def _interval(p: Column, dated_by: str = "start") -> _Reading:
    i = p["interval"]
    start, end = timestamp_text(i["startTime"]), timestamp_text(i["endTime"])
    o1, o2 = utc_offset(i["startUtcOffset"]), utc_offset(i["endUtcOffset"])
    civil = i["civilStartTime"] if dated_by == "start" else i["civilEndTime"]
    day = provider_date(start, o1) if dated_by == "start" else provider_date(end, o2)
    given = _civil_date(civil)
    rules = [
        ("time_malformed", _read("start_at").isNull() | _read("end_at").isNull()), ("interval_not_positive", _read("end_at") <= _read("start_at")),
        ("offset_malformed", _read("offset_seconds").isNull() | _read("end_offset_seconds").isNull()), ("civil_date_differs", civil.isNotNull() & ~given.eqNullSafe(_read("source_date"))),
    ]
    times = {"start_at": start, "end_at": end, "source_date": day, "offset_seconds": o1, "end_offset_seconds": o2}
    return _Reading(times, {}, rules, [_text(_read("start_at")), _text(_read("end_at"))])


def _sample(p: Column) -> _Reading:
    s = p["sampleTime"]
    at, offset = timestamp_text(s["physicalTime"]), utc_offset(s["utcOffset"])
    day, given = provider_date(at, offset), _civil_date(s["civilTime"])
    rules = [("time_malformed", _read("sample_at").isNull()), ("offset_malformed", _read("offset_seconds").isNull()), ("civil_date_differs", s["civilTime"].isNotNull() & ~given.eqNullSafe(_read("source_date")))]
    return _Reading({"sample_at": at, "source_date": day, "offset_seconds": offset}, {}, rules, [_text(_read("sample_at"))])


def _daily(p: Column) -> _Reading:
    day = date_parts(p["date"]["year"], p["date"]["month"], p["date"]["day"])
    return _Reading({"source_date": day}, {}, [("date_malformed", _read("source_date").isNull())], [_read("source_date").cast("string")])


def _take(r: _Reading, name: str, given: Column, value: Column, required: bool = False) -> _Reading:
    """Add a column; a given value that does not parse rejects the row, and a missing one if it is required."""
    r.columns[name] = value
    r.rules.append((f"{name}_invalid", _read(name).isNull() if required else given & _read(name).isNull()))
    return r


def _integers(r: _Reading, p: Column, names: dict[str, str], least=0, most=2**63 - 1, required=False, kind="double") -> _Reading:
    for name, field in names.items():
        _take(r, name, p[field].isNotNull(), strict_integer(p[field], least, most).cast(kind), required)
    return r


def _numbers(r: _Reading, p: Column, names: dict[str, str], least=None, most=None, required: tuple[str, ...] = ()) -> _Reading:
    for name, field in names.items():
        _take(r, name, json_given(p[field]), json_number(p[field], least, most), name in required)
    return r


def _steps(p: Column) -> _Reading:
    raw = F.coalesce(p["count"], F.lit("0"))  # an observed zero comes without a count
    return _take(_interval(p), "steps", raw.isNotNull(), strict_integer(raw, 0, 1_000_000).cast("double"), True)


def _active_zone(p: Column) -> _Reading:
    r = _integers(_interval(p), p, {"active_zone_minutes": "activeZoneMinutes"}, required=True)
    zone = F.lower(p["heartRateZone"])
    return _take(r, "category", zone.isNotNull(), F.when(zone.isin(*AZM_ZONES), zone), True)


def _sleep(p: Column) -> _Reading:
    r = _interval(p, "end")
    s, m = p["summary"], p["metadata"]
    r.columns["sleep_type"] = F.lower(p["type"])
    _integers(r, s, {"sleep_minutes": "minutesAsleep", "awake_minutes": "minutesAwake", "sleep_period_minutes": "minutesInSleepPeriod",
                     "sleep_latency_minutes": "minutesToFallAsleep", "after_wake_minutes": "minutesAfterWakeUp"})
    names = [m["mainSleep"], m["main"]]
    r.columns["is_main_sleep"] = F.coalesce(*[json_boolean(x) for x in names])
    r.rules.append(("is_main_sleep_invalid", reduce(or_, [json_given(x) & json_boolean(x).isNull() for x in names])))
    r.rules.append(("main_conflict", alias_conflict(*[json_boolean(x) for x in names])))
    r.rules.append(("stages_overlap", _overlap(p["stages"])))
    return r


def _overlap(children: Column) -> Column:
    """True where one of the intervals begins before an earlier one has ended."""
    spans = F.array_sort(F.transform(children, lambda c: F.struct(timestamp_text(c["startTime"]).alias("a"), timestamp_text(c["endTime"]).alias("z"))))
    following = F.zip_with(F.slice(spans, F.lit(2), F.greatest(F.size(spans) - 1, F.lit(0))), spans, lambda later, earlier: earlier["z"] > later["a"])
    return F.coalesce(F.exists(following, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))


def _resting(p: Column) -> _Reading:
    return _integers(_daily(p), p, {"resting_heart_rate_bpm": "beatsPerMinute"}, 1, 300, True)


def _daily_hrv(p: Column) -> _Reading:
    r = _numbers(_daily(p), p, {"hrv_rmssd_ms": "averageHeartRateVariabilityMilliseconds", "deep_sleep_hrv_rmssd_ms": "deepSleepRootMeanSquareOfSuccessiveDifferencesMilliseconds",
                                "hrv_entropy": "entropy"}, 0)
    _integers(r, p, {"non_rem_heart_rate_bpm": "nonRemHeartRateBeatsPerMinute"}, kind="bigint")
    r.rules.append(("hrv_empty", F.coalesce(*[_read(c).cast("double") for c in r.columns]).isNull()))
    return r


def _daily_respiratory(p: Column) -> _Reading:
    return _numbers(_daily(p), p, {"respiratory_rate_breaths_per_minute": "breathsPerMinute"}, 0, required=("respiratory_rate_breaths_per_minute",))


def _oxygen(p: Column) -> _Reading:
    names = {"spo2_average_percent": "averagePercentage", "spo2_lower_bound_percent": "lowerBoundPercentage", "spo2_upper_bound_percent": "upperBoundPercentage",
             "spo2_standard_deviation_percent": "standardDeviationPercentage"}
    return _numbers(_daily(p), p, names, 0, 100, tuple(names)[:3])


def _temperature(p: Column) -> _Reading:
    r = _numbers(_daily(p), p, {"nightly_skin_temperature_celsius": "nightlyTemperatureCelsius", "baseline_skin_temperature_celsius": "baselineTemperatureCelsius"},
                 required=("nightly_skin_temperature_celsius",))
    return _numbers(r, p, {"relative_nightly_stddev_30d_celsius": "relativeNightlyStddev30dCelsius"}, 0)


def _vo2(p: Column) -> _Reading:
    r = _numbers(_daily(p), p, {"vo2_max_ml_kg_min": "vo2Max"}, 0, 100, ("vo2_max_ml_kg_min",))
    _take(r, "vo2_max_estimated", json_given(p["estimated"]), json_boolean(p["estimated"]))
    r.columns["cardio_fitness_level"] = p["cardioFitnessLevel"]
    return _numbers(r, p, {"vo2_max_covariance": "vo2MaxCovariance"}, 0)


def _hrv_sample(p: Column) -> _Reading:
    r = _numbers(_sample(p), p, {"rmssd_ms": "rootMeanSquareOfSuccessiveDifferencesMilliseconds", "sdnn_ms": "standardDeviationMilliseconds"}, 0)
    r.rules.append(("hrv_empty", F.coalesce(*[_read(c) for c in r.columns]).isNull()))
    return r


def _respiratory_summary(p: Column) -> _Reading:
    r = _sample(p)
    for stage in ("full", "deep", "light", "rem"):
        s = p[f"{stage}SleepStats"]
        breaths = f"{stage}_breaths_per_minute"
        _numbers(r, s, {breaths: "breathsPerMinute", f"{stage}_standard_deviation": "standardDeviation"}, 0)
        _numbers(r, s, {f"{stage}_signal_to_noise": "signalToNoise"})
        r.rules.append((f"{breaths}_missing", _read(breaths).isNull() & (s.isNotNull() if stage != "full" else F.lit(True))))
    return r


def _exercise(p: Column) -> _Reading:
    r = _interval(p)
    r.columns |= {"exercise_type": p["exerciseType"], "exercise_name": p["displayName"]}
    r.rules.append(("exercise_unnamed", p["exerciseType"].isNull() | p["displayName"].isNull()))
    return _take(r, "active_seconds", p["activeDuration"].isNotNull(), duration_seconds(p["activeDuration"]))


def _distance(p: Column) -> _Reading:
    raw = F.coalesce(p["millimeters"], F.lit("0"))
    return _take(_interval(p), "distance_meters", raw.isNotNull(), strict_integer(raw, 0, 1_000_000_000) / 1000, True)


def _zone_time(p: Column) -> _Reading:
    r = _take(_interval(p), "zone", p["heartRateZoneType"].isNotNull(), p["heartRateZoneType"], True)
    r.parts.append(F.coalesce(_read("zone"), F.lit("")))
    return r


#: Base table, its key (none for daily rows), reader, and whether the provider's id is required.
KINDS: dict[str, tuple[str, str | None, Callable[[Column], _Reading], bool]] = {
    "steps": ("steps_interval", "steps_interval_id", _steps, False),
    "active-zone-minutes": ("active_zone_interval", "active_zone_interval_id", _active_zone, False),
    "sleep": ("sleep_session", "sleep_session_id", _sleep, True),
    "daily-resting-heart-rate": ("health_daily", None, _resting, False),
    "daily-heart-rate-variability": ("health_daily", None, _daily_hrv, False),
    "daily-respiratory-rate": ("health_daily", None, _daily_respiratory, False),
    "daily-oxygen-saturation": ("health_daily", None, _oxygen, False),
    "daily-sleep-temperature-derivations": ("health_daily", None, _temperature, False),
    "daily-vo2-max": ("health_daily", None, _vo2, False),
    "heart-rate-variability": ("hrv_sample", "hrv_sample_id", _hrv_sample, False),
    "respiratory-rate-sleep-summary": ("sleep_respiratory_summary", "respiratory_summary_id", _respiratory_summary, False),
    "exercise": ("exercise_session", "exercise_session_id", _exercise, True),
    "sedentary-period": ("sedentary_interval", "sedentary_interval_id", _interval, False),
    "distance": ("distance_interval", "distance_interval_id", _distance, False),
    "time-in-heart-rate-zone": ("heart_rate_zone_interval", "heart_rate_zone_interval_id", _zone_time, False),
}


def normalize(points: DataFrame, kind: str, subject: str = "owner") -> DataFrame:
    """Rows of the kind's base table from a column ``point``, with reject_reason; other columns are kept.

    A point must hold this kind's payload and no other.  Its id is the provider's, or else the hash of subject, kind
    and times.
    """
    _, key, reader, named = KINDS[kind]
    field = PAYLOADS[kind][0]
    point = F.col("point")
    payload = point[field]
    r = reader(payload)
    name = alias_value(point["dataPointName"], point["name"])
    given = _read("given")
    stem = kind == "respiratory-rate-sleep-summary"  # such summaries can come with their collection's name alone
    rules = [
        ("payload_missing", payload.isNull()), ("payload_conflict", ~only_payload(*[point[f] for f, _ in PAYLOADS.values()], point["heartRate"])),
        ("name_conflict", alias_conflict(point["dataPointName"], point["name"])), ("id_malformed", point_id_malformed(name, kind, stem)), *([("id_missing", given.isNull())] if named else []), *r.rules,
    ]
    values = r.times | r.columns
    made = values | {"given": point_id(name, kind)}
    read = points.select("*", *[c.alias(f"_r_{n}") for n, c in made.items()])
    once = F.explode(F.array(F.struct(*[F.col(f"_r_{n}").alias(n) for n in made])))  # else a filter on the reason would parse anew for every rule
    read = read.select(*points.columns, once.alias("_r"))
    ids = [F.coalesce(given, identity(F.lit(subject), F.lit(kind), *r.parts)).alias(key)] if key else []
    others = [F.col(c) for c in points.columns if c != "point"]
    return read.select(*ids, *others, *[_read(n).alias(n) for n in values], reject_if(*rules).alias("reject_reason"))


def normalize_sleep_details(points: DataFrame) -> DataFrame:
    """The stages and wakes inside sleep points as rows of the detail table, with reject_reason.

    Short awakenings may lack offsets; a stage must be of a known type; a detail must lie within its session.
    """
    p = F.col("point.sleep")
    start, end = timestamp_text(p["interval"]["startTime"]), timestamp_text(p["interval"]["endTime"])

    def children(field: str, kind: str, category: str | None) -> Column:
        return F.transform(
            F.coalesce(p[field], F.array().cast(_CHILD)),
            lambda c: F.struct(F.lit(kind).alias("kind"), (F.lit(category) if category else F.lower(c["type"])).alias("category"), F.lit(field != "shortAwakenings").alias("strict"), c.alias("c")),
        )

    every = F.concat(children("stages", "sleep-stage", None), children("shortAwakenings", "sleep-wake", "short-awakening"), children("outOfBedSegments", "sleep-wake", "out-of-bed"))
    session = point_id(alias_value(F.col("point.dataPointName"), F.col("point.name")), "sleep")
    rows = points.select(session.alias("sleep_session_id"), start.alias("_from"), end.alias("_to"), F.explode(every).alias("e"))
    rows = rows.select("sleep_session_id", "_from", "_to", "e.kind", "e.category", "e.strict", timestamp_text(F.col("e.c.startTime")).alias("start_at"),
                       timestamp_text(F.col("e.c.endTime")).alias("end_at"), utc_offset(F.col("e.c.startUtcOffset")).alias("offset_seconds"), utc_offset(F.col("e.c.endUtcOffset")).alias("end_offset_seconds"))
    reason = reject_if(
        ("time_malformed", F.col("start_at").isNull() | F.col("end_at").isNull()), ("outside_session", (F.col("start_at") < F.col("_from")) | (F.col("end_at") > F.col("_to")) | (F.col("end_at") <= F.col("start_at"))),
        ("stage_unknown", (F.col("kind") == "sleep-stage") & ~F.coalesce(F.col("category").isin(*SLEEP_STAGES), F.lit(False))),
        ("offset_missing", F.col("strict") & (F.col("offset_seconds").isNull() | F.col("end_offset_seconds").isNull())),
    )
    wake = F.when(F.col("kind") == "sleep-wake", F.col("category")).otherwise("")
    key = json_identity(F.col("sleep_session_id"), F.col("kind"), wake, _text(F.col("start_at")), _text(F.col("end_at")))
    return rows.select(key.alias("sleep_detail_id"), "sleep_session_id", "kind", "start_at", "end_at", "category", "offset_seconds", "end_offset_seconds", reason.alias("reject_reason"))


def normalize_minutes(points: DataFrame, subject: str = "owner", version: str = "rollup-60s") -> DataFrame:
    """Rows of the minute heart-rate table from rollup points, with reject_reason; a minute must be whole."""
    start, end = timestamp_text(F.col("point.startTime")), timestamp_text(F.col("point.endTime"))
    h = F.col("point.heartRate")
    mean, low, high = (json_number(h[f"beatsPerMinute{x}"], 0) for x in ("Avg", "Min", "Max"))
    reason = reject_if(
        ("payload_conflict", _other_type()), ("time_malformed", start.isNull() | end.isNull()), ("minute_misaligned", (F.date_trunc("minute", start) != start) | (F.timestamp_diff("MICROSECOND", start, end) != 60_000_000)),
        ("value_malformed", mean.isNull() | low.isNull() | high.isNull()), ("order", (low > mean) | (mean > high)),
    )
    return points.select(json_identity(F.lit(subject), F.lit("heart-rate"), _text(start)).alias("heart_rate_minute_id"), ntz(start).alias("start_at"), mean.alias("mean_bpm"), low.alias("min_bpm"),
                         high.alias("max_bpm"), F.lit(version).alias("aggregation_version"), reason.alias("reject_reason"))
