"""Base tables: explicit types, keys and comments.  Schemas are never inferred; null means not provided."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "ts": T.TimestampType(), "strings": T.ArrayType(T.StringType()),
}
_COMMENTS = {
    "start_at": "First instant of a half-open interval", "end_at": "Instant at which the interval ends, itself outside",
    "source_date": "Civil date given by the provider; never shifted by a zone", "offset_seconds": "UTC offset at the start, in seconds",
    "end_offset_seconds": "UTC offset at the end, in seconds", "is_valid": "False once evidence has disproved the event",
    "observed_at": "Instant of observation", "sample_at": "Instant of the sample", "device_key": "Pseudonym of the device",
    "motion_activities": "Activities reported; null is unknown, empty is none", "state": "start or end of use",
}
_OFFSETS = "offset_seconds int, end_offset_seconds int"
_RESPIRATORY = ", ".join(
    f"{stage}_{stat} double" for stage in ("full", "deep", "light", "rem") for stat in ("breaths_per_minute", "standard_deviation", "signal_to_noise")
)
_EVENT = "event_key string!, device_key string!, bundle_id string!, event_at ts!, state string!, is_valid boolean!"


def _span(key: str, rest: str) -> str:
    return f"{key} string!, start_at ts!, end_at ts!, source_date date, {rest}, {_OFFSETS}" if rest else f"{key} string!, start_at ts!, end_at ts!, source_date date, {_OFFSETS}"


#: Column lists: name and type, "!" for required; the first column is the key unless KEYS says otherwise.
COLUMNS = {
    "sleep_session": _span("sleep_session_id", "sleep_minutes double, sleep_type string, is_main_sleep boolean, awake_minutes double, sleep_period_minutes double, sleep_latency_minutes double, after_wake_minutes double"),
    "sleep_detail": f"sleep_detail_id string!, sleep_session_id string!, kind string!, start_at ts!, end_at ts!, category string, {_OFFSETS}",
    "heart_rate_minute": "heart_rate_minute_id string!, start_at ts!, mean_bpm double!, min_bpm double!, max_bpm double!, aggregation_version string!",
    "steps_interval": _span("steps_interval_id", "steps double!"),
    "active_zone_interval": _span("active_zone_interval_id", "active_zone_minutes double!, category string"),
    "exercise_session": _span("exercise_session_id", "exercise_type string!, exercise_name string!, active_seconds double"),
    "sedentary_interval": _span("sedentary_interval_id", ""),
    "distance_interval": _span("distance_interval_id", "distance_meters double!"),
    "heart_rate_zone_interval": _span("heart_rate_zone_interval_id", "zone string!"),
    "health_daily": "source_date date!, resting_heart_rate_bpm double, hrv_rmssd_ms double, deep_sleep_hrv_rmssd_ms double, non_rem_heart_rate_bpm bigint, hrv_entropy double, respiratory_rate_breaths_per_minute double, spo2_average_percent double, spo2_lower_bound_percent double, spo2_upper_bound_percent double, spo2_standard_deviation_percent double, nightly_skin_temperature_celsius double, baseline_skin_temperature_celsius double, relative_nightly_stddev_30d_celsius double, vo2_max_ml_kg_min double, vo2_max_estimated boolean, cardio_fitness_level string, vo2_max_covariance double",
    "hrv_sample": "hrv_sample_id string!, sample_at ts!, source_date date, rmssd_ms double, sdnn_ms double, offset_seconds int",
    "sleep_respiratory_summary": f"respiratory_summary_id string!, sample_at ts!, source_date date, {_RESPIRATORY}, offset_seconds int",
    "location_point": "location_point_id string!, device_key string!, observed_at ts!, latitude double!, longitude double!, accuracy_meters double, speed_kmh double, motion_activities strings",
    "iphone_screen_time_event": _EVENT,
    "mac_screen_time_event": _EVENT,
    "app": "platform string!, bundle_id string!, app_name string",
    "profile": "profile_id string!, sex string, height_cm double, birth_date date, home_place_id string, university_place_id string",
    "place": "place_id string!, place_name string, latitude double, longitude double, radius_meters double",
}
KEYS = {name: [text.split()[0]] for name, text in COLUMNS.items()} | {"app": ["platform", "bundle_id"]}


def schema(name: str) -> T.StructType:
    """The StructType of a base table, with comments."""
    fields = []
    for part in COLUMNS[name].split(", "):
        column, kind = part.split()
        comment = _COMMENTS.get(column, column.replace("_", " ").capitalize())
        fields.append(T.StructField(column, _TYPES[kind.rstrip("!")], not kind.endswith("!"), {"comment": comment}))
    return T.StructType(fields)
