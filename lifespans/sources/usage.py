"""Decoded usage records: schema, deduplicated observations, adoption into the event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.rollup import drop_consecutive_duplicates
from ..operators.sync import adopt_records, invalidate, upsert_distinct

RECORD = (
    "event_key string, object_key string, device_key string, source_stream string, segment_key string, segment_sha256 string, observed_at timestamp, "
    "record_offset int, record_metadata_offset int, record_state string, crc_passed boolean, kind int, in_foreground boolean, cf_absolute_time double, "
    "event_at timestamp, bundle_id string, app_version string, app_build string, platform_flag int, unknown_field_count int, original_payload binary, "
    "parser_version string, record_kind string, payload_length int"
)


def read_usage_records(spark: SparkSession, path: str) -> DataFrame:
    """A row for each physical record occurrence."""
    return spark.read.schema(RECORD).parquet(path)


def changed_observations(states: DataFrame) -> DataFrame:
    """Segment observations that differ from the one before in content or parser."""
    return drop_consecutive_duplicates(states, ["segment_key"], ["observed_at"], ["content_sha256", "parser_version"])


def apply_records(events: DataFrame, records: DataFrame, disproved: DataFrame) -> DataFrame:
    """The event table after a batch: disproved events are invalid, adopted ones are written and valid again."""
    from pyspark.sql import functions as F

    adopted = adopt_records(records).withColumn("is_valid", F.lit(True))
    after, _ = invalidate(events, disproved, adopted)
    return upsert_distinct(after, adopted.select(*events.columns), "event_key")[0]
