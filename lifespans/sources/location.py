"""Location messages: a projected, content-addressed raw sink, and the points read back from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ntz
from ..functions.values import digest_matches, finite, location_id, reject_if, strict_object
from .tables import write_base

#: The fields that are kept, and the canonical key of a raw object.
FIELDS = "_type string, tst bigint, lat double, lon double, acc double, vel double, motionactivities array<string>"
KEY = r"raw/location/v1/([0-9a-f]{64})/(\d{4})/(\d\d)/(\d\d)/(\d{8}T\d{6}Z)_([0-9a-f]{64})\.json(?:\.gz)?$"


def parsed(df: DataFrame, body: str) -> DataFrame:
    """``df`` with the kept fields as ``_m``; the explode of one element lets a text be parsed once."""
    return df.withColumn("_m", F.explode(F.array(F.from_json(body, FIELDS))))


def project_message(body: Column, m: Column) -> tuple[Column, Column]:
    """(canonical JSON of the kept fields ``m``, reject reason) of a message text."""
    reason = reject_if(
        ("json_invalid", ~strict_object(body)), ("type_unknown", ~m["_type"].eqNullSafe("location")), ("time_missing", m["tst"].isNull()),
        ("latitude_invalid", m["lat"].isNull() | ~F.coalesce(finite(m["lat"]) & m["lat"].between(-90, 90), F.lit(False))),
        ("longitude_invalid", m["lon"].isNull() | ~F.coalesce(finite(m["lon"]) & m["lon"].between(-180, 180), F.lit(False))),
        ("accuracy_invalid", (m["acc"] < 0) | ~finite(m["acc"])), ("speed_invalid", (m["vel"] < 0) | ~finite(m["vel"])),
    )
    return F.to_json(m), reason


def raw_objects(messages: DataFrame, device: str = "device_key", body: str = "body") -> DataFrame:
    """object_key, body, date and reject_reason of messages; the key holds device, time and content digest."""
    text, reason = project_message(F.col(body), F.col("_m"))
    at = F.timestamp_seconds("_m.tst")
    key = F.concat(
        F.lit("raw/location/v1/"), F.sha2(F.col(device), 256), F.date_format(at, "/yyyy/MM/dd/yyyyMMdd'T'HHmmss'Z_'"), F.sha2(text, 256), F.lit(".json")
    )
    return parsed(messages, body).select(key.alias("object_key"), text.alias("body"), at.cast("date").alias("date"), reason.alias("reject_reason"))


def write_location_raw(objects: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """Append objects by date; keys that exist already are left alone, so a resent message is written once."""
    new = objects.where("reject_reason is null").select("object_key", "body", "date").dropDuplicates(["object_key"])
    if existing is not None:
        new = new.join(existing.select("object_key"), "object_key", "left_anti")
    new.write.mode("append").partitionBy("date").json(path)


def read_location_raw(spark: SparkSession, path: str) -> DataFrame:
    """One row per raw object file (plain or gzip), its path as the key."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("object_key"), F.col("value").alias("body"))


def location_points(raw: DataFrame) -> DataFrame:
    """Rows of the location table from raw objects, with reject_reason: key, digest, payload and time must agree."""
    m = F.col("_m")
    part = lambda k: F.regexp_extract("object_key", KEY, k)
    at = F.timestamp_seconds(m["tst"])
    _, bad = project_message(F.col("body"), m)
    named = F.try_to_timestamp(part(5), F.lit("yyyyMMdd'T'HHmmss'Z'"))
    reason = F.coalesce(
        reject_if(("key_noncanonical", part(6) == ""), ("digest_differs", ~digest_matches(F.col("body"), F.col("object_key")))), bad,
        reject_if(("time_differs", ~named.cast("timestamp_ntz").eqNullSafe(ntz(at)))),
    )
    return parsed(raw, "body").select(
        "object_key", location_id(part(1), part(6)).alias("location_point_id"), part(1).alias("device_key"), ntz(at).alias("observed_at"), m["lat"].alias("latitude"), m["lon"].alias("longitude"),
        m["acc"].alias("accuracy_meters"), m["vel"].alias("speed_kmh"), m["motionactivities"].alias("motion_activities"), reason.alias("reject_reason"),
    )


def check_raw_keys(raw: DataFrame) -> DataFrame:
    """Objects whose key, digest, content and time disagree: object_key, reject_reason."""
    return location_points(raw).where("reject_reason is not null").select("object_key", "reject_reason")


def rebuild(raw: DataFrame, root: str) -> DataFrame:
    """Load an inventory of raw objects into an empty ``root``, and the rejected objects.

    A point's id is the hash of its object's key, and equal ids are equal points, so the order of the objects does not
    matter.  A root that holds the table already is refused.
    """
    spark = raw.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/location_point")
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise ValueError(f"{root} already holds location points")
    rows = location_points(raw)
    write_base(rows.where("reject_reason is null").dropDuplicates(["location_point_id"]), root, "location_point")
    return rows.where("reject_reason is not null").select("object_key", "reject_reason")
