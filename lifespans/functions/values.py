"""Strict parsing, identities and small value rules as column expressions.

Integers, times and names are read as strings, numbers and booleans as variants that keep their JSON type, so that these
rules, not the reader, decide what is valid.  A parser returns null for what it rejects; ``reject_if`` turns rules into a
reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_OFFSET = 64800


def finite(x: Column) -> Column:
    """True for a number that is neither NaN nor infinite."""
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def strict_integer(text: Column, least: int | None = None, most: int | None = None) -> Column:
    value = F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))
    if least is not None:
        value = F.when(value >= least, value)
    return value if most is None else F.when(value <= most, value)


def json_given(value: Column) -> Column:
    """True for a variant that is there and is not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def json_number(value: Column, least: float | None = None, most: float | None = None) -> Column:
    """A finite JSON number within the bounds; texts and booleans are none."""
    value = F.when(F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(value, "$", "double"))
    value = F.when(finite(value), value)
    if least is not None:
        value = F.when(value >= least, value)
    return value if most is None else F.when(value <= most, value)


def json_boolean(value: Column) -> Column:
    """A JSON boolean; the texts "true" and "false" are none."""
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def utc_offset(text: Column) -> Column:
    """Whole seconds of an offset like ``32400s`` or ``32400.0s``, up to 18 hours either way."""
    value = F.regexp_extract(text, r"^(-?\d+)(?:\.0+)?s$", 1).try_cast("int")  # no match is an empty text, which is no number
    return F.when(value.between(-MAX_OFFSET, MAX_OFFSET), value)


def duration_seconds(text: Column) -> Column:
    """Seconds of a duration like ``90.5s``, with at most nine fraction digits."""
    return F.when(text.rlike(r"^\d+(\.\d{1,9})?s$"), F.regexp_extract(text, r"^(.+)s$", 1).try_cast("double"))


def timestamp_text(text: Column) -> Column:
    """Instant of an RFC 3339 text; more than six fraction digits (other than zeros) are rejected, not cut."""
    shape = text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6}0*)?(Z|[+-]\d\d:\d\d)$")
    return F.when(shape, F.try_to_timestamp(text).cast("timestamp_ntz"))


def date_parts(year: Column, month: Column, day: Column) -> Column:
    """A real calendar date from year, month and day texts; null otherwise."""
    text = F.format_string("%04d-%02d-%02d", strict_integer(year, 1, 9999).cast("int"), strict_integer(month, 1, 12).cast("int"), strict_integer(day, 1, 31).cast("int"))
    known = strict_integer(year, 1, 9999).isNotNull() & strict_integer(month, 1, 12).isNotNull() & strict_integer(day, 1, 31).isNotNull()
    return F.when(known, text.try_cast("date"))


def alias_value(primary: Column, other: Column) -> Column:
    return F.coalesce(primary, other)


def alias_conflict(primary: Column, other: Column) -> Column:
    """True where both names are given and differ."""
    return primary.isNotNull() & other.isNotNull() & (primary != other)


def point_id(name: Column, kind: str) -> Column:
    """Id at the end of a resource name of this kind; null for any other name."""
    return F.nullif(F.regexp_extract(name, rf"^users/[^/]+/dataTypes/{kind}/dataPoints/([^/]+)$", 1), F.lit(""))


def point_id_malformed(name: Column, kind: str, stem_allowed: bool = False) -> Column:
    """True for a name that is given but is no resource name of this kind; with ``stem_allowed`` its collection's stem passes."""
    fits = name.rlike(rf"^users/[^/]+/dataTypes/{kind}/dataPoints/[^/]{'*' if stem_allowed else '+'}$")
    return name.isNotNull() & (name != "") & ~fits


def identity(*parts: Column) -> Column:
    """SHA-256 of the parts joined by the unit separator; a null part counts as empty."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def json_identity(*parts: Column) -> Column:
    """SHA-256 of a compact JSON array of strings."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def location_id(device: Column, digest: Column) -> Column:
    return F.sha2(F.concat_ws(":", device, digest), 256)


def event_identity(device: Column, stream: Column, app: Column, at: Column, direction: Column, kind: Column) -> Column:
    """Identity of an event, whatever record it came from."""
    return identity(device, stream, app, at, direction, kind)


def interval_digest(intervals: Column) -> Column:
    """SHA-256 of an array of intervals, whatever their order."""
    return F.sha2(F.to_json(F.array_sort(intervals)), 256)


def hmac_sha256(message: Column, key: bytes, domain: bytes = b"") -> Column:
    """HMAC-SHA256 as hex, with a domain prefix before the message; the padded key is a literal."""
    import hashlib

    key = hashlib.sha256(key).digest() if len(key) > 64 else key
    block = key.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)
    first = F.unhex(F.sha2(F.concat(F.lit(inner + domain), message.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def digest_matches(payload: Column, path: Column) -> Column:
    """True where a payload's SHA-256 is the one that its object key names."""
    return F.sha2(payload, 256) == F.regexp_extract(path, r"_([0-9a-f]{64})\.json", 1)


def only_payload(*payloads: Column) -> Column:
    """True where exactly one of the payload fields is given."""
    return reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in payloads]) == 1


def strict_object(text: Column) -> Column:
    """True for a JSON object without duplicate keys, NaN or Infinity."""
    parsed = F.try_parse_json(text)
    return F.coalesce(parsed.isNotNull() & text.rlike(r"^\s*\{") & ~text.rlike(r"[:\[,]\s*-?(NaN|Infinity)\b"), F.lit(False))


def any_distinct(left: list[Column], right: list[Column]) -> Column:
    """Null-safe: true where any pair differs."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in zip(left, right)], F.lit(False))


def level(value: Column, bounds: list[Column]) -> Column:
    """Null for missing, 0 for zero, else one more than the number of bounds that the value reaches."""
    reached = reduce(lambda a, b: a + b, [(value >= b).cast("int") for b in bounds], F.lit(1))
    return F.when(value.isNull(), None).when(value == 0, 0).otherwise(reached)


def reject_if(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, null if none does."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(rules):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
    return reason
