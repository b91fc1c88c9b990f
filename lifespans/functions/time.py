"""Time columns.  TIMESTAMP and TIMESTAMP_NTZ are both taken, the latter as UTC; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Asia/Tokyo"


def ntz(ts: Column | str) -> Column:
    """The UTC wall time of an instant."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def local_time(ts: Column | str, zone: str | Column = DEFAULT_ZONE) -> Column:
    """Wall time of an instant in a zone, as TIMESTAMP_NTZ.

    A fixed zone is looked up once for a query; ``convert_timezone``, for a zone per row, looks it up in every row.
    """
    if isinstance(zone, str):
        return F.from_utc_timestamp(ntz(ts).cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), zone, ntz(ts))


def local_date(ts: Column | str, zone: str | Column = DEFAULT_ZONE) -> Column:
    """Civil date of an instant in a zone."""
    return local_time(ts, zone).cast("date")


def local_midnight(day: Column | str, zone: str | Column = DEFAULT_ZONE) -> Column:
    """UTC wall time at which a civil date begins in a zone."""
    day = F.col(day) if isinstance(day, str) else day
    if isinstance(zone, str):
        return F.to_utc_timestamp(day.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(zone, F.lit("UTC"), day.cast("timestamp_ntz"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Microseconds from start to end, a bigint."""
    return F.timestamp_diff("MICROSECOND", ntz(start), ntz(end))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end as a double."""
    return micros_between(start, end) / F.lit(1e6)


def add_micros(ts: Column | str, micros: Column | int) -> Column:
    """A time moved by microseconds."""
    micros = F.lit(micros) if isinstance(micros, int) else micros
    return F.timestamp_add("MICROSECOND", micros, ntz(ts))


def last_instant(end: Column | str) -> Column:
    """The last microsecond of a half-open interval."""
    return add_micros(end, -1)


def provider_date(ts: Column | str, offset_seconds: Column | str) -> Column:
    """Civil date under a record's own UTC offset; never the session's or the mart's zone."""
    offset = F.col(offset_seconds) if isinstance(offset_seconds, str) else offset_seconds
    return F.timestamp_add("SECOND", offset, ntz(ts)).cast("date")


def floor_minute(ts: Column | str) -> Column:
    return F.date_trunc("minute", ntz(ts)).cast("timestamp_ntz")


def ceil_minute(ts: Column | str) -> Column:
    down = floor_minute(ts)
    return F.when(down == ntz(ts), down).otherwise(F.timestamp_add("MINUTE", F.lit(1), down))


def apple_time(seconds: Column | str) -> Column:
    """Timestamp of seconds since 2001-01-01 UTC."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_micros(F.round((seconds + F.lit(978307200)) * 1e6).cast("long"))


def month_window_start(end_day: Column, months: int = 10) -> Column:
    """First day of the window of ``months`` months that ends with ``end_day``."""
    return F.add_months(F.date_add(end_day, 1), -months)
