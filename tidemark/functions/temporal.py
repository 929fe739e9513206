"""Date arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A clock time, then whatever is left names a zone: Z, an offset of hours, minutes or seconds, or a region.
_ZONED = r"\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*([A-Za-z]|[+-]\s*\d)"


def plus_days(value: Column, n: int | Column) -> Column:
    days = F.lit(n) if isinstance(n, int) else n
    return value + F.make_dt_interval(days)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed 24-hour periods (not calendar days) for ``end >= start``."""
    return F.extract(F.lit("DAY"), end - start)


def day_of_week(value: Column) -> Column:
    """Monday is 0."""
    return F.weekday(value)


def _wall_clock(instant: Column) -> Column:
    """An instant on a UTC clock, counted from the epoch: the session zone's doubled hours play no part."""
    seconds = (F.unix_micros(instant).cast("decimal(24,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def naive_utc(value: Column, dtype: str) -> Column:
    """Bring a date column of any source type to a UTC wall-clock timestamp.

    Text with a zone (``+02:00``, ``+0200``, ``+02``, ``Z`` or ``z``, ``Europe/Paris``) is shifted to UTC,
    text without one is taken as UTC already, and text that is no date becomes null.
    """
    if dtype == "timestamp_ntz":
        return value
    if dtype == "timestamp":
        return _wall_clock(value)
    if dtype == "date":
        return value.cast("timestamp_ntz")
    text = F.trim(value.cast("string"))
    named = text.rlike(_ZONED)
    # Spark reads offsets with minutes, upper-case Z and region names.
    readable = F.regexp_replace(F.regexp_replace(text, r"[zZ]$", "Z"), r"(:\d{2}(?:[.,]\d+)?\s*[+-]\d{1,2})$", "$1:00")
    readable = F.regexp_replace(readable, r"([+-]\d{2})(\d{2})$", "$1:$2")
    readable = F.regexp_replace(readable, r"([T ]\d{1,2}:\d{2})(\s*[+\-A-Za-z])", "$1:00$2")  # with seconds
    return F.when(named, _wall_clock(readable.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))
