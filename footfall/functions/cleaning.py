"""Cleaning rules for values read from a frame record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2147483647
DEFAULT_CLASS = "person"
# Spellings of "no class", compared without case.
EMPTY_CLASS_WORDS = ["", "none", "null"]
# Zoned ISO-8601 only; a local timestamp does not say when it happened.
ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
ZONED_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_class(c: Column | str) -> Column:
    """Trimmed class name, ``person`` when it says nothing."""
    text = F.trim(_col(c))
    empty = text.isNull() | F.lower(text).isin(EMPTY_CLASS_WORDS)
    return F.when(empty, F.lit(DEFAULT_CLASS)).otherwise(text)


def whole_number(c: Column | str, default: int, kind: str = "int") -> Column:
    """Text to a whole number, fractions cut off, ``default`` for junk."""
    text = _col(c)
    return F.coalesce(
        text.try_cast(kind), text.try_cast("double").try_cast(kind), F.lit(default).cast(kind)
    )


def pixel(c: Column | str) -> Column:
    """Text or number to a pixel: halves round up, junk is 0, never below 0."""
    value = F.coalesce(_col(c).try_cast("double"), F.lit(0.0))
    value = F.when(F.isnan(value), F.lit(0.0)).otherwise(value)
    return F.least(F.greatest(F.floor(value + 0.5), F.lit(0)), F.lit(INT_MAX)).cast("int")


def confidence(c: Column | str) -> Column:
    """Confidence in [0, 1]; unknown counts as 0."""
    value = F.coalesce(_col(c), F.lit(0.0))
    value = F.when(F.isnan(value), F.lit(0.0)).otherwise(value)
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def zoned_timestamp(c: Column | str) -> Column:
    """Zoned ISO text to an instant, NULL for anything else."""
    text = _col(c)
    return F.when(text.rlike(ZONED_ISO), text.try_cast("timestamp"))


def number(c: Column | str) -> Column:
    """Text or number as a double; NULL for junk and for what is not a number."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def batch_time(c: Column | str) -> Column:
    """ISO text to the millisecond. Without a zone it is a time of the session's zone, a
    date alone its midnight; NULL for anything else."""
    text = _col(c)
    return ntz_from_millis(F.unix_millis(F.when(text.rlike(ISO), text.try_cast("timestamp"))))


def ntz_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a UTC wall-clock timestamp, whatever the session zone."""
    return F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01").cast("timestamp_ntz"))


def capture_time(c: Column | str, now: Column) -> Column:
    """Capture time to the millisecond; ``now`` when it cannot be read."""
    return ntz_from_millis(F.unix_millis(F.coalesce(zoned_timestamp(c), now)))


def ntz_from_instant(ts: Column) -> Column:
    """An instant to a UTC wall-clock timestamp with microseconds."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast("timestamp_ntz"))


def trunc_to(unit: str, ts: Column | str) -> Column:
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def millis_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", a, b)


def seconds_between(a: Column, b: Column, whole: bool) -> Column:
    """Elapsed seconds as a double, cut to whole seconds or with milliseconds."""
    if whole:
        return F.timestamp_diff("SECOND", a, b).cast("double")
    return millis_between(a, b) / F.lit(1000.0)
