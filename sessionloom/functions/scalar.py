"""Small expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_to_timestamp(seconds: str) -> Column:
    """Epoch seconds (double, with fraction) to an instant. Infinite or out-of-range numbers
    give null instead of failing the job."""
    return F.col(seconds).try_cast("timestamp")


def timestamp_to_epoch(instant: Column) -> Column:
    """Instant to epoch seconds with the microseconds as fraction."""
    return F.unix_micros(instant) / F.lit(1e6)


def ratio_or_zero(part: str, whole: str) -> Column:
    """part / whole, 0.0 where whole is 0 or either is null."""
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def event_clock(column: str = "event_time") -> Column:
    """The event-time column without the watermark tag an upstream query may have stored in
    its files."""
    return F.col(column).alias(column, metadata={})


def utc_wall_clock(instant: Column) -> Column:
    """Instant as UTC ``timestamp_ntz``, whatever the session's time zone."""
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz")
    )


def utc_instant(wall_clock: Column) -> Column:
    """UTC ``timestamp_ntz`` as an instant, whatever the session's time zone."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall_clock))


def utc_date(instant: Column) -> Column:
    """UTC date of an instant, whatever the session's time zone."""
    days = F.floor(F.unix_micros(instant) / F.lit(86_400_000_000))
    return F.date_from_unix_date(days.cast("int"))


def computed_once(df: DataFrame) -> DataFrame:
    """Same rows, with the columns' expressions evaluated here. Filters further up are not
    pushed below, where each condition would evaluate its column's expression anew."""
    return df.select(F.inline_outer(F.array(F.struct(*df.columns))))


def micros(interval: str) -> int:
    """Microseconds in a day-time interval text such as "30 minutes"."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    words = interval.split()
    total = 0
    for number, unit in zip(words[::2], words[1::2], strict=True):
        total += int(number) * units[unit.lower().rstrip("s")]
    if total <= 0:
        raise ValueError(f"not a positive interval: {interval!r}")
    return total * 1_000_000
