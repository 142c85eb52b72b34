"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def parsed(text: Column) -> Column:
    """Wall-clock time from ``yyyy-MM-dd HH:mm[:ss[.f]]`` text; NULL when empty or malformed."""
    return text.try_cast("timestamp_ntz")


def years_before(day: Column, years: int) -> Column:
    return F.add_months(day, -12 * years)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def epoch_millis(wall_clock: Column, zone: str = "UTC") -> Column:
    """Milliseconds since the epoch of a wall-clock time read in ``zone``."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock)
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH).cast("timestamp_ntz"), utc)


def second_of_day(wall_clock: Column) -> Column:
    return F.hour(wall_clock) * 3600 + F.minute(wall_clock) * 60 + F.second(wall_clock)
