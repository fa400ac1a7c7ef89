"""Day arithmetic. Days are DATE values, instants are epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds in a day, and the offset of the zone in which log days start.
DAY_SECONDS = 86_400
ZONE_HOURS = 8


def date_sequence(begin: Column, end: Column) -> Column:
    """Array of the days begin..end inclusive; only ``begin`` when end is not later."""
    return F.sequence(begin, F.greatest(begin, end))


def shift_days(day: Column, days: int) -> Column:
    """The day ``days`` later, or earlier when negative."""
    return F.date_add(day, days)


def epoch_seconds(day: Column, zone_hours: int = ZONE_HOURS) -> Column:
    """Epoch second at which the day starts in the zone; the session zone plays no part."""
    return (F.unix_date(day).cast("bigint") * DAY_SECONDS) - zone_hours * 3600


def day_bounds(day: Column, zone_hours: int = ZONE_HOURS) -> Column:
    """Half-open range ``[start, stop)`` of the day in epoch seconds."""
    start = epoch_seconds(day, zone_hours)
    return F.struct(start.alias("start"), (start + DAY_SECONDS).alias("stop"))
