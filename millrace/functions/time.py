"""Time expressions of the trip and edit jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, and the hour or month each label starts at.
PERIODS = ("morning", "afternoon", "evening", "late night")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SEASONS = ("winter", "spring", "summer", "fall")


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes, as a double."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def period_of_day(time: Column) -> Column:
    hour = F.hour(time)
    return (
        F.when(hour >= 18, "evening")
        .when(hour >= 12, "afternoon")
        .when(hour >= 6, "morning")
        .otherwise("late night")
    )


def weekday(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def season(time: Column) -> Column:
    """Meteorological season of the northern hemisphere; null for a null time."""
    # December counts as month 0 of the winter that follows.
    return F.element_at(
        F.array(*[F.lit(name) for name in SEASONS]),
        F.floor((F.month(time) % 12) / 3).cast("int") + 1,
    )


def in_period(time: Column, start: str, end: str) -> Column:
    """Half-open range. Plain text bounds take the column's own type, so the test reaches the scan."""
    return (time >= F.lit(start)) & (time < F.lit(end))
