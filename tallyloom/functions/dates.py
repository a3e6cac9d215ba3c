"""Timestamp column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(value: Column) -> Column:
    """A zone-free timestamp, or null for text that is not one."""
    return value.try_cast("timestamp_ntz")


def within(value: Column, first: str, last: str) -> Column:
    """True inside the window; both ends belong to it."""
    return value.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))


def not_after_day(value: Column, as_of: str) -> Column:
    """True when the calendar day of `value` is not later than `as_of` (`YYYY-MM-DD`)."""
    return value.cast("date") <= F.lit(as_of).cast("date")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from `start` to `end`; null when either is missing."""
    return F.datediff(end, start)


def calendar_parts(value: Column, prefix: str) -> dict[str, Column]:
    """Year, month and day of week (1 = Sunday), keyed by output name."""
    return {
        f"{prefix}_year": F.year(value),
        f"{prefix}_month": F.month(value),
        f"{prefix}_dayofweek": F.dayofweek(value),
    }
