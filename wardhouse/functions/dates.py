"""Date arithmetic that counts calendar boundaries.

A difference here is the number of day, hour or minute boundaries between two
timestamps: 23:45 to 00:30 is one hour. Only calendar fields are used, so
zone-less timestamps give the same answer in every session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return days_between(start, end) * 24 + (F.hour(end) - F.hour(start))


def minutes_between(start: Column, end: Column) -> Column:
    return hours_between(start, end) * 60 + (F.minute(end) - F.minute(start))


def age_in_years(birth: Column, at: Column) -> Column:
    """Completed years, taking a year as 365.25 days."""
    return F.floor(days_between(birth, at) / F.lit(365.25)).cast("bigint")


# Reporting periods and the truncation unit of each.
PERIODS = {"day": "DAY", "month": "MM", "year": "YEAR"}


def period_start(day: Column, period: str) -> Column:
    """First day of the reporting period a date falls in."""
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}; known periods: {list(PERIODS)}")
    return F.to_date(day) if period == "day" else F.trunc(day, PERIODS[period])
