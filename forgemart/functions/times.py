"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reporting period and the unit it truncates to.
PERIODS = {"daily": "day", "weekly": "week", "monthly": "month"}


def parse_time(text: Column) -> Column:
    """ISO-8601 text as a timestamp; blank or malformed text becomes null even under ANSI mode."""
    return F.try_to_timestamp(text)


def date_id(ts: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours at second precision; null while either end is missing."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0)


def period_start(period: str, ts: Column) -> Column:
    """First day of the daily, weekly (from Monday) or monthly period."""
    return F.date_trunc(PERIODS[period], ts).cast("date")


def day_of_week(day: Column) -> Column:
    """0 is Monday, 6 is Sunday."""
    return F.weekday(day)
