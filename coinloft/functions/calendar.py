"""Date rules. The report day is always passed in; nothing reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import ColumnLike, as_col, is_true

DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.44


def day(as_of: dt.date) -> Column:
    return F.lit(as_of)


def age_years(born: ColumnLike, as_of: dt.date, nearest: bool = False) -> Column:
    """Completed years (days / 365.25 cut off), or the nearest whole number."""
    years = F.datediff(day(as_of), as_col(born)) / F.lit(DAYS_PER_YEAR)
    return (F.round(years, 0) if nearest else F.floor(years)).cast("int")


def tenure_days(since: ColumnLike, as_of: dt.date) -> Column:
    return F.datediff(day(as_of), as_col(since))


def tenure_years(since: ColumnLike, as_of: dt.date) -> Column:
    """Years with two decimals, in decimal arithmetic so that ties round half up."""
    days = F.datediff(day(as_of), as_col(since)).cast("decimal(12,0)")
    return F.round(days * F.lit(100) / F.lit(36525), 2).cast("decimal(6,2)")


def open_days(start: ColumnLike, end: ColumnLike, as_of: dt.date) -> Column:
    """Days from start to end, or to the report day while still open."""
    return F.datediff(F.coalesce(as_col(end), day(as_of)), as_col(start))


def days_until(value: ColumnLike, as_of: dt.date) -> Column:
    return F.datediff(as_col(value), day(as_of))


def months_since(value: ColumnLike, as_of: dt.date) -> Column:
    return F.floor(F.datediff(day(as_of), as_col(value)) / F.lit(DAYS_PER_MONTH)).cast("int")


def expired(value: ColumnLike, as_of: dt.date) -> Column:
    return is_true(as_col(value) < day(as_of))


def expiring_soon(value: ColumnLike, as_of: dt.date, within: int = 30) -> Column:
    return is_true(days_until(value, as_of).between(0, within))


def not_past(value: ColumnLike, as_of: dt.date) -> Column:
    c = as_col(value)
    return c.isNull() | (c >= day(as_of))


def recent_start(as_of: dt.date, days: int) -> Column:
    """First day of the rolling window that ends on the report day."""
    return F.lit(as_of - dt.timedelta(days=days))
