"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(value: Column) -> Column:
    """Calendar day of a date, timestamp or text whose first ten characters are yyyy-MM-dd."""
    return F.to_date(F.substring(value.cast("string"), 1, 10), "yyyy-MM-dd")


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(day) + 1).cast("int")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def day_key(day: Column) -> Column:
    """Integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def month_key(date_sk: Column) -> Column:
    """Integer yyyymm of an integer yyyymmdd."""
    return F.floor(date_sk / 100).cast("int")


def monday_week(day: Column) -> Column:
    """Week of the year with Monday first; days before the first Monday are week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
