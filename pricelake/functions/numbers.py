"""Numeric columns: cleaning, guarded division, clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_price(raw: Column) -> Column:
    """Price text to a positive double of two places; anything else is null.

    Quotes are dropped at the ends only, thousands commas anywhere.
    """
    bare = F.regexp_replace(F.regexp_replace(raw.cast("string"), r"^\s+|\s+$", ""), r'^"+|"+$', "")
    value = F.regexp_replace(bare, ",", "").try_cast("double")
    return F.when((value > 0) & ~F.isnan(value), F.round(value, 2))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or null."""
    return F.try_divide(a, b)


UNITS = 10_000      # decimal places of these values are summed as whole numbers


def mean(column: str) -> Column:
    """The mean of a group, an aggregate. Where all values have at most four decimal places it is the double next to the
    exact mean, whatever the order of the rows; a sum of doubles may miss a bound that the mean lies on. Other values are
    averaged as doubles."""
    value = F.col(column).cast("double")
    units = F.round(value * UNITS)
    whole = F.when((F.abs(value) < 1e9) & (units / UNITS == value), units.cast("bigint"))
    exact = ratio(F.try_sum(whole).cast("double"), F.count(value) * F.lit(float(UNITS)))
    return F.coalesce(F.when(F.count(whole) == F.count(value), exact), F.avg(value))


def zero_if_missing(value: Column) -> Column:
    """Null and NaN become 0."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on either side; null stays null."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)
