"""Data tests. Each returns the violations; an empty result passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators.dedup import duplicated_keys


class CheckFailed(Exception):
    """A data test or gate did not hold."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return duplicated_keys(df.filter(F.col(column).isNotNull()), [column])


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct foreign keys, other than null, that the parent lacks."""
    keys = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("from_key")).distinct()
    known = parent.select(F.col(parent_column).alias("to_key"))
    return keys.join(known, keys["from_key"] == known["to_key"], "left_anti")


def unique_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicated_keys(df, keys)


def require_empty(violations: dict[str, DataFrame]) -> None:
    """Raise with the names of all tests that found violations."""
    failed = [name for name, found in violations.items() if not found.isEmpty()]
    if failed:
        raise CheckFailed(", ".join(failed))
