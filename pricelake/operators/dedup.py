"""One row per key, without collecting a key's rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """For each key the row that is greatest in `order`; the columns keep their places.

    An aggregate, not a ranked window: every map task first reduces each key to one row, so a key that
    holds a large share of the input sends one row per task through the shuffle. Rows equal in `order` are
    told apart by their other columns, so the result never depends on the partitioning.
    """
    lead = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    if any(word in df.schema[c].dataType.simpleString() for c in rest for word in ("map<", "variant")):
        last = F.max_by(F.struct(*lead, *rest), F.struct(*lead))  # types without an order of their own
    else:
        last = F.max(F.struct(*lead, *rest))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*").select(*df.columns)


def duplicated_keys(df: DataFrame, keys: list[str], count_name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).filter(F.col(count_name) > 1)
