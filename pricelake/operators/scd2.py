"""Type 2 history of a keyed entity, one snapshot at a time."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_hash(columns: list[str], side: str = "") -> Column:
    """A digest of the checked columns; nulls and empty texts differ."""
    return F.sha2(F.to_json(F.array(*[F.to_json(F.struct(F.col(f"{side}{c}").alias("v"))) for c in columns])), 256)


def snapshot(previous: DataFrame | None, incoming: DataFrame, key: str, check: list[str],
             effective: dt.datetime, hashed: bool = False) -> DataFrame:
    """The history after one more batch.

    A row whose checked columns differ (nulls compare equal) closes its open version at `effective`
    and opens a new one. Changes to other columns do not version, and keys absent from the batch stay
    open. One full outer join of open versions and batch emits old and new versions together; closed
    versions pass by untouched. Where both are stored in like buckets of the key (`Lake.write_bucketed`) nothing is
    shuffled.

    With `hashed` a version carries a digest of its checked columns, `check_hash`, which decides changes, so the checked
    columns themselves are compared nowhere.
    """
    if hashed:
        incoming = incoming.withColumn("check_hash", check_hash(check))
        check = ["check_hash"]
    columns = incoming.columns
    at = F.lit(effective.isoformat(sep=" ")).cast("timestamp")
    open_end = F.lit(None).cast("timestamp")
    if previous is None:
        return incoming.select("*", at.alias("valid_from"), open_end.alias("valid_to"))

    closed = previous.filter(F.col("valid_to").isNotNull())
    old = previous.filter(F.col("valid_to").isNull()).alias("o")
    new = incoming.alias("n")
    has_old, has_new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check])
    changed = has_old & has_new & ~same
    kept = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in columns],
        F.col("o.valid_from").alias("valid_from"),
        F.when(changed, at).otherwise(open_end).alias("valid_to"),
    )
    opened = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in columns],
        at.alias("valid_from"),
        open_end.alias("valid_to"),
    )
    versions = F.array_compact(F.array(
        F.when(has_old, kept), F.when(~has_old | changed, opened)))
    merged = (
        old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
        .select(F.explode(versions).alias("v"))
        .select("v.*")
    )
    return closed.select(*merged.columns).unionByName(merged)
