"""The five quality dimensions of the observations and their weighted composite."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.operators.checks import CheckFailed


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _holds(condition: Column) -> Column:
    """Rows where the condition is true; null is not."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


COUNTS = ("n", "nulls", "valid", "priced", "fair")


def _counted() -> list[Column]:
    """The counts that need no key."""
    valid = (
        (F.col("price") > 0)
        & F.col("discount_percentage").between(0, fixed.MAX_DISCOUNT)
        & (F.col("rating").isNull() | F.col("rating").between(0, fixed.MAX_RATING))
    )
    nulls = sum((F.col(c).isNull().cast("bigint") for c in fixed.CRITICAL_COLUMNS), F.lit(0))
    has_original = F.col("original_price").isNotNull()
    fair = has_original & (F.col("price") <= F.col("original_price") * fixed.PRICE_TOLERANCE)
    return [
        F.count("*").alias("n"),
        F.sum(nulls).alias("nulls"),
        _holds(valid).alias("valid"),
        _holds(has_original).alias("priced"),
        _holds(fair).alias("fair"),
    ]


def _per_key(observations: DataFrame) -> DataFrame:
    """Counts by product and day, which also meets each key once for uniqueness (null keys included)."""
    return observations.groupBy("product_id", "observed_date").agg(*_counted())


def _keys(observations: DataFrame) -> DataFrame:
    """One row: the number of different keys (null keys included). Only keys are moved, and they are dealt first: most
    occur once, so a task's table of them would be as long as its input."""
    key = observations.select("product_id", "observed_date")
    return key.repartition("product_id", "observed_date").distinct().agg(F.count("*").alias("keys"))


def daily_counts(observations: DataFrame) -> DataFrame:
    """The state behind a report: observed_date, keys and the other counts, a row a day. A key belongs to one day, so states of
    different days add up; a day that comes again whole replaces its row (`merged_counts`)."""
    return _per_key(observations).groupBy("observed_date").agg(
        F.count("*").alias("keys"), *[F.sum(c).alias(c) for c in COUNTS])


def merged_counts(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The state after a delivery of whole days."""
    days = fresh.select(F.col("observed_date").alias("_day"))
    kept = stored.join(days, F.col("observed_date").eqNullSafe(F.col("_day")), "left_anti")
    return kept.unionByName(fresh)


def dimensions(observations: DataFrame, as_of: dt.date) -> DataFrame:
    """One row of unrounded dimensions, from two passes: the counts, which need no shuffle, and the different keys."""
    counts = observations.agg(*_counted(), F.max("observed_date").alias("observed_date"))
    return dimensions_of(counts.withColumn("keys", _keys(observations).scalar()), as_of)


def dimensions_of(counts: DataFrame, as_of: dt.date) -> DataFrame:
    """The same from counts that add up, such as the daily state."""
    totals = counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) if c in ("n", "keys") else F.sum(c).alias(c) for c in (*COUNTS, "keys")],
        F.max("observed_date").alias("latest"),
    )
    n = F.col("n")
    stale = F.coalesce(F.datediff(F.lit(as_of), "latest"), F.lit(fixed.NO_DATA_STALENESS_DAYS))
    fresh = 1 - stale / fixed.FRESHNESS_HORIZON_DAYS
    return totals.select(
        F.when(n > 0, 1 - _share(F.col("nulls"), n * len(fixed.CRITICAL_COLUMNS)))
        .otherwise(0.0).alias("completeness"),
        _share(F.col("keys"), n).alias("uniqueness"),
        _share(F.col("valid"), n).alias("validity"),
        _share(F.col("fair"), F.col("priced")).alias("consistency"),
        F.least(F.greatest(fresh, F.lit(0.0)), F.lit(1.0)).alias("freshness"),
        n.cast("bigint").alias("rows_evaluated"),
    )


def quality_report(observations: DataFrame, as_of: dt.date, rejected_rows: int | Column = 0,
                   computed_at: dt.datetime | None = None) -> DataFrame:
    """The one-row report: rounded dimensions, composite of the rounded values, counts. `rejected_rows` may be a
    scalar subquery."""
    return _report(dimensions(observations, as_of), rejected_rows, computed_at)


def quality_report_of(counts: DataFrame, as_of: dt.date, rejected_rows: int | Column = 0,
                      computed_at: dt.datetime | None = None) -> DataFrame:
    """The report from the daily state; the observations are not read."""
    return _report(dimensions_of(counts, as_of), rejected_rows, computed_at)


def _report(found: DataFrame, rejected_rows: int | Column, computed_at: dt.datetime | None) -> DataFrame:
    names = list(fixed.QUALITY_WEIGHTS)
    rounded = found.select(
        *[F.round(c, 4).alias(c) for c in names], "rows_evaluated")
    composite = sum((F.col(c) * w for c, w in fixed.QUALITY_WEIGHTS.items()), F.lit(0.0))
    stamp = F.lit(computed_at.isoformat(sep=" ")) if computed_at else F.current_timestamp()
    return rounded.select(
        stamp.cast("timestamp").alias("computed_at"),
        *names,
        F.round(composite, 4).alias("composite_score"),
        "rows_evaluated",
        F.lit(rejected_rows).cast("bigint").alias("rejected_rows"),
    )


def gate(report: DataFrame, metric: str = "composite_score",
         floor: float = fixed.QUALITY_SLO) -> float:
    """The metric of the report; raises where it is below the floor or absent."""
    value = report.select(metric).first()[0]
    if value is None or value < floor:
        raise CheckFailed(f"{metric} {value} is below {floor}")
    return value


def freshness_gate(report: DataFrame) -> float:
    return gate(report, "freshness", fixed.FRESHNESS_SLO)
