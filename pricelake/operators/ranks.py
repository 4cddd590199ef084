"""Ranks over whole tables without a one-partition sort.

Exact order statistics come from narrowing an interval of values around the wanted ranks: a quantile sketch with
a guaranteed rank error gives a smaller interval, one aggregation counts what lies below it, on its ends and
inside, and the loop goes on strictly inside until few rows are left. A value that holds a large share of the
rows can only be an end, where it is counted and answered. Driver and tasks see sketches, counts and at most
LOOK_UP values, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ERROR = 0.002
LOOK_UP = 1_000            # values of the last interval that are looked at one by one
BUCKET_ROWS = 50_000       # rows that one task numbers in dense_ids, about


def values_at_ranks(df: DataFrame, column: str, wanted: list[int]) -> list[float | None]:
    """The exact values at 0-based ranks of the values in ascending order; None past the end.

    Nulls and NaN have no rank. Ranks next to each other are narrowed together. `df` is read several times and
    should be a stored table where it is dear to compute.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    total = values.count()
    found: dict[int, float] = {}
    ranks = sorted({rank for rank in wanted if rank < total})
    while ranks:
        near = [rank for rank in ranks if rank - ranks[0] < len(ranks)]
        ranks = ranks[len(near):]
        found |= _narrow(values, total, near)
    return [found.get(rank) for rank in wanted]


def _narrow(values: DataFrame, total: int, wanted: list[int]) -> dict[int, float]:
    """Values at neighbouring ranks."""
    below, inside, found = 0, values, {}
    v = F.col("v")
    while wanted and total > LOOK_UP:
        first, last = ((rank - below) / total for rank in (wanted[0], wanted[-1]))
        probes = [max(0.0, first - 2 * SKETCH_ERROR), min(1.0, last + 2 * SKETCH_ERROR)]
        low, high = inside.approxQuantile("v", probes, SKETCH_ERROR)
        under, at_low, between, at_high = inside.agg(
            F.count_if(v < low), F.count_if(v == low), F.count_if((v > low) & (v < high)),
            F.count_if((v == high) & (v > low))).first()
        if wanted[0] < below + under or wanted[-1] >= below + under + at_low + between + at_high:
            raise ArithmeticError("rank outside the interval of the sketch")
        start = below + under + at_low
        found |= {rank: low for rank in wanted if rank < start}
        found |= {rank: high for rank in wanted if rank >= start + between}
        wanted = [rank for rank in wanted if start <= rank < start + between]
        below, total = start, between
        inside = inside.filter((v > low) & (v < high))
    if wanted:
        for value, n in sorted(tuple(r) for r in inside.groupBy("v").agg(F.count("*")).collect()):
            found |= {rank: value for rank in wanted if below <= rank < below + n}
            below += n
    return found


def quantile(df: DataFrame, column: str, share: float, n: int | None = None) -> float | None:
    """Exact quantile with linear interpolation between neighbouring ranks."""
    n = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count() if n is None else n
    if not n:
        return None
    position = share * (n - 1)
    lower = int(position)
    a, b = values_at_ranks(df, column, [lower, min(lower + 1, n - 1)])
    return a + (b - a) * (position - lower)


def median(df: DataFrame, column: str) -> float | None:
    return quantile(df, column, 0.5)


def nearest_quantile_by_count(df: DataFrame, column: str, share: float) -> DataFrame:
    """One row `cutoff`: the value at rank round(share * (n - 1)) of a column of few distinct values.

    Meant for days: the window runs over one row per distinct value, not over the data.
    """
    per_value = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    through = F.sum("n").over(Window.orderBy("v"))
    wanted = F.round((total - 1) * share)
    return per_value.select("v", through.alias("through"), wanted.alias("wanted")).filter(
        F.col("through") > F.col("wanted")).agg(F.min("v").alias("cutoff"))


def top_share(df: DataFrame, column: str, share: float) -> tuple[int, float | None, bool]:
    """(budget, threshold, inclusive): which values have an average descending rank within the budget.

    The budget is max(1, int(n * share)) of all rows, with null values counted but never ranked. Values
    above the budget-th largest value always pass; that value itself passes as a tie group where its
    average rank does; nothing below can.
    """
    n, ranked = df.agg(F.count("*"), F.count(column)).first()
    budget = max(1, int(n * share))
    if not ranked:
        return budget, None, False
    if ranked <= budget:
        return budget, df.agg(F.min(column)).first()[0], True
    threshold = values_at_ranks(df, column, [ranked - budget])[0]
    above, ties = df.agg(
        F.sum(F.when(F.col(column) > threshold, 1).otherwise(0)),
        F.sum(F.when(F.col(column) == threshold, 1).otherwise(0)),
    ).first()
    return budget, threshold, above + (ties + 1) / 2 <= budget


def dense_ids(df: DataFrame, order: str, name: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Number rows 1..n in the order of a unique numeric column.

    Rows go to buckets of about `bucket_rows` between quantiles of the column, each bucket numbers its own
    rows, and the bucket sizes give the offsets. The boundaries are literals, so both reads of the input
    agree on who is where.
    """
    buckets = df.count() // bucket_rows + 2
    probes = [i / buckets for i in range(1, buckets)]
    keyed = df.withColumn("_order", F.col(order).cast("double"))
    bounds = sorted(set(keyed.approxQuantile("_order", probes, 1 / (4 * buckets))))
    if not bounds:
        return df.select(F.lit(None).cast("bigint").alias(name), *df.columns)
    edges = [float("-inf"), *bounds, float("inf")]
    placed = Bucketizer(splits=edges, inputCol="_order", outputCol="_bucket").transform(keyed)
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    offsets = sizes.select("_bucket", before.alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return (
        placed.withColumn("_within", within)
        .join(offsets, "_bucket")
        .select((F.col("_offset") + F.col("_within")).cast("bigint").alias(name), *df.columns)
    )
