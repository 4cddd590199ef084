"""Product segments: k-means over standardised profiles, labelled by price level.

All restarts run together: a point is taken once for each unfinished restart inside its task, and one aggregation by
(restart, cluster) gives every restart its next centres. Centres are restarts * k small rows, a bound set by parameters.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.ml.profile import standardise
from pricelake.session import cut

MOVED = 1e-4        # a restart is done when no centre moves farther

Centres = dict[int, list[tuple[float, ...]]]    # of each restart


def cluster_count(products: int) -> int:
    return min(len(fixed.SEGMENT_LABELS), max(2, products // 25))


def label_by_price(clustered: DataFrame) -> DataFrame:
    """Names clusters by the rank of their mean price, which does not depend on cluster numbers.

    The ranking window runs over one row per cluster.
    """
    names = F.array(*[F.lit(n) for n in fixed.SEGMENT_LABELS])
    place = F.row_number().over(Window.orderBy("_level", "segment_id"))
    ranked = clustered.groupBy("segment_id").agg(F.avg("avg_price").alias("_level")).select(
        "segment_id",
        F.element_at(names, F.least(place, F.lit(len(fixed.SEGMENT_LABELS)))).alias("segment_name"))
    return clustered.join(F.broadcast(ranked), "segment_id")


def _with_restarts(points: DataFrame, columns: list[str], centres: Centres) -> DataFrame:
    """The points once for each restart: _restart, _segment (the nearest centre, the first of equal ones) and _cost (its
    squared distance). Everything is arithmetic on columns, inside the scan's stage."""
    # the centres are one constant and the arithmetic is text: plans and generated code are alike in every step
    names = [f"c{i}_{j}" for i in range(len(next(iter(centres.values())))) for j in range(len(columns))]
    rows = [{"restart": r, **dict(zip(names, (float(v) for centre in own for v in centre), strict=True))} for r, own in centres.items()]
    schema = f"array<struct<restart:int,{','.join(f'{n}:double' for n in names)}>>"
    spread = points.withColumn("_c", F.explode(F.from_json(F.lit(json.dumps(rows)), schema)))
    k = len(names) // len(columns)
    distances = [" + ".join(f"(`{c}` - _c.c{i}_{j}) * (`{c}` - _c.c{i}_{j})" for j, c in enumerate(columns)) for i in range(k)]
    spread = spread.selectExpr(*[f"`{c}`" for c in points.columns], "_c.restart AS _restart",
                               *[f"{d} AS _d{i}" for i, d in enumerate(distances)])
    least = f"least({', '.join(f'_d{i}' for i in range(k))})" if k > 1 else "_d0"
    nearest = "CASE " + " ".join(f"WHEN _d{i} = {least} THEN {i}" for i in range(k)) + " END"
    return spread.selectExpr(*[f"`{c}`" for c in points.columns], "_restart", f"{nearest} AS _segment", f"{least} AS _cost")


def first_centres(points: DataFrame, columns: list[str], key: str, k: int, restarts: int, seed: int) -> Centres:
    """Seeded k-means++ starts of all restarts, one pass for each further centre: the next one is drawn with a chance in
    proportion to the squared distance from those there are. With fewer distinct points than k a centre repeats."""
    def draw(part: Column, turn: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), part, F.col(key)), F.lit(1 << 52)) + 1) / float(1 << 52)

    taken = F.struct(*columns)
    numbers = F.array(*map(F.lit, range(restarts)))
    first = points.withColumn("_restart", F.explode(numbers)).groupBy("_restart").agg(
        F.min_by(taken, F.struct(draw(F.col("_restart"), 0), key)).alias("at")).collect()
    centres = {r["_restart"]: [tuple(r["at"])] for r in sorted(first, key=lambda r: r["_restart"])}
    for turn in range(1, k if centres else 0):
        spread = _with_restarts(points, columns, centres)
        race = F.when(F.col("_cost") > 0, -F.log(draw(F.col("_restart"), turn)) / F.col("_cost"))
        found = {r["_restart"]: r["at"] for r in spread.filter(race.isNotNull()).groupBy("_restart").agg(
            F.min_by(taken, F.struct(race, key)).alias("at")).collect()}
        centres = {r: [*own, tuple(found[r]) if r in found else own[0]] for r, own in centres.items()}
    return centres


def lloyd(points: DataFrame, columns: list[str], centres: Centres, most: int, moved: float = MOVED) -> Centres:
    """The centres after at most `most` steps, one job a step for all restarts that are not done. An empty cluster keeps
    its centre."""
    centres, open_ = dict(centres), set(centres)
    for _ in range(most):
        if not open_:
            break
        own = {r: centres[r] for r in sorted(open_)}
        means = _with_restarts(points, columns, own).groupBy("_restart", "_segment").agg(*[F.avg(c).alias(c) for c in columns])
        found = {(r["_restart"], r["_segment"]): tuple(r[c] for c in columns) for r in means.collect()}
        for restart, before in own.items():
            after = [found.get((restart, i), centre) for i, centre in enumerate(before)]
            centres[restart] = after
            if max(sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(before, after)) <= moved * moved:
                open_.discard(restart)
    return centres


def costs(points: DataFrame, columns: list[str], centres: Centres) -> dict[int, float]:
    """The sum of squared distances of every restart, in one pass."""
    found = _with_restarts(points, columns, centres).groupBy("_restart").agg(F.sum("_cost").alias("cost")).collect()
    return {r["_restart"]: r["cost"] for r in found}


def product_segments(profile: DataFrame, products: DataFrame, restarts: int = 10,
                     max_iter: int = 50, seed: int = fixed.SEED) -> DataFrame:
    """Segments of all profiled products; of several seeded starts the tightest clustering is kept."""
    profile = cut(profile, "profile")
    columns = fixed.PROFILE_COLUMNS
    points = cut(standardise(profile).select("product_id", *columns), "points")
    centres = first_centres(points, columns, "product_id", cluster_count(profile.count()), restarts, seed)
    centres = lloyd(points, columns, centres, max_iter)
    cost = costs(points, columns, centres) if centres else {}
    best = min(cost, key=lambda r: (cost[r], r), default=None)
    if best is None:
        assigned = points.select("product_id", F.lit(0).alias("segment_id"))
    else:
        assigned = _with_restarts(points, columns, {best: centres[best]}).select(
            "product_id", F.col("_segment").alias("segment_id"))
    clustered = cut(profile.join(assigned, "product_id"), "clustered")
    named = products.select("product_id", "product_name", "category", "brand")
    return label_by_price(clustered).join(named, "product_id").select(
        "product_id", *fixed.PROFILE_COLUMNS, "segment_id", "segment_name", "product_name", "category",
        "brand")
