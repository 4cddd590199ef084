"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) on Spark.

Every tree sees a uniform sample of fixed size, so growing costs the same whatever the data: rows are
thinned by a hash of their key in the scan, and each tree is grown where its few hundred rows meet. The
grown forest is at most trees * 2 * sample nodes, a bound set by its parameters, and is sent to the
executors, which score Arrow batches with numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed

OVERSAMPLE = 1.5
NODE = "tree int, node int, feature int, cut double, left int, right int, path double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def tree_samples(rows: DataFrame, key: list[str], columns: list[str], n: int, trees: int, size: int,
                 seed: int) -> DataFrame:
    """(tree, order, columns): up to `size` rows per tree, uniform without replacement.

    Where rows are plenty each serves at most one tree; where they are few each serves several.
    """
    wanted = OVERSAMPLE * trees * size
    copies = max(1, min(trees, math.ceil(wanted / max(n, 1))))
    keep = min(1.0, wanted / (max(n, 1) * copies))
    draw = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 40)) / float(1 << 40)
    first = F.pmod(F.xxhash64(F.lit(seed + 1), *key), F.lit(trees))
    spread = (
        rows.filter(draw < keep)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("tree", F.pmod(first + F.col("_copy"), F.lit(trees)).cast("int"))
        .withColumn("order", F.xxhash64(F.lit(seed + 2), "tree", *key))
        .select("tree", "order", *columns)
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("order", *columns))
    return spread.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")


def _grow(columns: list[str], size: int, seed: int):
    depth_limit = max(1, math.ceil(math.log2(max(size, 2))))

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        points = sample.sort_values(["order", *columns])[columns].to_numpy(dtype=float)
        random = np.random.default_rng([seed, tree])
        nodes: list[tuple] = []
        waiting = [(0, np.arange(len(points)), 0)]
        made = 1
        while waiting:
            node, rows, depth = waiting.pop()
            inside = points[rows]
            low, high = inside.min(axis=0), inside.max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(rows) <= 1 or not len(splittable):
                nodes.append((tree, node, 0, np.inf, node, node, depth + average_path(len(rows))))
                continue
            feature = int(random.choice(splittable))
            at = float(random.uniform(low[feature], high[feature]))
            goes_left = inside[:, feature] <= at
            nodes.append((tree, node, feature, at, made, made + 1, 0.0))
            waiting.append((made, rows[goes_left], depth + 1))
            waiting.append((made + 1, rows[~goes_left], depth + 1))
            made += 2
        return pd.DataFrame(nodes, columns=[p.split()[0] for p in NODE.split(", ")])

    return grow


def grown(rows: DataFrame, key: list[str], columns: list[str], n: int, trees: int = fixed.FOREST_TREES,
          size: int = fixed.FOREST_SAMPLE, seed: int = fixed.SEED) -> DataFrame:
    """The forest as a relation, a row a node: tree, node (0 is the root), the feature's place in `columns`, cut (values up to
    it go left), left, right, path. A leaf is its own child, and its path is its depth and what its rows would add to it.
    At most trees * (2 * size - 1) rows."""
    return tree_samples(rows, key, columns, n, trees, size, seed).groupBy("tree").applyInPandas(_grow(columns, size, seed), NODE)


def arrays_of(nodes: DataFrame, size: int) -> dict:
    """A node relation as flat arrays for scoring; `size` is the number of rows behind a tree."""
    table = nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    starts = table.index[table["node"] == 0].to_numpy()
    base = np.repeat(starts, np.diff(np.append(starts, len(table))))
    children = np.column_stack([table["left"] + base, table["right"] + base])
    return {
        "roots": starts.astype(np.int32),
        "feature": table["feature"].to_numpy(dtype=np.int32),
        "cut": table["cut"].to_numpy(dtype=float),
        "children": children.astype(np.int32).ravel(),  # of node i: left at 2i, right at 2i + 1
        "path": table["path"].to_numpy(dtype=float),
        "scale": average_path(size) or 1.0,
        "levels": max(1, math.ceil(math.log2(max(size, 2)))),
    }


def fit(rows: DataFrame, key: list[str], columns: list[str], n: int, trees: int = fixed.FOREST_TREES,
        size: int = fixed.FOREST_SAMPLE, seed: int = fixed.SEED) -> dict:
    """The forest as flat arrays."""
    size = min(size, n)
    return arrays_of(grown(rows, key, columns, n, trees, size, seed), size)


def boxes(nodes: DataFrame, features: int, levels: int) -> DataFrame:
    """The leaves of a node relation as boxes: tree, low and high (arrays by feature; a point is inside where low < value
    <= high), path. Parents meet their children level by level in joins on (tree, node)."""
    endless = [F.array(F.lit(sign * float("inf"))) for sign in (-1, 1)]
    at = nodes.filter("node = 0").select("tree", F.col("node").alias("_at"), *[
        F.array_repeat(edge[0], features).alias(name) for edge, name in zip(endless, ("low", "high"))])
    made = None
    for _ in range(levels + 1):
        here = at.join(nodes.withColumnRenamed("node", "_at"), ["tree", "_at"])
        ends = here.filter(F.col("left") == F.col("_at")).select("tree", "low", "high", "path")
        made = ends if made is None else made.unionByName(ends)
        inner = here.filter(F.col("left") != F.col("_at"))

        def put(edges: str, value: Column) -> Column:
            return F.transform(edges, lambda x, i: F.when(i == F.col("feature"), value).otherwise(x))

        sides = [inner.select("tree", F.col("left").alias("_at"), "low", put("high", F.col("cut")).alias("high")),
                 inner.select("tree", F.col("right").alias("_at"), put("low", F.col("cut")).alias("low"), "high")]
        at = sides[0].unionByName(sides[1])
    return made


def path_scores(points: np.ndarray, forest: dict, chunk: int = 256) -> np.ndarray:
    """2 ** (-mean path / expected path) for every row; higher is more anomalous.

    A chunk of rows goes down all trees at once, level by level; a leaf is its own child.
    """
    out = np.empty(len(points))
    for start in range(0, len(points), chunk):
        part = np.ascontiguousarray(points[start:start + chunk])
        row = np.arange(len(part), dtype=np.int32)[:, None] * np.int32(part.shape[1])
        at = np.broadcast_to(forest["roots"], (len(part), len(forest["roots"])))
        for _ in range(forest["levels"]):
            value = part.ravel().take(row + forest["feature"].take(at))
            at = forest["children"].take(2 * at + (value > forest["cut"].take(at)))
        out[start:start + chunk] = np.exp2(-forest["path"].take(at).mean(axis=1) / forest["scale"])
    return out


def score(rows: DataFrame, columns: list[str], forest: dict) -> Column:
    """Column of anomaly scores."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(*features: pd.Series) -> pd.Series:
        points = np.column_stack([f.to_numpy(dtype=float) for f in features])
        return pd.Series(path_scores(points, shared.value))

    return scored(*columns)
