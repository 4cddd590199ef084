"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a target size; target / size says how often each of its documents is taken on average. The whole part
is taken for sure, the fraction is an inclusion probability. Probabilities move along the null space of the balancing
constraints (words and documents of the source), a few units at a time, until each is 0 or 1, so the totals
stay what they were. Units are dealt to blocks of about `BLOCK` by a hash; a block leaves two undecided units at most,
which meet again in new blocks. In a source's last block a dozen units wait, and the best of all their roundings,
together with those of the two left by the flight, ends it (landing).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm.tables import SPACE_WORD, table
from pricelake.session import cut

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 4096
LANDED = 12     # units of each source that are decided together at the end, besides those that the flight leaves
NEAR = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_COPIES) -> DataFrame:
    """For each `source` of (source, size): source_size, n, rank by code point (null last) and target.

    Shares of the whole size by weight, none above `cap` times the source's size: sources are capped in the order in
    which a growing share reaches their cap. One row for each source meets in the windows, never one for each document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    limit = cap * F.col("source_size")
    by_limit = Window.orderBy(limit / F.col("weight"), "rank")
    earlier = F.coalesce(F.sum(limit).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    share = (F.sum("source_size").over(everything) - earlier) / rest
    per = per.withColumn("share", share).withColumn("capped", limit / F.col("weight") <= F.col("share"))
    # the first source below its cap fixes the share of all of them
    final = F.max(F.when(~F.col("capped"), F.col("share"))).over(everything)
    return per.select("source", "source_size", "n", "rank",
                      F.when(F.col("capped"), limit.cast("double")).otherwise(final * F.col("weight")).alias("target"))


def _step(p: list[float], u: list[float], coin: float) -> list[float]:
    """Move the probabilities along u, forwards or backwards, as far as all stay within 0 and 1; the mean move is 0."""
    forwards = min(((1 - x) / d if d > 0 else -x / d) for x, d in zip(p, u, strict=True) if d)
    backwards = min((x / d if d > 0 else (x - 1) / d) for x, d in zip(p, u, strict=True) if d)
    move = forwards if coin * (forwards + backwards) < backwards else -backwards
    moved = (x + move * d for x, d in zip(p, u, strict=True))
    return [0.0 if x < NEAR else 1.0 if x > 1 - NEAR else x for x in moved]


def flight(p: np.ndarray, size: np.ndarray, coins: np.ndarray) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but for two at most; their sum and that of size times p are as before.

    Three units at a time have one direction that keeps both totals: the cross product of (1, 1, 1) and their sizes.
    """
    p, active = p.astype(float).copy(), []
    waiting = iter(np.flatnonzero((p > NEAR) & (p < 1 - NEAR)))
    p[p <= NEAR], p[p >= 1 - NEAR] = 0.0, 1.0
    for coin in coins:
        while len(active) < 3 and (unit := next(waiting, None)) is not None:
            active.append(int(unit))
        if len(active) < 2:
            break
        s = [float(size[i]) for i in active]
        if len(active) == 2 and s[0] != s[1]:
            break
        if len(active) == 2 or s[0] == s[1] == s[2]:
            u = [1.0, -1.0, 0.0][:len(active)]
        else:
            u = [s[2] - s[1], s[0] - s[2], s[1] - s[0]]
        moved = _step([p[i] for i in active], u, coin)
        for i, x in zip(active, moved, strict=True):
            p[i] = x
        active = [i for i in active if 0.0 < p[i] < 1.0]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The undecided units, `LANDED` + 2 at most, rounded so that the sums of words and documents change least."""
    at = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
    choices = (np.arange(1 << len(at))[:, None] >> np.arange(len(at)) & 1) - p[at]
    words, documents = np.abs(choices @ size[at]), np.abs(choices.sum(1))
    best = np.argmin(words / max(size[at].mean(), 1) + documents / 8) if len(at) else 0
    p = p.copy()
    p[at] += choices[best]
    return np.round(p)


def _fly(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["_order", "_doc", "_copy"], kind="stable")
    name = f"{rows['_rank'].iloc[0]}/{rows['_round'].iloc[0]}/{rows['_block'].iloc[0]}"
    seed = int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big")
    size, p = rows["_size"].to_numpy(), rows["_p"].to_numpy()
    last = rows["_blocks"].iloc[0] == 1
    flying = len(p)
    if last:  # a few units stay on the ground, which leaves the landing something to choose from
        undecided = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
        flying = int(undecided[-LANDED]) if len(undecided) > LANDED else 0
    coins = np.random.default_rng(seed).random(2 * len(rows) + 4)
    p = np.concatenate([flight(p[:flying], size[:flying], coins), np.clip(p[flying:], 0, 1)])
    return rows.assign(_p=landing(p, size) if last else p)


def mix(docs: DataFrame, text: str = "text", doc: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_COPIES, block: int = BLOCK) -> DataFrame:
    """For each row of `docs`: doc_id, source, size (words), source_size, target (of its source) and copies to take.

    No document is taken more than `cap` times. Null and empty texts have size 0; a null source is a source of its own, the
    last; an empty table gives an empty mix. Repeated rows are told apart by a running number and count each. The result
    depends on the rows alone, not on their order or layout.
    """
    sized = docs.select(F.col(doc).alias("_doc"), F.col(source).alias("source"),
                        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE_WORD)).cast("long").alias("size"))
    counted = cut(sized.groupBy("_doc", "source", "size").agg(F.count("*").alias("_repeats")), "mix-sizes")
    units = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_repeats"))).drop("_repeats")
    per = cut(targets(units, weights, cap), "mix-targets")
    rate = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    joined = units.join(per, units["source"].eqNullSafe(per["source"])).select(
        "_doc", per["source"].alias("_source"), F.col("size").alias("_size"), "_copy", F.col("rank").alias("_rank"), "source_size",
        "target", F.floor(rate + NEAR).alias("_whole"), F.xxhash64("_doc", "size", "_copy").alias("_order"),
        F.greatest(rate - F.floor(rate + NEAR), F.lit(0.0)).alias("_p"),
        F.ceil(F.col("n") / block).cast("long").alias("_blocks"))
    state, decided, step = joined, None, 0
    while True:
        state = (state.withColumn("_round", F.lit(step))
                 .withColumn("_block", F.pmod(F.xxhash64("_order", "_round"), F.col("_blocks"))))
        moved = cut(state.groupBy("_rank", "_block").applyInPandas(_fly, state.schema), "mix-flight")
        undecided = (F.col("_p") > 0) & (F.col("_p") < 1)
        done = moved.filter(~undecided)
        decided = done if decided is None else decided.unionByName(done)
        left = moved.filter(undecided)
        counts = cut(left.groupBy("_rank").agg(F.ceil(F.count("*") / block).cast("long").alias("_blocks")), "mix-left")
        if counts.isEmpty():
            break
        state, step = left.drop("_blocks").join(counts, "_rank"), step + 1
    return decided.select(F.col("_doc").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"),
                          "source_size", "target", (F.col("_whole") + F.col("_p").cast("long")).alias("copies"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents; taken: words, repeats counted."""
    return taken(mix(table(spark, sf_dir, "documents")))


def taken(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
