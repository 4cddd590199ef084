"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is cut into runs of letters and digits and runs of other signs, so punctuation is a word of its own. Single
words and pairs of neighbours are hashed to 2^18 weights; a feature's value is its share of the text's n-grams. The
score is the logistic function of a sparse dot product.

Training is proximal FTRL, one example after another, over a bounded sample of labelled texts inside one task:
`SAMPLE` documents (those with the smallest hashes of their ids) and `EPOCHS` passes. Everything else covers all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import arrow_struct, fold, table

BITS = 18
SAMPLE = 8_000      # labelled documents that the fit reads at most
EPOCHS = 3
SCALE = 16.0        # feature value of a text that repeats one n-gram only
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
THRESHOLD = 0.7
REPEATED = np.uint64(0xA5A5A5A5A5A5A5A5)

KINDS = np.full(256, 1, np.uint8)               # letters, digits and bytes of other scripts
KINDS[[b for b in range(128) if not chr(b).isalnum()]] = 2
KINDS[spans.SPACES] = 0


def features(block: spans.Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and of every pair of words, and the row of each; a word and itself are one pair for all words."""
    starts, ends, firsts = spans.runs(KINDS[block.data], block.offsets)
    single = spans.hashes(block.data, starts, ends, spans.LOWER)
    pairs, pair_rows = spans.ngrams(single, firsts, 2)
    rows = spans.rows_of(firsts)
    pairs[(single[1:] == single[:-1])[rows[1:] == rows[:-1]]] = REPEATED
    buckets = np.concatenate([spans.mixed(single), pairs]) >> np.uint64(64 - BITS)
    return buckets.astype(np.int32), np.concatenate([rows, pair_rows])


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Weights and bias after `EPOCHS` passes of proximal FTRL with per-coordinate rates, in the order given."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for at, values, label in examples:
            w = weights(at)
            gradient = (logistic(np.dot(w, values)) - label) * values
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    final = weights(np.arange(size))
    return final[:-1], float(final[-1])


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["_order", "_label", "_text"], kind="stable")
    examples = []
    for block in spans.blocks(pa.array(rows["_text"], pa.string())):
        buckets, owner = features(block)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(block.last - block.first + 1))
        for row in range(block.last - block.first):
            at, counts = np.unique(buckets[order[bounds[row]:bounds[row + 1]]], return_counts=True)
            values = np.append(counts * (SCALE / max(counts.sum(), 1)), 1.0)
            examples.append((np.append(at, 1 << BITS), values, float(rows["_label"].iloc[block.first + row])))
    weights, bias = follow_leader(examples)
    examples.clear()
    spans.release()
    return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias]})


def fit(labelled: DataFrame, docs: DataFrame, label: str, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights and bias from `labelled` (doc_id and a 0/1 label) and the texts of `docs`.

    Rows with a null id or label are left out; of an id labelled twice both labels count. Without any labelled text
    all weights are 0, so every score is one half.
    """
    order = F.xxhash64("doc_id")
    chosen = (labelled.select("doc_id", F.col(label).cast("double").alias("_label"), order.alias("_order"))
              .filter("doc_id is not null and _label is not null").orderBy("_order", "doc_id", "_label").limit(sample))
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
             .join(F.broadcast(chosen), "doc_id").select("_order", "_label", "_text"))
    # the sample bounds the labels; ids that occur in several rows could bring more texts
    rows = texts.orderBy("_order", "_label", "_text").limit(sample)
    fitted = rows.groupBy().applyInPandas(_train, "weights binary, bias double").collect()
    if not fitted:
        return np.zeros(1 << BITS, np.float32), 0.0
    return np.frombuffer(fitted[0].weights, np.float32), fitted[0].bias


def scorer(spark: SparkSession, weights: np.ndarray, bias: float):
    """A function from a text column to its score between 0 and 1; null or empty texts score by the bias alone."""
    shared = spark.sparkContext.broadcast((weights, bias))   # 2^18 floats

    def work(values: pa.Array) -> dict[str, pa.Array]:
        table_, bias_ = shared.value
        scores = np.empty(len(values))
        for block in spans.blocks(values):
            buckets, owner = features(block)
            rows = block.last - block.first
            total = np.bincount(owner, table_[buckets].astype(np.float64), rows)
            count = np.maximum(np.bincount(owner, minlength=rows), 1)
            scores[block.first:block.last] = logistic(total / count * SCALE + bias_)
        return {"score": pa.array(scores)}

    return lambda text: arrow_struct(text, "score double", work)["score"]


def trained_scorer(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """Learn quality from labels outside the held-out fold (crc32 of the id modulo 4 is 2)."""
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 4) != 2)
    return scorer(spark, *fit(labels, docs, "quality"))


def keep_good(docs: DataFrame, score: Column, least: float) -> DataFrame:
    """Rows whose score is at least `least`, with the columns they came with."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.filter(score >= least).select(*columns)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every whole text; see the module for how it is learned."""
    docs = table(spark, sf_dir, "documents")
    score = trained_scorer(spark, sf_dir, docs)
    return docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
