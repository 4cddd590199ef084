"""Language identification by the nearest of several centroids per language.

A text is lower-cased, everything but letters becomes a blank, and its byte pairs and triples are hashed to
`FEATURES` counts. Vectors are log counts times inverse document frequency, normalised. Document frequencies cover all
learning rows. Centroids come from spherical k-means over a bounded sample of each language (`SAMPLE` documents, those with
the smallest hashes of their ids), with the similarity below which a text is too far away to be trusted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import arrow_struct, fold, table
from pricelake.session import cut

FEATURES = 4096
SAMPLE = 400        # documents of each language that its centroids are made from
CENTROIDS = 4
ROUNDS = 15
SHARPNESS = 20.0    # of the score, a softmax over the languages' best similarities
TRUSTED = 0.001     # share of a language's sample that would be rejected
BLOCK = 256 << 10   # bytes of text whose count vectors are in memory at once

_LETTERS = spans.LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20
_ASCII_LETTER = np.zeros(256, np.int64)
_ASCII_LETTER[[b for b in range(128) if chr(b).isalpha()]] = 1


def counts(block: spans.Block) -> np.ndarray:
    """Rows times FEATURES: how often each hashed pair or triple occurs; blanks alone count nothing."""
    rows = len(block.offsets) - 1
    letters = _LETTERS[block.data].astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(block.offsets))
    total = np.zeros(rows * FEATURES)
    for n in (2, 3):
        if len(letters) < n:
            break
        code = letters[:len(letters) - n + 1].copy()
        for k in range(1, n):
            code = code * np.uint32(257) + letters[k:len(letters) - n + 1 + k]
        code = (code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519) >> np.uint32(20)
        valid = (row[:len(row) - n + 1] == row[n - 1:]) & ((letters[:len(code)] != 32) | (letters[1:len(code) + 1] != 32))
        total += np.bincount((row[:len(code)] * FEATURES + code)[valid], minlength=rows * FEATURES)
    return total.reshape(rows, FEATURES)


def vectors(block: spans.Block, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts(block)) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for block in spans.blocks(batch.column(0), BLOCK):
            found += (counts(block) > 0).sum(0)
    if rows:
        yield pa.RecordBatch.from_pydict({"feature": pa.array(np.arange(FEATURES + 1), pa.int32()),
                                          "docs": pa.array(np.append(found, rows))})


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of each feature over all rows of a one-column frame."""
    stored = texts.mapInArrow(_frequencies, "feature int, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))
    found = np.zeros(FEATURES + 1)
    for row in stored.collect():
        found[row.feature] = row.docs
    return np.log((1 + found[-1]) / (1 + found[:-1])) + 1


def spherical_kmeans(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; starts from the mean and the points farthest from the centroids before them."""
    def unit(v):
        return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)

    centroids = unit(x.mean(0, keepdims=True))
    while len(centroids) < min(k, len(x)):
        centroids = np.vstack([centroids, x[np.argmin((x @ centroids.T).max(1))]])
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(1)
        fresh = np.array([x[nearest == j].sum(0) if (nearest == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = unit(fresh)
    return centroids


class Languages:
    """Learned names, centroids (all languages stacked), the language of each, least trusted similarity, commonest."""

    def __init__(self, idf: np.ndarray, learned: list):
        learned = sorted(learned, key=lambda row: row.lang)
        self.idf = idf
        self.names = [row.lang for row in learned]
        found = [np.frombuffer(row.centroids, np.float32).reshape(-1, FEATURES) for row in learned]
        self.centroids = np.vstack(found).astype(float) if found else np.zeros((0, FEATURES))
        self.begins = np.cumsum([0, *map(len, found)])[:-1]
        self.least = np.array([row.least for row in learned])
        self.commonest = int(np.argmax([row.n for row in learned])) if learned else -1


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc: str = "doc_id") -> Languages:
    """Learn from all rows of `docs` with a language; `SAMPLE` rows of each make its centroids."""
    rows = docs.filter(F.col(lang).isNotNull()).select(
        F.col(doc).alias("_doc"), F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("_text"))
    idf = document_frequencies(rows.select("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    order = Window.partitionBy("lang").orderBy("_order", "_doc")
    names = rows.select("lang", "_doc", F.xxhash64("_doc").alias("_order"))
    sample = cut(names.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= SAMPLE)
                 .select("_doc", "lang", "_order").distinct(), "language-sample")
    n = names.groupBy("lang").agg(F.count("*").alias("n"))

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "_text"], kind="stable")
        x = np.vstack([vectors(b, shared.value) for b in spans.blocks(pa.array(group["_text"], pa.string()), BLOCK)])
        found = spherical_kmeans(x)
        least = float(np.quantile((x @ found.T).max(1), TRUSTED))
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "least": [least], "centroids": [found.astype(np.float32).tobytes()]})

    texts = rows.join(sample, ["_doc", "lang"]).dropDuplicates(["_doc", "lang"]).select("lang", "_order", "_text")
    made = texts.groupBy("lang").applyInPandas(centroids, "lang string, least double, centroids binary")
    return Languages(idf, made.join(n, "lang").collect())


def identifier(spark: SparkSession, learned: Languages):
    """A function from a text column to a struct: nearest (the language of the nearest centroid; `und` for null or
    texts without a letter, or if nothing was learned), score, and lang: the same, or `und` if it is too far away.

    Texts too short for a pair of letters get the commonest language and the score of no evidence.
    """
    shared = spark.sparkContext.broadcast(learned)

    def work(values: pa.Array) -> dict[str, pa.Array]:
        known, nearest, lang, score = shared.value, [], [], []
        for block in spans.blocks(values, BLOCK):
            ascii_letters = spans.row_sums(_ASCII_LETTER[block.data], block.offsets)
            similar = vectors(block, known.idf) @ known.centroids.T
            for row in range(block.last - block.first):
                value = values[block.first + row]
                if not known.names or not (ascii_letters[row] or any(c.isalpha() for c in value.as_py() or "")):
                    nearest.append("und")
                    lang.append("und")
                    score.append(0.0)
                    continue
                best = np.maximum.reduceat(similar[row], known.begins)
                found = int(best.argmax()) if best.max() > 0 else known.commonest
                nearest.append(known.names[found])
                lang.append(known.names[found] if best[found] >= known.least[found] else "und")
                shares = np.exp(SHARPNESS * (best - best.max()))
                score.append(float(shares[found] / shares.sum()))
        return {"nearest": pa.array(nearest, pa.string()), "score": pa.array(score, pa.float64()),
                "lang": pa.array(lang, pa.string())}

    return lambda text: arrow_struct(text, "nearest string, score double, lang string", work)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned outside the held-out fold (crc32 of the id modulo 5 is 0).

    lang_pred is the nearest learned language; `trusted` is false where its distance rejects it.
    """
    docs = table(spark, sf_dir, "documents")
    identify = identifier(spark, fit(docs.filter(fold(F.col("doc_id"), 5) != 0)))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, identify(F.col("text")).alias("found")).select(
        "doc_id", "held_out", F.col("found.nearest").alias("lang_pred"), "found.score",
        (F.col("found.lang") != "und").alias("trusted"))
