"""Toxicity by a support vector machine on a gapped-subsequence string kernel with Nystroem landmarks.

The kernel of two words sums, over the byte triples they share as subsequences, decay factors for the gaps; a triple may
span `SPAN` bytes, so inserted characters and missing ones leave most of it. Words carry their borders, and runs of
one-letter words count as one word, so spelled-out words are met too. Kernel rows against `LANDMARKS` words, whitened
by the landmarks' own kernel, are the Nystroem features in which a linear machine is trained. Its decision is again a sum
over subsequences, so weights are collapsed into one table and a text is scored in one pass over its bytes.

Labels are of whole texts: a text is toxic if its worst word is. Training alternates between choosing each text's
worst word and fitting the machine to the chosen words. It reads a bounded sample: `SAMPLE` labelled texts of each class,
those with the smallest hashes of their ids. Everything else covers all rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import arrow_struct, fold, table

SAMPLE = 2_500
LANDMARKS = 384
SPAN = 5
DECAY = 0.75
BITS = 18
ROUNDS = 6
PENALTY = 100.0
PLAIN, TELLING = 5, 2.5   # texts and log odds from which a word is a toxic example by itself
LEANING = 1.5             # log odds that the worst word of a toxic text must have to become an example
HARD = 1_500              # words of clean texts that each round adds
THRESHOLD = 0.7

# letters and digits are kept, lower-cased; other ASCII is a border
WORD = np.ones(256, bool)
WORD[[b for b in range(128) if not chr(b).isalnum()]] = False
FOLDED = np.where(WORD, spans.LOWER, 0x20).astype(np.uint8)
_GAPS = [(j, k) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN)]


class Words:
    """The words of a block with a border on both sides, and all their triples."""

    def __init__(self, block: spans.Block):
        starts, ends, firsts = spans.words(block, ~WORD)
        rows = spans.rows_of(firsts)
        # a one-letter word continues a one-letter word before it if one byte is between them
        joins = np.zeros(len(starts), bool)
        single = ends - starts == 1
        joins[1:] = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1) & (rows[1:] == rows[:-1])
        self.starts = starts[~joins]
        self.ends = ends[np.append(~joins[1:], True)] if len(ends) else ends
        self.rows = rows[~joins]
        self.n_rows = len(block.offsets) - 1
        lengths = self.ends - self.starts + 2
        self.begins = np.concatenate([[0], np.cumsum(lengths)])
        owner = np.repeat(np.arange(len(lengths)), lengths)
        source = np.arange(self.begins[-1]) - self.begins[owner] + self.starts[owner] - 1
        inner = (source >= self.starts[owner]) & (source < self.ends[owner])
        data = FOLDED[block.data] if len(block.data) else np.zeros(1, np.uint8)
        self.data = np.where(inner, data[np.clip(source, 0, len(data) - 1)], 0x20).astype(np.uint32)
        self.owner = owner
        if joins.any():  # leave out what stands between joined letters
            stays = ~inner | (self.data != 0x20)
            self.data, self.owner = self.data[stays], owner[stays]
            self.begins = np.searchsorted(self.owner, np.arange(len(lengths) + 1))

    def triples(self):
        """For each pair of gaps: the places whose triple lies in one word, its bucket, and its weight."""
        n = len(self.data)
        for j, k in _GAPS:
            if n <= k:
                continue
            inside = self.owner[:n - k] == self.owner[k:]
            code = (self.data[:n - k] * np.uint32(0x9E3779B1)) ^ (self.data[j:n - k + j] * np.uint32(0x85EBCA6B) + np.uint32(77))
            code = (code ^ code >> np.uint32(15)) * np.uint32(0xC2B2AE35) + self.data[k:] * np.uint32(0x27D4EB2F)
            code = (code ^ code >> np.uint32(13)) * np.uint32(0x165667B1) >> np.uint32(32 - BITS)
            yield inside, code, DECAY ** (k - 2)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Weights summed over each word's triples, over the norm of its triples."""
        total, norm = np.zeros(len(self.data)), np.zeros(len(self.data))
        for inside, code, decay in self.triples():
            total[:len(code)] += np.where(inside, weights[code] * decay, 0.0)
            norm[:len(code)] += inside * decay ** 2
        if not len(self.starts):
            return np.zeros(0)
        first = self.begins[:-1]
        return np.add.reduceat(total, first) / np.sqrt(np.maximum(np.add.reduceat(norm, first), DECAY ** 6))

    def worst(self, scores: np.ndarray, least: float) -> np.ndarray:
        """The highest score of each row's words; `least` for rows without words."""
        top = np.full(self.n_rows, least)
        np.maximum.at(top, self.rows, scores)
        return top


class Landmarks:
    """Landmark words as normalised subsequence vectors over the buckets that occur in them, and the whitening that
    makes dot products of Nystroem features equal to the kernel between landmarks."""

    def __init__(self, words: list[bytes]):
        own = Words(_as_rows(words))
        rows, codes, values = [], [], []
        norm = np.zeros(len(words))
        for inside, code, decay in own.triples():
            at = np.flatnonzero(inside)
            rows.append(own.rows[own.owner[at]])
            codes.append(code[at].astype(np.int64))
            values.append(np.full(len(at), decay))
            norm += np.bincount(rows[-1], minlength=len(words)) * decay ** 2
        rows, codes, values = map(np.concatenate, (rows, codes, values))
        buckets, place = np.unique(codes, return_inverse=True)
        self.place = np.full(1 << BITS, len(buckets))
        self.place[buckets] = np.arange(len(buckets))
        self.vectors = np.zeros((len(buckets) + 1, len(words)))
        np.add.at(self.vectors, (place, rows), values / np.sqrt(np.maximum(norm, DECAY ** 6))[rows])
        kernel = self.vectors.T @ self.vectors
        level, turn = np.linalg.eigh(kernel)
        some = level > 1e-6 * level.max()
        self.whiten = turn[:, some] / np.sqrt(level[some])

    def features(self, words: list[bytes]) -> np.ndarray:
        """Nystroem features: kernel against each landmark, whitened."""
        return np.vstack([self._features(words[at:at + 500]) for at in range(0, len(words), 500)])

    def _features(self, words: list[bytes]) -> np.ndarray:
        own = Words(_as_rows(words))
        kernel, norm = np.zeros((len(words), self.vectors.shape[1])), np.zeros(len(words))
        for inside, code, decay in own.triples():
            at = np.flatnonzero(inside)
            rows = own.rows[own.owner[at]]
            norm += np.bincount(rows, minlength=len(words)) * decay ** 2
            begins = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else rows
            if len(rows):
                kernel[rows[begins]] += decay * np.add.reduceat(self.vectors[self.place[code[at]]], begins, axis=0)
        return kernel / np.sqrt(np.maximum(norm, DECAY ** 6))[:, None] @ self.whiten

    def table(self, w: np.ndarray) -> np.ndarray:
        """The machine's weights per subsequence bucket: its decision is their sum over a word's triples."""
        collapsed = np.zeros(1 << BITS)
        seen = self.place < len(self.vectors) - 1
        collapsed[seen] = (self.vectors @ (self.whiten @ w))[self.place[seen]]
        return collapsed


def _as_rows(words: list[bytes]) -> spans.Block:
    return spans.Block(0, len(words), np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss by Newton steps; both classes weigh the same."""
    share = weight * PENALTY / np.where(y > 0, weight[y > 0].sum(), weight[y < 0].sum())
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) / 100
    for _ in range(30):
        active = y * (x @ w) < 1
        weighted = x[active] * share[active, None]
        fresh = np.linalg.solve(ridge + x[active].T @ weighted, weighted.T @ y[active])
        if np.abs(fresh - w).max() < 1e-6:
            break
        w = fresh
    return w[:-1], float(w[-1])


def calibrated(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margins to probabilities, towards softened labels."""
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    goal = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ ((p * (1 - p))[:, None] * x) + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(slope, x.T @ (p - goal) + 1e-3 * w)
    return float(w[0]), float(w[1])


NO_WORDS = -2.0


def inserted(word: bytes) -> list[bytes]:
    """Two misspellings of a toxic word, which teach the machine that a letter may come between."""
    text = word.decode(errors="ignore")
    at = sorted({len(text) // 2, max(len(text) - 1, 1)})
    return [f"{text[:k]}{'xh'[k % 2]}{text[k:]}".encode() for k in at if 3 < len(text) <= 24]


def _fitted(weights: np.ndarray, bias: float, slope: float, shift: float) -> pd.DataFrame:
    return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias], "slope": [slope], "shift": [shift]})


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["_order", "_toxic", "_text"], kind="stable").reset_index(drop=True)
    toxic = rows["_toxic"].to_numpy() > 0
    spelled: dict[int, bytes] = {}
    pairs = [np.zeros((0, 2), np.uint64)]
    for block in spans.blocks(pa.array(rows["_text"], pa.string())):
        own = Words(block)
        names = spans.hashes(block.data, own.starts, own.ends, FOLDED)
        _, firsts = np.unique(names, return_index=True)
        for i in firsts:
            spelled.setdefault(int(names[i]), FOLDED[block.data[own.starts[i]:own.ends[i]]].tobytes())
        pairs.append(np.unique(np.stack([names, (own.rows + block.first).astype(np.uint64)], 1), axis=0))
    nothing = _fitted(np.zeros(1 << BITS), 0.0, 0.0, 0.0)
    if not spelled or toxic.all() or not toxic.any():
        return nothing
    # words by number, and which text has which
    pairs = np.concatenate(pairs)
    names, word = np.unique(pairs[:, 0], return_inverse=True)
    text = pairs[:, 1].astype(np.int64)
    spelling = [spelled[int(n)] for n in names]
    everything = Words(_as_rows(spelling))
    with_toxic = np.bincount(word, toxic[text])
    without = np.bincount(word) - with_toxic
    odds = np.log((with_toxic + 0.5) / (toxic.sum() + 1)) - np.log((without + 0.5) / ((~toxic).sum() + 1))
    telling = np.argsort(-with_toxic * np.maximum(odds, 0), kind="stable")[:LANDMARKS // 2]
    common = np.argsort(-without, kind="stable")
    common = common[~np.isin(common, telling)][:LANDMARKS - len(telling)]
    marks = Landmarks([spelling[i] for i in np.concatenate([telling, common])])

    bad, clean = np.zeros(len(names), bool), np.flatnonzero(without > 0)
    good = (with_toxic >= PLAIN) & (odds > TELLING)     # examples from the start
    score = with_toxic * odds
    weights, bias = None, 0.0
    for _ in range(ROUNDS):
        # a toxic text without an example yet gives its worst word
        explained = np.zeros(len(toxic), bool)
        explained[text[good[word]]] = True
        order = np.lexsort((word, score[word], text))
        last = order[np.append(text[order][1:] != text[order][:-1], True)]
        worst = last[toxic[text[last]] & ~explained[text[last]]]
        good[word[worst][odds[word[worst]] > LEANING]] = True
        # the words of clean texts that come closest to toxic ones
        hard = clean[~good[clean]]
        hard = hard[np.argsort(-score[hard], kind="stable")[:HARD]]
        bad[hard if weights is None else hard[score[hard] > -1]] = True
        if not good.any() or not bad.any():
            return nothing
        examples = [spelling[i] for i in np.flatnonzero(good)]
        examples += [made for one in examples for made in inserted(one)]
        others = [spelling[i] for i in np.flatnonzero(bad & ~good)]
        labels = np.repeat([1.0, -1.0], [len(examples), len(others)])
        weight = np.ones(len(labels))
        weight[:good.sum()] = with_toxic[good]
        w, bias = machine(marks.features(examples + others), labels, weight)
        weights = marks.table(w)
        score = everything.scores(weights) + bias
    margin = np.full(len(toxic), NO_WORDS)
    np.maximum.at(margin, text, score[word])
    return _fitted(weights, bias, *calibrated(margin, toxic))


def fit(labelled: DataFrame, docs: DataFrame, label: str = "toxic", sample: int = SAMPLE):
    """The trained machine from `labelled` (doc_id and a 0/1 label) and the texts of `docs`, or None without both classes.

    Rows with a null id or label are left out; of an id labelled twice both labels count.
    """
    known = (labelled.select("doc_id", (F.col(label) > 0).cast("int").alias("_toxic"), F.xxhash64("doc_id").alias("_order"))
             .filter("doc_id is not null and _toxic is not null"))
    ones, zeros = (known.filter(F.col("_toxic") == k).orderBy("_order", "doc_id").limit(sample) for k in (1, 0))
    chosen = ones.union(zeros)
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
             .join(F.broadcast(chosen), "doc_id").select("_order", "_toxic", "_text"))
    rows = texts.orderBy("_order", "_toxic", "_text").limit(2 * sample)
    fitted = rows.groupBy().applyInPandas(_train, "weights binary, bias double, slope double, shift double").collect()
    return fitted[0] if fitted and fitted[0].slope else None


def scorer(spark: SparkSession, fitted):
    """A function from a text column to its score between 0 and 1; null and texts without words get the lowest margin.

    Without a trained machine every score is 0.
    """
    if fitted is None:
        return lambda text: F.lit(0.0)
    shared = spark.sparkContext.broadcast((np.frombuffer(fitted.weights, np.float32), fitted.bias, fitted.slope, fitted.shift))

    def work(values: pa.Array) -> dict[str, pa.Array]:
        weights, bias, slope, shift = shared.value
        scores = np.empty(len(values))
        for block in spans.blocks(values, 1 << 19):
            own = Words(block)
            margin = own.worst(own.scores(weights) + bias, NO_WORDS)
            scores[block.first:block.last] = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -40, 40)))
        return {"score": pa.array(scores)}

    return lambda text: arrow_struct(text, "score double", work)["score"]


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned outside the held-out fold (crc32 of the id modulo 3 is 1)."""
    docs = table(spark, sf_dir, "documents")
    score = scorer(spark, fit(table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 3) != 1), docs))
    return docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
