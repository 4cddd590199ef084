"""Language-model scoring by online logistic mixing of bit predictors.

Each word is a path of bits. The commonest words and the end of a text share one prefix code, made from their counts; a
further leaf announces a word spelled byte by byte, whose bytes have a prefix code of their own. Every bit has several
predictions: how often it was set at this node of the code in the training texts, and how often after the same
preceding word, after the same word before that, or, when spelling, after the same two and three bytes (hashed to slots of
fixed tables). A gate, chosen by part of the code and by how much the contexts have been seen, picks weights; the weighted
sum of the predictions' logits is the bit's mixed logit, which a table of what such logits turned out to be refines. Each text
starts from learned weights and refinements and moves them along the gradient after `EARLY` words and then after every
`STRIDE`, so a bit is always predicted from what came before it.

Counts cover all training texts: word counts exactly, in a shuffled table with one row for each distinct word, context
counts as tables of fixed size that every task fills and that are added up slot by slot. Only words with enough counts to
be among the `HOT_WORDS` commonest are sent to the tasks; the others' counts are joined. Every training bit also goes into a table
of the three logits that the task's counts of earlier blocks give it; the weights and refinements are fitted to the sum of these tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import arrow_struct, in_fold, table
from pricelake.session import cut

HOT_WORDS = 1 << 18
LEAST_COUNT = 2         # rarer words are spelled, which teaches the code how often new words come
WORD_SLOTS, BYTE_SLOTS = 1 << 21, 1 << 20   # of context counts; both contexts of a kind share a table
DEEPEST = 11            # deeper bits of the word code are predicted by their node alone
STRIDE, EARLY = 96, (8, 32)    # words between two changes of the weights, which move after so many words of a text too
RATE, REFINING_RATE = 0.04, 0.05
FIRST_BLOCK, BLOCK = 8 << 10, 256 << 10
FAN_IN = 64             # context tables that one task adds up at a time
CHUNK = 1 << 12         # slots of a stored piece of a context table
SMOOTHING = 0.1         # of the base model
# weight of a context's logit by how often it was seen: never, under 3, under 12, under 100 times, more; where learning begins
TRUST = (0.0, 0.25, 0.5, 0.65, 0.75)
CLASSES = len(TRUST)
GATES = 2 * CLASSES ** 2                    # of words, then of spelled bytes
LEVELS, LEVEL = 17, 0.9                     # of a logit in the table that gates are learned from: values a LEVEL apart, 0 in the middle
CELLS = GATES * LEVELS ** 3                 # of that table
KNOTS, KNOT = 33, 0.75                      # of a refined logit
CERTAIN = 11.9                              # logits beyond are cut; within the knots
PRIOR = 20.0                                # seen bits that a knot's or a weight's starting value counts as

END = np.uint64(0x0123456789ABCDEF)         # hash of the end of a text
BACK = (2, 4)                               # bytes before a spelled one that make its contexts
_MARK = 0                                   # the byte that ends a spelled word


@dataclass
class Code:
    """A prefix code: for leaf i, entries first[i] to first[i + 1] of bit, node and logit, from the root on, as far as
    `deepest`; rest[i] is the log10 probability of its deeper bits."""

    first: np.ndarray
    bit: np.ndarray
    node: np.ndarray
    logit: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, deepest: int) -> Code:
        """Lengths are rounded-up bits of information; leaves are numbered by length, then place."""
        counts = np.maximum(counts.astype(float), 0.5)
        length = np.maximum(np.ceil(-np.log2(counts / counts.sum())).astype(np.int64), 1)
        order = np.argsort(length, kind="stable")
        # the next code is the one after the last, with zeros up to its length
        scaled = np.cumsum(np.ldexp(1.0, -length[order])) - np.ldexp(1.0, -length[order])
        code = np.empty(len(counts), np.int64)
        code[order] = np.ldexp(scaled, length[order]).astype(np.int64)
        kept = np.minimum(length, deepest)
        first = np.concatenate([[0], np.cumsum(kept)])
        leaf = np.repeat(np.arange(len(counts)), kept)
        depth = np.arange(first[-1]) - first[leaf]
        left = length[leaf] - depth
        node = (np.int64(1) << depth) | (code[leaf] >> left)
        bit = code[leaf] >> (left - 1) & 1
        names, at = np.unique(node, return_inverse=True)
        ones = np.bincount(at, counts[leaf] * bit, len(names))
        zeros = np.bincount(at, counts[leaf] * (1 - bit), len(names))
        logit = np.log((ones + 0.05) / (zeros + 0.05))
        # what the last kept bit leads to is shared out by counts
        prefix = (np.int64(1) << kept) | (code >> (length - kept))
        ends, end = np.unique(prefix, return_inverse=True)
        rest = np.log10(counts / np.bincount(end, counts, len(ends))[end])
        return Code(first.astype(np.int32), bit.astype(np.uint8), node.astype(np.uint32), logit[at].astype(np.float32), rest)

    def __post_init__(self):
        self.spread = self.node * np.uint32(0x9E3779B1)     # for hashes of node and context
        self.level = _levels(self.logit)

    def entries(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For a sequence of leaves: the entries of their paths, and how many each has."""
        begin = self.first[leaves]
        lengths = self.first[leaves + 1] - begin
        upto = np.cumsum(lengths)
        shift = (begin - (upto - lengths)).astype(np.int64)
        return np.arange(upto[-1] if len(upto) else 0) + np.repeat(shift, lengths), lengths


@dataclass
class Gates:
    """For each gate, of words and then of spelled bytes: the weights of the three logits that a text starts with, and the
    refined logit at every place of `_knots`."""

    weights: np.ndarray
    refined: np.ndarray


@dataclass
class Model:
    """hashes of hot words in order with their counts, the codes, and what the base model needs."""

    hot: np.ndarray
    counts: np.ndarray
    words: Code                 # leaf len(hot): a spelled word
    letters: Code               # leaf: byte
    total: int
    distinct: int
    slots: np.ndarray | None = None         # of words, then of bytes; see `trusted`
    gates: Gates | None = None

    def __post_init__(self):
        # hashes are even, so those with the same first bits are few
        shift = np.uint64(64 - max(len(self.hot) * 2, 2).bit_length())
        self.shift, self.begins = shift, np.searchsorted(self.hot >> shift, np.arange((1 << 64 - int(shift)), dtype=np.uint64))

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the hot ones, or of another if it is not one of them."""
        last = len(self.hot) - 1
        at = np.minimum(self.begins[(hashes >> self.shift).astype(np.intp)], last)
        left = np.flatnonzero(self.hot[at] < hashes)
        while len(left):
            left = left[at[left] < last]
            at[left] += 1
            left = left[self.hot[at[left]] < hashes[left]]
        return at

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))


class Tokens:
    """The words of a block and the end of each row, as one sequence."""

    def __init__(self, block: spans.Block):
        starts, ends, firsts = spans.words(block)
        rows = len(block.offsets) - 1
        self.first = firsts + np.arange(rows + 1)
        self.row = spans.rows_of(self.first)
        at_end = np.zeros(self.first[-1], bool)
        at_end[self.first[1:] - 1] = True
        self.hash = np.full(len(at_end), END)
        self.hash[~at_end] = spans.hashes(block.data, starts, ends, spans.LOWER)
        self.start, self.stop = np.zeros(len(at_end), np.int64), np.zeros(len(at_end), np.int64)
        self.start[~at_end], self.stop[~at_end] = starts, ends
        self.data = spans.LOWER[block.data]

    def before(self, distance: int) -> np.ndarray:
        """The hash of the word so many places before, 0 across a row's beginning."""
        found = np.zeros(len(self.hash), np.uint64)
        found[distance:] = self.hash[:-distance] if distance < len(self.hash) + 1 else 0
        for place in range(distance):
            begins = self.first[:-1] + place
            found[begins[begins < self.first[1:]]] = 0
        return found


def _slots(context: np.ndarray, lengths: np.ndarray, node: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each bit, whose owners have contexts and numbers of bits."""
    x = np.repeat(context, lengths)
    x ^= node
    x *= np.uint32(0x85EBCA6B)
    x >>= np.uint32(33 - slots.bit_length())
    return x.astype(np.intp)


class Bits:
    """All bits of a block's texts, words first and spelled bytes after them, with the two context slots of each. Either are in the
    order of steps, between which the weights move: bounds[0] and bounds[1] are where the steps of either begin."""

    def __init__(self, tokens: Tokens, model: Model):
        at = model.place(tokens.hash)
        self.known = model.hot[at] == tokens.hash
        self.leaf = np.where(self.known, at, len(model.hot))
        place = np.arange(len(tokens.hash)) - tokens.first[tokens.row]
        step = place // STRIDE + sum(place >= words for words in EARLY)
        steps = int(step.max()) + 1 if len(step) else 1
        order = np.argsort(step.astype(np.uint16) if steps < 1 << 16 else step, kind="stable")
        entry, lengths = model.words.entries(self.leaf[order])
        node = model.words.spread[entry]
        bit, logit = [model.words.bit[entry]], [model.words.logit[entry]]
        token, row = [np.repeat(order.astype(np.int32), lengths)], [np.repeat(tokens.row[order], lengths)]
        slots = [[_slots(self._context(tokens.before(k), k)[order], lengths, node, WORD_SLOTS)] for k in (1, 2)]
        self.n_words, self.entries = len(entry), [entry]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        self.bounds = [upto[np.searchsorted(step[order], np.arange(steps + 1))]]
        # spelled words: their bytes and a mark, in the context of the bytes before
        spelled = order[~self.known[order]]
        lengths = tokens.stop[spelled] - tokens.start[spelled] + 1
        word = np.repeat(np.arange(len(spelled)), lengths)
        place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        source = tokens.start[spelled][word] + place
        inner = place < lengths[word] - 1
        data = tokens.data if len(tokens.data) else np.zeros(1, np.uint8)
        byte = np.where(inner, data[np.minimum(source, len(data) - 1)], _MARK)
        history, contexts = np.zeros(len(byte), np.uint64), {}
        for back in range(1, max(BACK) + 1):
            past = np.zeros(len(byte), np.uint64)
            past[back:] = byte[:-back] if back <= len(byte) else 0
            history = history << np.uint64(8) | np.where(place >= back, past, 0).astype(np.uint64)
            contexts[back] = history
        entry, lengths = model.letters.entries(byte.astype(np.int64))
        self.entries.append(entry)
        node = model.letters.spread[entry]
        for own, back in zip(slots, BACK, strict=True):
            own.append(_slots(self._context(contexts[back], 2 + back), lengths, node, BYTE_SLOTS) + WORD_SLOTS)
        self.slots = [np.concatenate(own) for own in slots]
        self.bit = np.concatenate([*bit, model.letters.bit[entry]])
        self.logit = np.concatenate([*logit, model.letters.logit[entry]])
        self.token = np.concatenate([*token, np.repeat(spelled.astype(np.int32)[word], lengths)])
        self.row = np.concatenate([*row, np.repeat(tokens.row[spelled[word]], lengths)])
        upto = np.concatenate([[0], np.cumsum(lengths)])
        begins = np.searchsorted(step[spelled][word], np.arange(steps + 1)) if len(word) else np.zeros(steps + 1, np.int64)
        self.bounds.append(self.n_words + upto[begins])

    @staticmethod
    def _context(values: np.ndarray, salt: int) -> np.ndarray:
        return (spans.mixed(values + np.uint64(salt)) >> np.uint64(32)).astype(np.uint32)


def trusted(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A slot's logit in 256ths, shrunk while it was seen seldom, times 8, plus its class of `TRUST`."""
    seen = zeros + ones
    logit = np.log((ones + 0.3) / (zeros + 0.3)) * seen / (seen + 0.5)
    kind = (seen > 0).astype(np.int32) + (seen >= 3) + (seen >= 12) + (seen >= 100)
    return (np.round(np.clip(logit, -15, 15) * 256).astype(np.int32) * 8 + kind).astype(np.int16)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, n): words by hash; bytes as 0 to 255 of kind 1; kind 2: texts."""
    hashes, counts, held, rows = [], [], 0, 0
    letters = np.zeros(256, np.int64)

    def combined() -> tuple[np.ndarray, np.ndarray]:
        names, at = np.unique(np.concatenate(hashes), return_inverse=True)
        return names, np.bincount(at, np.concatenate(counts)).astype(np.int64)

    for batch in batches:
        for block in spans.blocks(batch.column(0)):
            tokens = Tokens(block)
            names, n = np.unique(tokens.hash, return_counts=True)
            hashes.append(names)
            counts.append(n)
            letters += np.bincount(tokens.data, minlength=256)
            rows += block.last - block.first
            held += len(names)
            if held > 2_000_000:
                names, n = combined()
                hashes, counts, held = [names], [n], 0
    if rows:
        names, n = combined()
        for at in range(0, len(names), 100_000):
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(names[at:at + 100_000]), np.int32)),
                                              "h": pa.array(names[at:at + 100_000].view(np.int64)), "n": pa.array(n[at:at + 100_000])})
        yield pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(256, np.int32)), "h": pa.array(np.arange(256)), "n": pa.array(letters)})
    hashes.clear()
    counts.clear()
    spans.release()


def _narrow(counts: np.ndarray) -> bytes:
    """In the narrowest whole numbers that hold them."""
    most = counts.max()
    return counts.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint64).tobytes()


def _whole(stored: bytes) -> np.ndarray:
    kind = {2 * CHUNK: np.uint8, 4 * CHUNK: np.uint16, 16 * CHUNK: np.uint64}[len(stored)]
    return np.frombuffer(stored, kind).astype(np.uint64)


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(2 * CHUNK, np.uint64)
    for stored in rows["counts"]:
        total += _whole(stored)
    return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "counts": [_narrow(total)]})


def _fill(counts: np.ndarray, bits: Bits) -> None:
    """Add a block's bits to the counts of their contexts: of each slot the zeros, then the ones."""
    for slots in bits.slots:
        np.add.at(counts, slots * 2 + bits.bit, np.uint32(1))


def _levels(logit: np.ndarray) -> np.ndarray:
    middle = LEVELS // 2
    return (np.clip(np.rint(logit * (1 / LEVEL)), -middle, middle) + middle).astype(np.uint8)


def _states(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Class and level of slots' logits in one number."""
    packed = trusted(zeros.astype(np.float32), ones.astype(np.float32))
    return ((packed & 7) * LEVELS + _levels((packed >> 3) * np.float32(1 / 256))).astype(np.uint8)


def _growing(batches: Iterator[pa.RecordBatch]) -> Iterator[spans.Block]:
    """Blocks that are as large as all before them, between `FIRST_BLOCK` and `BLOCK`."""
    seen = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            block = next(spans.blocks(batch.column(0).slice(at), min(max(seen, FIRST_BLOCK), BLOCK)))
            yield block
            at += block.last
            seen += len(block.data)


def _watch(table: np.ndarray, states: np.ndarray, bits: Bits, model: Model) -> None:
    """Add a block's bits to the table of gates: how often a bit was set, by class and level of its contexts' logits and level
    of its node's, where `states` come from the counts of earlier blocks."""
    cell = states.take(bits.slots[0]).astype(np.intp)
    cell *= CLASSES * LEVELS
    cell += states.take(bits.slots[1])
    cell[bits.n_words:] += (CLASSES * LEVELS) ** 2
    cell *= LEVELS
    cell += np.concatenate([code.level[entry] for code, entry in zip((model.words, model.letters), bits.entries, strict=True)])
    cell *= 2
    cell += bits.bit
    table += np.bincount(cell, minlength=len(table)).astype(np.uint32)


def start_weights() -> np.ndarray:
    """Weights of the three logits by gate, before anything is learned."""
    trust = np.array(TRUST)
    first, second = np.repeat(trust, CLASSES), np.tile(trust, CLASSES)
    start = np.stack([np.maximum(1 - first - second, 0.1), first * (1 - second / 3), second * (1 - first / 3)], 1)
    start[0, 0] = 1.0
    return np.tile(start, (2, 1))


def _knots(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The knot below each logit, and how far it lies towards the next."""
    place = (logit * (1 / KNOT) + KNOTS // 2).astype(np.float32, copy=False)
    below = np.floor(place)
    place -= below
    return below.astype(np.intp), place


def untrained() -> Gates:
    values = ((np.arange(KNOTS) - KNOTS // 2) * KNOT).astype(np.float32)
    return Gates(start_weights().astype(np.float32), np.tile(values, (GATES, 1)))


def learned(table: np.ndarray) -> Gates:
    """The gates that suit the table of `_watch` best, with zeros and ones of each cell: weights by Newton steps of a logistic
    regression for each gate, held to the starting ones, then what the mixed logits turned out to be."""
    middle = LEVELS // 2
    # the table's order is part, class, level, class, level, level of the node
    by_gate = table.reshape(2, CLASSES, LEVELS, CLASSES, LEVELS, LEVELS, 2).transpose(0, 1, 3, 5, 2, 4, 6).reshape(GATES, LEVELS ** 3, 2)
    inputs = (np.stack(np.unravel_index(np.arange(LEVELS ** 3), (LEVELS,) * 3), 1) - middle) * LEVEL
    gates = untrained()
    for gate, own in enumerate(by_gate):
        some = np.flatnonzero(own.sum(1))
        if not len(some):
            continue
        x, zeros, ones = inputs[some], own[some, 0], own[some, 1]
        start = weights = gates.weights[gate].astype(float)

        def loss(w: np.ndarray) -> float:
            mixed = x @ w
            return ones @ np.logaddexp(0, -mixed) + zeros @ np.logaddexp(0, mixed) + PRIOR / 2 * ((w - start) ** 2).sum()

        at = loss(weights)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ ((zeros + ones) * p - ones) + PRIOR * (weights - start)
            curve = (x * ((zeros + ones) * p * (1 - p))[:, None]).T @ x + PRIOR * np.eye(3)
            step = np.linalg.solve(curve, slope)
            while (further := loss(weights - step)) > at and np.abs(step).max() > 1e-6:
                step /= 2
            if further > at or np.abs(step).max() <= 1e-6:
                break
            weights, at = weights - step, further
        gates.weights[gate] = weights
        knot, beyond = _knots(np.clip(x @ weights, -CERTAIN, CERTAIN))
        seen = np.zeros((2, KNOTS))
        for which, counts in enumerate((zeros, ones)):
            seen[which] = np.bincount(knot, counts * (1 - beyond), KNOTS) + np.bincount(knot + 1, counts * beyond, KNOTS)
        expected = 1 / (1 + np.exp(-gates.refined[gate].astype(float)))
        gates.refined[gate] = np.log((seen[1] + PRIOR * expected) / (seen[0] + PRIOR * (1 - expected)))
    return gates


def _context_counts(texts: DataFrame, shared) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of every slot, and of every cell of the table of gates, over all texts; tables of at most `FAN_IN` tasks
    meet in one place at a time. Gates see a block as the task's counts of blocks before it predict it, which are looked at again
    whenever they have doubled."""
    slots = WORD_SLOTS + BYTE_SLOTS
    size = -(-(slots + CELLS) // CHUNK) * CHUNK

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        counts, states = np.zeros(2 * size, np.uint32), np.full(slots, LEVELS // 2, np.uint8)
        pairs, seen, watched = counts.reshape(-1, 2), 0, 0
        for block in _growing(batches):
            bits = Bits(Tokens(block), model)
            _watch(counts[2 * slots:2 * (slots + CELLS)], states, bits, model)
            _fill(counts, bits)
            only, seen = seen == watched, seen + len(block.data)
            if seen >= 2 * watched:
                # if only this block is new, its slots are
                for own in bits.slots if only else (slice(at, at + CHUNK) for at in range(0, slots, CHUNK)):
                    states[own] = _states(*pairs[own].T)
                watched = seen
        pieces = counts.reshape(-1, 2 * CHUNK)
        for piece in np.flatnonzero(pieces.any(1)):  # empty pieces are left out
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()),
                                              "counts": pa.array([_narrow(pieces[piece])], pa.binary())})
        del counts, pairs, pieces, states
        spans.release()

    schema = "piece int, counts binary"
    pieces = cut(texts.mapInArrow(filled, schema).withColumn("task", F.spark_partition_id()), "context-counts")
    tasks = (pieces.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > FAN_IN:
        grouped = pieces.withColumn("task", (F.col("task") / FAN_IN).cast("int")).groupBy("piece", "task")
        pieces = cut(grouped.applyInPandas(lambda key, rows: _added(rows).assign(task=key[1]), schema + ", task int"), "context-counts")
        tasks = -(-tasks // FAN_IN)
    counts = np.zeros((size, 2))
    for row in pieces.select("piece", "counts").groupBy("piece").applyInPandas(_added, schema).collect():
        counts[row.piece * CHUNK:(row.piece + 1) * CHUNK] = _whole(row.counts).reshape(-1, 2)
    return counts[:slots], counts[slots:slots + CELLS]


def model_of(hot: np.ndarray, n: np.ndarray, letters: np.ndarray, total: int, distinct: int) -> Model:
    """A model without context counts from the hot words' hashes and counts and the bytes' counts."""
    if END not in hot:
        hot, n = np.append(hot, END), np.append(n, 0)
    order = np.argsort(hot)     # as unsigned numbers, as the lookups need them
    hot, n = hot[order], n[order]
    letters = letters.astype(float)
    letters[spans.SPACES] = 0
    letters[_MARK] = max(total, 1)
    words = Code.of(np.append(n, max(total - n.sum(), 1)), DEEPEST)
    return Model(hot, n, words, Code.of(letters, 64), int(total), int(distinct))


def fit(texts: DataFrame, hot_words: int = HOT_WORDS) -> tuple[Model, DataFrame]:
    """The model of a one-column frame of texts (null: empty), and the table (h, n) of all words' counts."""
    texts = texts.select(F.coalesce(F.col(texts.columns[0]), F.lit("")).alias("_text"))
    found = cut(texts.mapInArrow(_counts, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n")), "word-counts")
    counts = found.filter("kind = 0").select("h", "n")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the lowest count, of those a factor of 2^(1/8) apart, from which on all words fit
    counts_enough = counts.filter(F.col("n") >= LEAST_COUNT)
    level = F.floor(F.log2("n") * 8).alias("level")
    hot_level, held = None, 0
    for row in counts_enough.groupBy(level).agg(F.count("*").alias("n")).orderBy(F.col("level").desc()).collect():
        held += row.n
        if held > hot_words:
            break
        hot_level = row.level
    stored = counts_enough.filter(F.floor(F.log2("n") * 8) >= (hot_level if hot_level is not None else 1 << 20)).toArrow()
    letters = np.zeros(256)
    for row in found.filter("kind = 1").collect():
        letters[row.h] = row.n
    model = model_of(stored["h"].to_numpy().view(np.uint64), stored["n"].to_numpy(), letters, total, distinct)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    slots, table = _context_counts(texts, shared)
    model.slots = trusted(slots[:, 0], slots[:, 1])
    model.gates = learned(table)
    return model, counts


def log_probabilities(bits: Bits, tokens: Tokens, model: Model) -> np.ndarray:
    """log10 probability of each token. The mixed logit of a bit is refined by what such logits turned out to be, in training and
    in the text so far; weights and refinements of each row move after every step."""
    rows, gates = len(tokens.first) - 1, model.gates or untrained()
    log_p = np.empty(len(bits.bit), np.float32)
    for part, bounds in enumerate(bits.bounds):
        own = slice(part * CLASSES ** 2, (part + 1) * CLASSES ** 2)
        refined = gates.refined[own].reshape(-1)
        weights = np.tile(gates.weights[own].T, rows)
        moved = np.zeros(rows * KNOTS, np.float32)      # of each row's refined logits
        bounds = np.minimum(bounds, len(bits.bit))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if low == high:
                continue
            row = bits.row[low:high]
            least = int(row[0])     # the rows of a step are in order
            row = row - least
            one, two = (model.slots.take(slots[low:high]) for slots in bits.slots)
            gate = ((one & 7) * np.int16(CLASSES) + (two & 7)).astype(np.intp)
            cells = row * CLASSES ** 2
            cells += gate
            own = weights[:, least * CLASSES ** 2:(least + int(row[-1]) + 1) * CLASSES ** 2]
            inputs = [bits.logit[low:high], *((x >> 3).astype(np.float32) for x in (one, two))]
            for x in inputs[1:]:
                x *= np.float32(1 / 256)
            mixture = own[0].take(cells)
            mixture *= inputs[0]
            for w, x in zip(own[1:], inputs[1:], strict=True):
                mixture += w.take(cells) * x
            np.clip(mixture, -CERTAIN, CERTAIN, out=mixture)
            knot, beyond = _knots(mixture)
            places = row * KNOTS
            places += knot
            gate *= KNOTS
            gate += knot
            logit = refined.take(gate)
            logit += (refined[1:].take(gate) - logit) * beyond
            further = moved[least * KNOTS:(least + int(row[-1]) + 1) * KNOTS]
            logit += further.take(places)
            np.clip(logit, -16, 16, out=logit)
            sign = bits.bit[low:high].astype(np.float32)
            sign *= 2
            sign -= 1
            logit *= -sign
            p = np.exp(logit, out=logit)
            p += 1
            np.divide(1, p, out=p)
            np.log(p, out=log_p[low:high])
            if high == bounds[-1]:
                break
            np.subtract(1, p, out=p)
            error = np.multiply(sign, p, out=p)
            step = RATE / np.sqrt(np.maximum(np.bincount(cells, minlength=own.shape[1]), 1))
            for w, x in zip(own, inputs, strict=True):
                w += step * np.bincount(cells, error * x, len(w))
            step = REFINING_RATE / np.sqrt(np.maximum(np.bincount(places, minlength=len(further)), 1))
            further += step * np.bincount(places, error, len(further))
    return model.words.rest[bits.leaf] + np.bincount(bits.token, log_p, len(tokens.hash)) / np.log(10)


SCORED = ("n_tokens long, n_bytes long, known long, base double, score double, rare array<struct<h:long,k:long>>")


def score(docs: DataFrame, text: str, model: Model, counts: DataFrame) -> DataFrame:
    """The columns of `docs` but the text, with _n_tokens, _n_known, _base (log10 probability under smoothed word counts), _score (log10 probability of the
    mixed model) and _bits_per_byte (null for empty texts). Null counts as empty, which is one token, the end.

    Repeated rows are scored each; columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(values: pa.Array) -> dict[str, pa.Array]:
        known_model = shared.value
        made = {name: [] for name in ("n_tokens", "n_bytes", "known", "base", "score")}
        rare_rows, rare_h, rare_k = [], [], []
        hot_base = known_model.base(known_model.counts)
        for block in spans.blocks(values, BLOCK):
            tokens = Tokens(block)
            bits = Bits(tokens, known_model)
            rows = block.last - block.first
            at = np.where(bits.known, bits.leaf, 0)
            counted = bits.known & (known_model.counts[at] > 0)
            made["n_tokens"].append(np.diff(tokens.first))
            made["n_bytes"].append(np.diff(block.offsets))
            made["known"].append(spans.row_sums(counted.astype(np.int64), tokens.first))
            made["base"].append(np.bincount(tokens.row, np.where(bits.known, hot_base[at], 0.0), rows))
            made["score"].append(np.bincount(tokens.row, log_probabilities(bits, tokens, known_model), rows))
            others = np.flatnonzero(~bits.known)
            order = others[np.lexsort((tokens.hash[others], tokens.row[others]))]
            new = np.ones(len(order), bool)
            new[1:] = (tokens.hash[order][1:] != tokens.hash[order][:-1]) | (tokens.row[order][1:] != tokens.row[order][:-1])
            lead = np.flatnonzero(new)
            rare_rows.append(np.bincount(tokens.row[order[lead]], minlength=rows))
            rare_h.append(tokens.hash[order[lead]].view(np.int64))
            rare_k.append(np.diff(np.append(lead, len(order))))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(rare_rows))]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(rare_h)), pa.array(np.concatenate(rare_k), pa.int64())], ["h", "k"])
        done = {name: pa.array(np.concatenate(parts)) for name, parts in made.items()}
        return done | {"rare": pa.ListArray.from_arrays(pa.array(offsets), pairs)}

    added = ("_n_tokens", "_n_known", "_base", "_score", "_bits_per_byte")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in added]
    stored = cut(docs.select(F.struct(*kept).alias("_row"), arrow_struct(F.col(f"`{text}`"), SCORED, work).alias("_s"))
                 .select(F.monotonically_increasing_id().alias("_id"), "_row", "_s.*"), "scored")
    words = stored.select("_id", F.explode("rare").alias("w")).select("_id", "w.h", "w.k")
    joined = words.join(counts.withColumnRenamed("n", "c"), "h", "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    per_row = joined.groupBy("_id").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("_known"),
        F.sum(F.col("k") * F.log10((c + SMOOTHING) / (model.total + SMOOTHING * (model.distinct + 1)))).alias("_rest"))
    return stored.drop("rare").join(per_row, "_id", "left").select(
        "_row.*", F.col("n_tokens").alias("_n_tokens"), (F.col("known") + F.coalesce("_known", F.lit(0))).alias("_n_known"),
        (F.col("base") + F.coalesce("_rest", F.lit(0.0))).alias("_base"), F.col("score").alias("_score"),
        (-F.col("score") * F.log2(F.lit(10.0)) / F.nullif("n_bytes", F.lit(0))).alias("_bits_per_byte"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text, learned outside the held-out fold (crc32 of the id modulo 10 is 0)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", in_fold(F.col("doc_id"), 10, 0).alias("held_out"))
    learning = docs.filter("not held_out and doc_id is not null").select("text")
    model, counts = fit(learning)
    return score(docs, "text", model, counts).select(
        "doc_id", "held_out", F.col("_n_tokens").alias("n_tokens"), F.col("_n_known").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), F.col("_base").alias("base_score"), F.col("_score").alias("score"),
        F.col("_bits_per_byte").alias("bits_per_byte"))
