"""Benchmark decontamination with an FM-index over each shard of training text.

A shard is a run of consecutive words of some rows. Words that occur in no benchmark item become one common symbol.
The shard's suffixes are sorted, the Burrows-Wheeler transform is stored as a wavelet matrix, and the windows of the
benchmark are searched backwards, all at once, one word at a time, by ranks in the matrix. Occurrences are located by walking to
sampled suffix positions, and their spans are merged. Indexes live in a task's memory and are dropped after the search.

Words are compared by 64-bit hashes. The benchmark is sent to the tasks in parts of at most `PART_BYTES` of text, so a
large one means more passes and not a larger broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import arrow_struct, table

WINDOW = 10
SHARD_WORDS = 1 << 18
SAMPLED = 8                # every eighth suffix position is stored
PART_BYTES = 8 << 20

SIGNS = np.zeros(256, bool)
SIGNS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True  # A-Z are lower-cased


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order; the last symbol is the smallest and unique.

    Several symbols are sorted at once, then only suffixes that are still equal, by twice as many symbols each time.
    """
    n, bits = len(symbols), max(int(symbols.max()).bit_length(), 1)
    step = max(63 // bits, 1)
    padded = np.concatenate([symbols, np.zeros(step, symbols.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for k in range(step):
        key = (key << bits) | padded[k:n + k]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    first = np.ones(n, bool)
    first[1:] = key[order][1:] != key[order][:-1]
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
    while True:
        alone = first & np.append(first[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return order
        suffix = order[slots]
        key = rank[suffix] * n + rank[suffix + step]
        within = np.argsort(key, kind="stable")
        suffix, key = suffix[within], key[within]
        order[slots] = suffix
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        rank[suffix] = np.maximum.accumulate(np.where(first, slots, 0))
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit of the symbols for each level, with running counts of ones."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max((size - 1).bit_length(), 1)
        self.ones, self.zeros = [], []
        current = symbols
        for level in reversed(range(self.levels)):
            bit = (current >> level & 1).astype(bool)
            ones = np.zeros(len(current) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(current) - int(ones[-1]))
            current = np.concatenate([current[~bit], current[bit]])
        self.begins = self._walk(np.arange(size), np.zeros(size, np.int64))

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros, strict=True):
            before = ones[at]
            at = np.where(symbols >> level & 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._walk(symbols, at) - self.begins[symbols]


class FmIndex:
    """Of symbols 1 to size - 1; 0 ends the text."""

    def __init__(self, symbols: np.ndarray, size: int):
        text = np.append(symbols, 0).astype(np.int32)
        order = suffix_order(text)
        self.last = text[order - 1]
        self.matrix = WaveletMatrix(self.last, size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        marked = order % SAMPLED == 0
        self.marked = marked
        self.sample_rank = np.concatenate([[0], np.cumsum(marked)])
        self.samples = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (rows, filled up at the right), the range of suffixes that begin with it."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last))
        for k in reversed(range(phrases.shape[1])):
            at = np.flatnonzero((lengths > k) & (low < high))
            if not len(at):
                continue
            symbol = phrases[at, k]
            low[at] = self.smaller[symbol] + self.matrix.rank(symbol, low[at])
            high[at] = self.smaller[symbol] + self.matrix.rank(symbol, high[at])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps to the text's left until a sampled one is met."""
        position, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        waiting, at = np.arange(len(rows)), rows.copy()
        while len(waiting):
            there = self.marked[at]
            found = waiting[there]
            position[found] = self.samples[self.sample_rank[at[there]]] + steps[found]
            waiting, at = waiting[~there], at[~there]
            symbol = self.last[at]
            at = self.smaller[symbol] + self.matrix.rank(symbol, at)
            steps[waiting] += 1
        return position


@dataclass
class Phrases:
    """Windows of one part of the benchmark, as symbols from 2 on, and the items of each window."""

    vocabulary: np.ndarray      # sorted word hashes; symbol = place + 2
    windows: np.ndarray         # distinct windows, filled up with 0
    lengths: np.ndarray
    first_item: np.ndarray      # of each window in `items`, one entry more
    items: np.ndarray
    names: list[str]

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        """1 for words that are in no window."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 2, 1)


def word_hashes(block: spans.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, firsts = spans.words(block, SIGNS)
    return starts, ends, firsts, spans.hashes(block.data, starts, ends, spans.LOWER)


def phrases_of(names: list[str], texts: list[str], window: int = WINDOW) -> Phrases | None:
    """None if no text has a word."""
    found: dict[tuple[int, ...], set[int]] = {}
    for block in spans.blocks(pa.array(texts, pa.string())):
        _, _, firsts, hashed = word_hashes(block)
        for row in range(block.last - block.first):
            own = hashed[firsts[row]:firsts[row + 1]].tolist()
            for at in range(max(len(own) - window, 0) + 1 if own else 0):
                found.setdefault(tuple(own[at:at + window]), set()).add(block.first + row)
    if not found:
        return None
    vocabulary = np.unique(np.array([h for key in found for h in key], np.uint64))
    windows = np.zeros((len(found), window), np.int64)
    lengths = np.array([len(key) for key in found])
    for at, key in enumerate(found):
        windows[at, :len(key)] = np.searchsorted(vocabulary, np.array(key, np.uint64)) + 2
    items = [sorted(owners) for owners in found.values()]
    return Phrases(vocabulary, windows, lengths, np.cumsum([0, *map(len, items)]), np.concatenate(items), names)


def occurrences(hashed: np.ndarray, rows: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of windows inside rows: the place of the first word, and the window."""
    all_symbols, reach = phrases.symbols(hashed), phrases.windows.shape[1] - 1
    places, windows = [], []
    for low in range(0, len(hashed), SHARD_WORDS):
        begin, end = max(low - reach, 0), min(low + SHARD_WORDS, len(hashed))
        symbols, own = all_symbols[begin:end], rows[begin:end]
        # a 1 between rows, and a single 1 for neighbouring words that are in no window
        border = np.flatnonzero(own[1:] != own[:-1]) + 1
        places_in = np.insert(np.arange(begin, end), border, -1)
        text = np.insert(symbols, border, 1)
        stays = np.ones(len(text), bool)
        stays[1:] = (text[1:] != 1) | (text[:-1] != 1)
        text, places_in = text[stays], places_in[stays]
        index = FmIndex(text, len(phrases.vocabulary) + 2)
        # only windows all of whose words are in the shard are searched
        known = np.zeros(len(phrases.vocabulary) + 2, bool)
        known[text] = True
        asked = np.flatnonzero((known[phrases.windows] | (np.arange(reach + 1) >= phrases.lengths[:, None])).all(1))
        if not len(asked):
            continue
        first, last = index.search(phrases.windows[asked], phrases.lengths[asked])
        many = last - first
        hit = np.repeat(np.arange(len(many)), many)
        if len(hit):
            within = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
            places.append(places_in[index.locate(first[hit] + within)])
            windows.append(asked[hit])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(windows)


FOUND = "n_words long, ranges array<struct<first:long,last:long>>, items array<string>"


def _range_arrays(counts: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64))], ["first", "last"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _find(values: pa.Array, phrases: Phrases | None) -> dict[str, pa.Array]:
    n_words, counts, first, last, items = [], [], [], [], []
    for block in spans.blocks(values):
        _, _, firsts, hashed = word_hashes(block)
        rows, n_rows = spans.rows_of(firsts), block.last - block.first
        n_words.append(np.diff(firsts))
        edges = np.zeros(len(hashed) + 1, np.int64)
        owned: list[list[str]] = [[] for _ in range(n_rows)]
        if phrases is not None and len(hashed):
            at, window = occurrences(hashed, rows, phrases)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + phrases.lengths[window], -1)
            for row, w in np.unique(np.stack([rows[at], window], 1), axis=0):
                owned[row] += [phrases.names[i] for i in phrases.items[phrases.first_item[w]:phrases.first_item[w + 1]]]
        hit = np.cumsum(edges[:-1]) > 0
        begins, ends, run_firsts = spans.runs(hit.view(np.uint8), firsts)
        owner = spans.rows_of(run_firsts)
        counts.append(np.diff(run_firsts))
        first.append(begins - firsts[owner])
        last.append(ends - firsts[owner])
        items += [sorted({name for name in names if name is not None}) for names in owned]
    return {"n_words": pa.array(np.concatenate(n_words), pa.int64()),
            "ranges": _range_arrays(np.concatenate(counts), np.concatenate(first), np.concatenate(last)),
            "items": pa.array(items, pa.list_(pa.string()))}


def find_windows(text: Column, benchmark: DataFrame, item: str = "item_id", item_text: str = "text",
                 window: int = WINDOW, part_bytes: int = PART_BYTES) -> Column:
    """A struct for each text: n_words; `ranges` of words (first, last exclusive) inside any occurrence of a window of
    the benchmark, merged; and `items` that have occurring windows, sorted as strings.

    A window is `window` consecutive words of an item; a shorter item with words is one window. Null and empty texts have
    no words; windows of items without an id are found, but these have no name to list; an empty benchmark finds nothing.
    Repeated items and texts count once each; a text is searched in one piece however long it is. Reads the benchmark when
    called.
    """
    items = benchmark.select(F.col(item).cast("string").alias("name"), F.coalesce(item_text, F.lit("")).alias("content"))
    total = items.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    parts = max(-(-total // part_bytes), 1)
    found = []
    for part in range(parts):
        # a part is what one broadcast holds
        own = items.filter(F.pmod(F.xxhash64("name", "content"), F.lit(parts)) == part).orderBy("name", "content").collect()
        shared = benchmark.sparkSession.sparkContext.broadcast(
            phrases_of([row.name for row in own], [row.content for row in own], window))
        found.append(arrow_struct(text, FOUND, lambda values, shared=shared: _find(values, shared.value)))
    if parts == 1:
        return found[0]
    ranges = F.array_sort(F.flatten(F.array(*[f["ranges"] for f in found])))
    merged = F.aggregate(ranges, F.array().cast("array<struct<first:long,last:long>>"), lambda done, r: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["last"] >= r["first"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["first"].alias("first"),
            F.greatest(F.element_at(done, -1)["last"], r["last"]).alias("last"))))).otherwise(F.concat(done, F.array(r))))
    return F.struct(found[0]["n_words"].alias("n_words"), merged.alias("ranges"),
                    F.array_sort(F.array_distinct(F.flatten(F.array(*[f["items"] for f in found])))).alias("items"))


def _without(values: pa.Array, ranges: pa.Array) -> pa.Array:
    kept = []
    for value, own in zip(values, ranges, strict=True):
        content = value.as_py()
        own = own.as_py()
        if own:
            block = next(spans.blocks(pa.array([content], pa.string())))
            starts, ends, _ = spans.words(block, SIGNS)
            data, at, pieces = block.data.tobytes(), 0, []
            for r in own:
                pieces.append(data[at:starts[r["first"]]])
                at = ends[r["last"] - 1]
            content = b"".join([*pieces, data[at:]]).decode()
        kept.append(content)
    spans.release()
    return pa.array(kept, pa.string())


def without_ranges(text: Column, ranges: Column) -> Column:
    """The text without the words of each range and what stands between them; null stays null."""
    return F.arrow_udf(_without, "string")(text, ranges)


def n_hit(ranges: Column) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda total, r: total + r["last"] - r["first"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text inside windows of ten benchmark words, and the items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", find_windows(F.col("text"), table(spark, sf_dir, "benchmark")).alias("found"))
    hit = n_hit(F.col("found.ranges"))
    return found.select("doc_id", "found.n_words", hit.alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


OP10_SQL = r"""
WITH lowered AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win, least(len(w), 10) AS n
    FROM items, LATERAL unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
places AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM lowered, (SELECT DISTINCT n FROM windows) AS sizes, LATERAL unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, p.n, item FROM places p JOIN windows v ON p.win = v.win AND p.n = v.n),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM hits, LATERAL unnest(range(i, i + n)) AS t(k) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
