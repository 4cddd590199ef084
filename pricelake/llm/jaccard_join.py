"""Near duplicates by an exact Jaccard join of word n-gram sets, as connected components.

Sets are told apart by 64-bit hashes of their contents ("nodes"), so exact copies are one node from the start. Links are
only made by intersecting two nodes' sorted shingle hashes. Candidates come in three steps, none of which loses a link:

1. Nodes that share a smallest hash under one of `BANDS` permutations are compared with the first node of their bucket,
   bitmap with bitmap and, if these let the pair through, set with set. This joins most copies to large components by stars
   instead of by all pairs.
2. Two sets that link share a shingle among the first quarter of each, in any common order. The order here puts
   shingles last that a twice-seen filter over all nodes has, so most texts have nothing to share in that quarter. Of the
   rest, only shingles that nodes of different components have there are kept.
3. Nodes that hang together by such shingles form a cluster. A cluster is cut into tiles by size bands of a ratio of 4/3,
   and bands of more than `TILE` nodes into blocks; tiles of one band and of neighbouring bands meet in cells. A node's
   bitmap is sent to every cell of its tile. There, bit counts bound every intersection from above, and only nodes that
   the bound leaves a partner in another component send their text to the cell, whose pairs are then intersected, sorted
   array with sorted array. A cluster that fits a tile is one cell, parted by size bands in its task, and gets its texts
   at once.

A cell holds a bounded number of nodes. The twice-seen filter is gathered in 2^32 places and broadcast in as many bits as its
set ones ask for, up to a bound; full filters let more through, never less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import by_batch, table
from pricelake.session import cut, drop_stored

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100        # of the least similarity
BANDS = 8
FILTER_BITS = 24
TWICE_BITS, SHARD_BITS = 32, 22         # of the filter of shingles that two nodes have, as it is gathered, and of its shards
FOLDED_BITS, LEAST_FOLDED = 29, 22      # bits of that filter as it is broadcast: 2^29 (64 MB) at most
SPARE = 8                               # bits of the broadcast filter for each set one
FAN_IN = 64                             # tasks whose filters meet in one place at a time
HELD = 2_000_000                        # places of shingles that a task holds before it combines them
TILE = 1024                             # nodes of a tile
CELL = 1024                             # nodes of each side whose pairs one task compares
BAND_RATIO = 4 / 3
LEAST_BITS, MOST_BITS = 64, 4096        # of a bitmap; about twice the set's size between

_PERMUTATIONS = spans.mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def least_common(a, b):
    """Members that sets of sizes a and b must share at least: J >= p/q is I >= p (a + b) / (p + q)."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def shingle_sets(block: spans.Block, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and the first of each (one more). Rows of fewer words have one shingle
    of all their words; rows without words have none."""
    starts, ends, firsts = spans.words(block)
    hashed = spans.hashes(block.data, starts, ends, spans.LOWER)
    grams, rows = spans.ngrams(hashed, firsts, n)
    counts = np.diff(firsts)
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = np.zeros(len(short), np.uint64)
    for k in range(n - 1):
        has = counts[short] > k
        value = hashed[np.minimum(firsts[short] + k, max(len(hashed) - 1, 0))] if len(hashed) else whole
        whole = np.where(has, spans.mixed(whole * np.uint64(0xD1342543DE82EF95) + value), whole)
    grams, rows = np.concatenate([grams, whole]), np.concatenate([rows, short])
    if len(short):
        order = np.argsort(rows, kind="stable")
        grams, rows = grams[order], rows[order]
    bounds = np.searchsorted(rows, np.arange(len(counts) + 1))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        grams[low:high].sort()
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    grams, rows = grams[new], rows[new]
    return grams, np.searchsorted(rows, np.arange(len(counts) + 1))


def node_ids(grams: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of each row's set: sums of two mixings of its members, mixed with its size."""
    sizes = np.diff(firsts).astype(np.uint64)
    sums = []
    for salt in (0, 0x5851F42D4C957F2D):
        upto = np.zeros(len(grams) + 1, np.uint64)     # wraps around, so a row's sum does not depend on the rows before it
        np.cumsum(spans.mixed(grams ^ np.uint64(salt)), out=upto[1:])
        sums.append(upto[firsts[1:]] - upto[firsts[:-1]])
    return spans.mixed(spans.mixed(sums[0] + sizes) ^ sums[1])


def _first_hashes(grams: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Rows times BANDS: the smallest member under each permutation, mixed with its number; for rows with members."""
    found = np.zeros((len(firsts) - 1, BANDS), np.uint64)
    some = np.flatnonzero(np.diff(firsts))
    for k, factor in enumerate(_PERMUTATIONS):
        values = grams * factor
        values ^= values >> np.uint64(31)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        if len(some):
            found[some, k] = spans.mixed(np.minimum.reduceat(values, firsts[some]) + np.uint64(k))
    return found


def _key(node: np.ndarray, ids: pa.Array) -> np.ndarray:
    """A place in a filter for (node, document)."""
    text = ids.cast(pa.string()).fill_null("\\N")
    block = next(spans.blocks(text, 1 << 62))
    named = spans.hashes(block.data, block.offsets[:-1], block.offsets[1:])
    return (spans.mixed(node ^ named) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bitmap(places: DataFrame) -> np.ndarray:
    """The filter of a one-column frame of places; at most 2^FILTER_BITS distinct ones reach the driver."""
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[places.distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(bits)


def _in(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (packed[places >> 3] >> (7 - (places & 7)) & 1).astype(bool)


class Sets:
    """The documents' sets, read again from their texts whenever they are needed."""

    def __init__(self, docs: DataFrame, doc: str, text: str):
        self.spark = docs.sparkSession
        self.rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        self.kind = docs.schema[doc].dataType.simpleString()
        self.summary = cut(by_batch(self.rows, f"doc {self.kind}, node long, n long, bands array<long>, bits binary", _summary), "shingle-sets")
        self.nodes = cut(self.summary.filter("n > 0").groupBy("node").agg(
            F.min("doc").alias("doc"), *(F.first(c).alias(c) for c in ("n", "bands", "bits"))), "nodes")
        # one document for each node
        kept = by_batch(self.nodes.select("node", "doc"), "place int", lambda batch: {"place": pa.array(
            _key(batch.column(0).to_numpy().view(np.uint64), batch.column(1)), pa.int32())})
        self.chosen = self.spark.sparkContext.broadcast(_bitmap(kept))
        self.twice = self.spark.sparkContext.broadcast(self._twice())

    def _twice(self) -> np.ndarray:
        """A filter of the shingles of at least two nodes, as a bitmap."""
        standing = _standing_of(self.chosen)

        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places, twice, held, base = [], [], 0, 0
            for batch in batches:
                for block in spans.blocks(batch.column(1)):
                    grams, firsts = shingle_sets(block)
                    stands = standing(batch.column(0).slice(block.first, block.last - block.first), grams, firsts)
                    places.append(_twice_place(grams[stands[spans.rows_of(firsts)]]).astype(np.uint32))
                    held += len(places[-1])
                    if held > max(HELD, base):
                        once, more = _once_and_twice(places)
                        places, held, base = [once], 0, len(once)
                        twice.append(more)
            once, more = _once_and_twice(places)
            twice = np.unique(np.concatenate([*twice, more]))
            shards = (np.arange(1 << TWICE_BITS - SHARD_BITS) << SHARD_BITS).astype(np.uint32)
            at, also = (np.append(np.searchsorted(x, shards), len(x)) for x in (once, twice))
            inside = np.uint32((1 << SHARD_BITS) - 1)
            for shard in np.flatnonzero(np.diff(at)):
                yield _seen_batch(shard, (once[at[shard]:at[shard + 1]] & inside).astype(np.int64),
                                  (twice[also[shard]:also[shard + 1]] & inside).astype(np.int64))
            del once, twice, more, places
            spans.release()

        schema = "shard int, once binary, twice binary"
        found = self.rows.mapInArrow(seen, schema).withColumn("part", F.spark_partition_id())
        tasks = self.rows.rdd.getNumPartitions()
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            grouped = found.withColumn("part", (F.col("part") / FAN_IN).cast("int")).groupBy("shard", "part")
            found = grouped.applyInPandas(lambda key, rows: _seen_by_all(rows).assign(part=key[1]), schema + ", part int")
        merged = cut(found.drop("part").groupBy("shard").applyInPandas(_seen_twice, "shard int, twice binary, n long"), "twice-seen")
        total = merged.agg(F.sum("n")).first()[0] or 0
        bits = min(max((SPARE * total).bit_length(), LEAST_FOLDED), FOLDED_BITS)
        folds = merged.groupBy(F.pmod("shard", F.lit(1 << bits - SHARD_BITS)).alias("fold"))
        whole = np.zeros((1 << bits - SHARD_BITS, (1 << SHARD_BITS) // 8), np.uint8)
        for row in folds.applyInPandas(_folded, "fold int, bits binary").toLocalIterator():
            whole[row.fold] = np.frombuffer(row.bits, np.uint8)
        return whole.reshape(-1)

    def prefixes(self) -> DataFrame:
        """(token, node) of the first quarter of each node's set as far as other nodes may have the token."""
        standing, twice = _standing_of(self.chosen), self.twice

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in spans.blocks(batch.column(1)):
                    grams, firsts = shingle_sets(block)
                    stands = standing(batch.column(0).slice(block.first, block.last - block.first), grams, firsts)
                    size, row = np.diff(firsts), spans.rows_of(firsts)
                    shared = _in(twice.value, _twice_place(grams) & (8 * len(twice.value) - 1))
                    upto = np.concatenate([[0], np.cumsum(shared)])
                    alone = size - (upto[firsts[1:]] - upto[firsts[:-1]])
                    quarter = size - (NUMERATOR * size + DENOMINATOR - 1) // DENOMINATOR + 1
                    keep = shared & stands[row] & (alone[row] + upto[:-1] - upto[firsts[:-1]][row] < quarter[row])
                    if keep.any():
                        yield pa.RecordBatch.from_pydict({
                            "token": pa.array(grams[keep].view(np.int64)),
                            "node": pa.array(node_ids(grams, firsts)[row[keep]].view(np.int64))})
            spans.release()

        return self.rows.mapInArrow(run, "token long, node long")

    def cell_links(self, shared: DataFrame) -> DataFrame:
        """Links (a, b) between nodes of different components that share a token; `shared` has (token, node, comp)."""
        dealt = shared.repartition("token")     # once for both sides of the join
        stars = (dealt.groupBy("token").agg(F.min("node").alias("a"), F.min("comp").alias("one"), F.max("comp").alias("two"))
                 .filter("one <> two").select("token", "a"))
        edges = cut(dealt.join(stars, "token").filter("a < node").select("a", F.col("node").alias("b")).distinct(), "shared-tokens")
        band = F.floor(F.log("n") / F.log(F.lit(BAND_RATIO))).cast("int")
        members = (components(edges).withColumnRenamed("comp", "cluster").join(self.nodes, "node")
                   .withColumn("band", band))
        members = members.join(shared.select("node", "comp").distinct(), "node")
        # a cluster that fits a tile is one cell, whose task parts it by size bands itself, so each text is sent once
        whole = members.groupBy("cluster").agg((F.count("*") <= TILE).alias("whole"))
        members = members.join(whole, "cluster").withColumn("band", F.when(F.col("whole"), F.lit(-1)).otherwise(F.col("band")))
        sizes = members.groupBy("cluster", "band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
        members = cut(members.join(sizes, ["cluster", "band"]).select(
            "node", "comp", "cluster", "band", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
            F.col("doc").alias("chosen"), "n", "bits"), "cluster-nodes")
        sizes = cut(sizes, "cluster-bands")
        # a tile meets the tiles of its band and of the next: cell (band, block, next band or the same, its block)
        other = sizes.select("cluster", F.col("band").alias("band_b"), F.col("blocks").alias("blocks_b"))
        tiles = cut(members.select("cluster", "band", "block").distinct(), "tiles")
        pairs = tiles.join(other, "cluster").filter("band_b = band or band_b = band + 1").withColumn(
            "block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1))).filter("band_b > band or block_b >= block")
        cells = pairs.select("cluster", "band", "block", "band_b", "block_b")
        own = members.join(cells, ["cluster", "band", "block"])
        cells_b = cells.select("cluster", F.col("band").alias("band_a"), F.col("block").alias("block_a"),
                               F.col("band_b").alias("band"), F.col("block_b").alias("block")).filter("band <> band_a or block <> block_a")
        visiting = members.join(cells_b, ["cluster", "band", "block"])
        keys = ["cluster", "band_a", "block_a", "band_b", "block_b"]
        sent = own.select("cluster", F.col("band").alias("band_a"), F.col("block").alias("block_a"), "band_b", "block_b",
                          F.lit(0).alias("side"), "node", "comp", "n", "bits").union(visiting.select(
                              "cluster", "band_a", "block_a", F.col("band").alias("band_b"), F.col("block").alias("block_b"),
                              F.lit(1), "node", "comp", "n", "bits"))
        columns = [F.col(c).cast("long") for c in (*keys, "side", "node", "comp")]
        partnered = sent.filter("band_a >= 0").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            _partnered, ", ".join(f"{c} long" for c in (*keys, "side", "node", "comp")))
        partnered = cut(sent.filter("band_a < 0").select(columns).union(partnered), "partnered-nodes")
        wanted = members.join(partnered.select("node").distinct(), "node", "left_semi").select("node", "chosen")
        rows = partnered.join(self._texts(wanted), "node").select(*keys, "side", "node", "comp", "text")
        return cut(rows.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(_cell_work, "a long, b long"), "links")

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) of nodes whose sizes and bitmaps do not rule a link out."""
        ends = [self.nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
                for end in "ab"]
        return by_batch(pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b"),
                        "a long, b long", _bounded)

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs (a, b) of nodes whose sets are similar enough; exact.

        Pairs that hang together meet in one cell, or, where more than `CELL` nodes do, in a grid of cells; each text is
        sent once to every cell that compares it, not with every pair.
        """
        pairs = cut(self.bounded(pairs), "candidate-pairs")
        hangs = components(pairs)
        sizes = hangs.groupBy("comp").agg(F.ceil(F.count("*") / CELL).cast("int").alias("blocks"))
        placed = cut(hangs.join(sizes, "comp").join(self.nodes, "node").select(
            "node", "comp", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.col("doc").alias("chosen")),
            "candidate-nodes")
        ends = [placed.select(F.col("node").alias(end), "comp", F.col("block").alias(f"block_{end}")) for end in "ab"]
        cells = cut(pairs.join(ends[0], "a").join(ends[1].drop("comp"), "b").select(
            "comp", F.least("block_a", "block_b").alias("low"), F.greatest("block_a", "block_b").alias("high"), "a", "b"), "cells")
        keys = ["comp", "low", "high"]
        sent = cells.select(*keys, F.explode(F.array("a", "b")).alias("node")).distinct()
        nothing = F.lit(None)
        rows = (sent.join(self._texts(placed.select("node", "chosen")), "node")
                .select(*keys, F.lit(0).alias("kind"), F.col("node").alias("a"), nothing.cast("long").alias("b"), "text")
                .union(cells.select(*keys, F.lit(1), "a", "b", nothing.cast("string"))))
        dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "kind")
        return cut(dealt.select(*keys, "a", "b", "text").mapInArrow(_compared, "a long, b long"), "links")

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(node, text) for rows (node, chosen): the text of each node's chosen document."""
        # most documents are ruled out by their id, before their sets are made
        ids, kept = (by_batch(wanted, "place int", work) for work in (
            lambda batch: {"place": pa.array(_key(np.uint64(0), batch.column(1)), pa.int32())},
            lambda batch: {"place": pa.array(_key(batch.column(0).to_numpy().view(np.uint64), batch.column(1)), pa.int32())}))
        named, packed = (self.spark.sparkContext.broadcast(_bitmap(places)) for places in (ids, kept))

        def work(batch: pa.RecordBatch) -> dict | None:
            batch = batch.take(pa.array(np.flatnonzero(_in(named.value, _key(np.uint64(0), batch.column(0))))))
            if not batch.num_rows:
                return None
            node = np.concatenate([node_ids(*shingle_sets(block)) for block in spans.blocks(batch.column(1))])
            at = np.flatnonzero(_in(packed.value, _key(node, batch.column(0))))
            picked = pa.array(at)
            return {"node": pa.array(node[at].view(np.int64)), "doc": batch.column(0).take(picked),
                    "text": batch.column(1).take(picked)} if len(at) else None

        texts = by_batch(self.rows, f"node long, doc {self.kind}, text string", work)
        return (texts.join(wanted, "node").filter(F.col("doc").eqNullSafe(F.col("chosen"))).select("node", "text")
                .dropDuplicates(["node"]))


def _standing_of(chosen):
    """A function that says which rows stand for their node; all of them do, and perhaps a few more."""
    return lambda ids, grams, firsts: _in(chosen.value, _key(node_ids(grams, firsts), ids)) & (np.diff(firsts) > 0)


def _twice_place(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - TWICE_BITS)).astype(np.int64)


def _once_and_twice(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All places, and those that occur again."""
    every = np.concatenate([*places, np.zeros(0, np.uint32)])
    every.sort()
    again = every[1:] == every[:-1]
    more = every[1:][again]
    return every[np.append(np.ones(min(len(every), 1), bool), ~again)], more[np.append(np.ones(min(len(more), 1), bool), more[1:] != more[:-1])]


def _seen_batch(shard: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "once": pa.array([_gaps(once)], pa.binary()),
                                       "twice": pa.array([_gaps(twice)], pa.binary())})


def _gaps(places: np.ndarray) -> bytes:
    """Ascending places as gaps in 16 bits, or as they are where a gap is too wide."""
    gaps = np.diff(places, prepend=0)
    if len(gaps) and gaps.max() > 65535:
        return b"4" + places.astype(np.uint32).tobytes()
    return b"2" + gaps.astype(np.uint16).tobytes()


def _places(stored: bytes) -> np.ndarray:
    if stored[:1] == b"4":
        return np.frombuffer(stored, np.uint32, offset=1).astype(np.int64)
    return np.cumsum(np.frombuffer(stored, np.uint16, offset=1), dtype=np.int64)


def _met(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    once, more = _once_and_twice([_places(x) for x in rows["once"]])
    return once, np.unique(np.concatenate([more, *map(_places, rows["twice"])]))


def _seen_by_all(rows: pd.DataFrame) -> pd.DataFrame:
    once, twice = _met(rows)
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "once": [_gaps(once)], "twice": [_gaps(twice)]})


def _seen_twice(rows: pd.DataFrame) -> pd.DataFrame:
    twice = _met(rows)[1]
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "twice": [_gaps(twice)], "n": [len(twice)]})


def _folded(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The shards that fall on one another when only the low bits of a place count."""
    bits = np.zeros(1 << SHARD_BITS, bool)
    for stored in rows["twice"]:
        bits[_places(stored)] = True
    return pd.DataFrame({"fold": [key[0]], "bits": [np.packbits(bits).tobytes()]})


def _summary(batch: pa.RecordBatch) -> dict:
    nodes, sizes, bands, bits = [], [], [], []
    for block in spans.blocks(batch.column(1)):
        grams, firsts = shingle_sets(block)
        nodes.append(node_ids(grams, firsts).view(np.int64))
        sizes.append(np.diff(firsts))
        bands.append(_first_hashes(grams, firsts).view(np.int64))
        bits += [_signature(grams[low:high]) for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]
    bands = np.concatenate(bands)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1)))
    return {"doc": batch.column(0), "node": pa.array(np.concatenate(nodes)), "n": pa.array(np.concatenate(sizes), pa.int64()),
            "bands": lists, "bits": pa.array(bits, pa.binary())}


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similar pairs of rows (comp, low, high, a, b, text) in the order of their cells, a cell's texts before its pairs."""
    cell, sets = None, {}
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
        a, is_text = batch.column(3).to_numpy(), ~np.asarray(batch.column(4).is_valid())
        b = batch.column(4).fill_null(0).to_numpy()
        own = [[], []]
        bounds = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))), len(keys))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if tuple(keys[low]) != cell:
                cell, sets = tuple(keys[low]), {}
            pairs_from = low + int(is_text[low:high].sum())
            sets |= zip(a[low:pairs_from].tolist(), _sets(batch.column(5).slice(low, pairs_from - low)), strict=True)
            for one, two in zip(a[pairs_from:high].tolist(), b[pairs_from:high].tolist(), strict=True):
                if _similar(sets[one], sets[two]):
                    own[0].append(one)
                    own[1].append(two)
        if own[0]:
            yield pa.RecordBatch.from_pydict({"a": pa.array(own[0], pa.int64()), "b": pa.array(own[1], pa.int64())})
    sets.clear()
    spans.release()


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """By intersecting two sorted arrays."""
    if min(len(x), len(y)) < least_common(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")    # two sorted runs
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common > 0 and DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for block in spans.blocks(texts):
        grams, firsts = shingle_sets(block)
        for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            yield grams[low:high].copy()


def _signature(grams: np.ndarray) -> bytes:
    """A bitmap with a bit set for each member, of a power of two of bits, about twice as many as members."""
    bits = min(max(1 << (2 * len(grams) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    mask = np.zeros(bits, bool)
    mask[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(mask, bitorder="little").tobytes()


def _matrix(bitmaps: list[bytes], width: int | None = None) -> np.ndarray:
    """Bitmaps as rows of 64-bit words; wider ones are folded to `width` bytes or the narrowest, which keeps every member's bit."""
    width = width or min(map(len, bitmaps))
    rows = np.zeros((len(bitmaps), width // 8), np.uint64)
    for i, stored in enumerate(bitmaps):
        rows[i] = np.bitwise_or.reduce(np.frombuffer(stored, np.uint64).reshape(-1, width // 8), axis=0)
    return rows


def _bounded(batch: pa.RecordBatch) -> dict | None:
    """The pairs (a, b) of rows (a, b, both sizes, both bitmaps) that sizes and bitmaps let through."""
    one, two = (batch.column(k).to_numpy() for k in (2, 3))
    need = least_common(one, two)
    width = np.minimum(*(pc.binary_length(batch.column(k)).to_numpy() for k in (4, 5)))
    ok = np.minimum(one, two) >= need
    for least in np.unique(width[ok]).tolist():
        at = np.flatnonzero(ok & (width == least))
        rows = [_matrix(batch.column(k).take(pa.array(at)).to_pylist(), least) for k in (4, 5)]
        many = [np.bitwise_count(x).sum(1).astype(np.int64) for x in (*rows, rows[0] & rows[1])]
        ok[at] = np.minimum(one[at] - many[0], two[at] - many[1]) + many[2] >= need[at]
    left = pa.array(ok)
    return {name: batch.column(k).filter(left) for k, name in enumerate("ab")} if ok.any() else None


def _tile_pairs(comp: np.ndarray, side: np.ndarray, size: np.ndarray, bits: list[bytes]) -> Iterator[tuple[int, int]]:
    """Pairs of a cell that the bitmaps let through: of different components and, where two tiles meet, one of each."""
    for i, others in _tile_rows(comp, side, size, bits):
        for other in others.tolist():
            yield i, other


def _tile_rows(comp: np.ndarray, side: np.ndarray, size: np.ndarray, bits: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """These pairs, as a row and all its partners."""
    if side.any():
        yield from _band_pairs(comp, np.flatnonzero(side == 0), np.flatnonzero(side), size, bits)
        return
    band = np.floor(np.log(np.maximum(size, 1)) / np.log(BAND_RATIO)).astype(np.int64)
    tiles = {b: np.flatnonzero(band == b) for b in np.unique(band).tolist()}
    for b, own in tiles.items():
        yield from _band_pairs(comp, own, own, size, bits)
        if b + 1 in tiles:
            yield from _band_pairs(comp, own, tiles[b + 1], size, bits)


def _band_pairs(comp: np.ndarray, ones: np.ndarray, others: np.ndarray, size: np.ndarray,
                bits: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of one list with rows of the other, or with later rows of the list if they are the same."""
    met = np.union1d(ones, others)
    own = _matrix([bits[i] for i in met.tolist()])
    rows = np.zeros((len(comp), own.shape[1]), np.uint64)
    rows[met] = own
    many = np.bitwise_count(rows).sum(1).astype(np.int64)
    for place, i in enumerate(ones.tolist()):
        j = ones[place + 1:] if others is ones else others
        need = least_common(size[i], size[j])
        ok = (comp[j] != comp[i]) & (np.minimum(size[i], size[j]) >= need)
        j, need = j[ok], need[ok]
        if not len(j):
            continue
        both = np.bitwise_count(rows[j] & rows[i]).sum(1).astype(np.int64)
        # every bit that only one of the two has set stands for a member that only it has
        bound = np.minimum(size[i] - (many[i] - both), size[j] - (many[j] - both))
        if (bound >= need).any():
            yield i, j[bound >= need]


def _cell_links(tile: pa.Table) -> Iterator[tuple[int, int]]:
    """Links of one cell; nodes that links of the cell have joined are not compared again."""
    sets = list(_sets(tile["text"].combine_chunks() if isinstance(tile["text"], pa.ChunkedArray) else tile["text"]))
    node, comp, side = (tile[c].to_numpy() for c in ("node", "comp", "side"))
    group: dict[int, int] = {}

    def root(c: int) -> int:
        while c in group:
            c = group[c]
        return c

    size = np.array([len(x) for x in sets])
    for i, j in _tile_pairs(comp, side, size, [_signature(x) for x in sets]):
        one, two = root(int(comp[i])), root(int(comp[j]))
        if one != two and _similar(sets[i], sets[j]):
            group[max(one, two)] = min(one, two)
            yield min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (cell's keys, side, node, comp, size, bitmap) those that the bitmaps leave a partner in the cell."""
    for tile in _cells(batches):
        comp, side, size = (tile[c].to_numpy() for c in ("comp", "side", "n"))
        has = np.zeros(len(tile), bool)
        for i, others in _tile_rows(comp, side, size, tile["bits"].to_pylist()):
            has[i] = has[others] = True
        if has.any():
            kept = tile.select(range(8)).filter(pa.array(has)).combine_chunks()
            yield pa.RecordBatch.from_pydict({c: kept[c].chunk(0).cast(pa.int64()) for c in kept.column_names})
    spans.release()


def _cell_work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of cells whose rows have texts."""
    for tile in _cells(batches):
        found = list(_cell_links(tile))
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    spans.release()


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cells of two rows or more in the order of their keys; a cell may go on in the next batch."""
    waiting: list[pa.RecordBatch] = []
    keys: tuple | None = None
    for batch in batches:
        own = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)], 1)
        bounds = np.append(np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(1))), len(own))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if waiting and tuple(own[low]) != keys:
                if sum(map(len, waiting)) > 1:
                    yield pa.Table.from_batches(waiting)
                waiting = []
            keys = tuple(own[low])
            waiting.append(batch.slice(low, high - low))
    if sum(map(len, waiting)) > 1:
        yield pa.Table.from_batches(waiting)


def _rooted(labels: DataFrame) -> DataFrame:
    """(node, comp) with each label replaced by the last that labels of labels lead to; labels are nodes."""
    while True:
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        fresh = cut(labels.join(jump, "comp").select("node", F.col("comp").alias("old"), F.col("further").alias("comp")), "labels")
        drop_stored(labels)
        labels = fresh.select("node", "comp")
        if fresh.filter("comp <> old").isEmpty():
            return labels


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for all nodes of links (a, b): comp is the smallest node that is reachable.

    Every node takes the smallest node around it and then what that leads to; links between different labels are the links of
    the next level, which has at most half the nodes. The smallest node of all keeps its own label on every level.
    """
    edges, levels = cut(links.select("a", "b").distinct(), "edges"), []
    while not levels or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        labels = _rooted(cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels"))
        levels.append(labels)
        ends = [labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}")) for end in "ab"]
        fresh = cut(edges.join(ends[0], "a").join(ends[1], "b").filter("comp_a <> comp_b").select(
            F.least("comp_a", "comp_b").alias("a"), F.greatest("comp_a", "comp_b").alias("b")).distinct(), "edges")
        drop_stored(edges)
        edges = fresh
    found = levels.pop()
    for level in reversed(levels):
        above = found.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        lower = cut(level.join(above, "comp", "left").select("node", F.coalesce("further", "comp").alias("comp")), "labels")
        drop_stored(level)
        drop_stored(found)
        found = lower
    return found


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc, n_shingles and component_id, the smallest id that is reachable by links, its own included.

    Null texts and texts without words have no shingles and stand alone. Null ids are reachable like others but are
    never a component's id while it has another. Repeated rows are copies like any others; an empty table stays empty.
    """
    sets = Sets(docs, doc, text)
    # 1: the first node of each bucket
    bands = sets.nodes.select("node", F.explode("bands").alias("band")).repartition("band")     # dealt once for both sides of the join
    leaders = (bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last").drop("last"))
    stars = bands.join(leaders, "band").filter("a < node").select("a", F.col("node").alias("b")).distinct()
    links = sets.links(stars)
    known = components(links)
    # 2: shingles that different components have
    owned = sets.prefixes().join(known, "node", "left").select("token", "node", F.coalesce("comp", "node").alias("comp"))
    owned = cut(owned, "prefixes")
    # 3: cells
    links = links.union(sets.cell_links(owned))
    known = components(links)
    smallest = (sets.nodes.join(known, "node", "left").groupBy(F.coalesce("comp", "node").alias("comp"))
                .agg(F.min("doc").alias("component_id")))
    own = sets.nodes.join(known, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")).join(smallest, "comp")
    return (sets.summary.join(own.select("node", "component_id"), "node", "left")
            .select("doc", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document by sets of five-word shingles and a similarity of 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")
