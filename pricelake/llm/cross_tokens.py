"""Alignment of two tokenizers' token sequences over the same bytes, as an Arrow pipeline merged by Spark.

In a task, a block of texts becomes two flat token columns: list arrays are flattened, parent indices give each token its
document, and cumulative sums of token lengths, less those at the document's start, give each token its end. An Acero hash
join on (document, end) finds the places where tokens of both sides end; these cut the document into groups, and the two
tokens that end there are linked. Table.group_by counts the linked id pairs of the block. Spark adds up the blocks' partial
counts, finds for each id of the second side its highest count, and brings each block the counts of its own pairs, so
neither the pairs of a document nor a frequent pair's occurrences are ever shuffled one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import table
from pricelake.llm.units import Distinct, byte_level, byte_level_bytes, piece_bytes, pieces
from pricelake.session import cut

BLOCK_BYTES = 1 << 20   # of text; its tokens, joins and counts take about a hundred times as much memory
COUNTED = "block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<int>, times array<int>"
PARTIAL = "a array<int>, b array<int>, n array<long>"


class Side:
    """One tokenizer: ids of stretches, and the bytes of each id."""

    def __init__(self, encoder, entries: list[bytes]):
        self.encoder, self.entries = encoder, pa.array(entries, pa.large_binary())
        self.lengths = pa.array(np.array([len(e) for e in entries], np.int64))
        self.last_of_group = len(entries)   # rendered ids: first those inside a group, then those that end one

    def lists(self, distinct: Distinct) -> tuple[pa.ListArray, np.ndarray]:
        """The ids of each distinct stretch, and whether their bytes are the stretch's."""
        lists = self.encoder(distinct.found)
        ids, firsts = lists.flatten(), lists.offsets.to_numpy()
        same = spans.row_sums(self.lengths.take(ids).to_numpy(), firsts) == distinct.sizes
        chosen = ids.filter(pa.array(np.repeat(same, np.diff(firsts))))
        made = np.frombuffer(self.entries.take(chosen).buffers()[2] or b"", np.uint8)
        given = np.frombuffer(b"".join([s for s, ok in zip(distinct.found, same.tolist(), strict=True) if ok]), np.uint8)
        wrong = np.flatnonzero(made != given)
        owner = np.searchsorted(np.cumsum(distinct.sizes[same]), wrong, "right")
        same[np.flatnonzero(same)[owner]] = False
        return lists, same


@cache
def sides(path_a: str | None, path_b: str | None) -> tuple[Side, Side, pa.Array]:
    """Both sides, and every id rendered for the groups' text: a side's id and ",", or "|" and ";" after a group's last."""
    import public_tokenizers

    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    a = Side(byte_level(path_a), byte_level_bytes(path_a))
    b = Side(pieces(path_b), piece_bytes(path_b))
    rendered = [f"{i}{mark}" for side, last in ((a, "|"), (b, ";")) for mark in (",", last)
                for i in range(len(side.entries))]
    return a, b, pa.array(rendered, pa.large_string())


def tokens(lists: pa.ListArray, which: np.ndarray, document: np.ndarray, lengths: pa.Array) -> pa.Table:
    """All tokens of the stretches `which`: document, end within it, id and place in the block."""
    taken = lists.take(pa.array(which))
    ids = pc.list_flatten(taken)
    doc = pc.take(pa.array(document), pc.list_parent_indices(taken))
    ends = pc.cumulative_sum(pc.take(lengths, ids))
    parents = doc.to_numpy(zero_copy_only=False)
    new = np.flatnonzero(np.diff(parents, prepend=-1))      # a segmented sum starts again at each document
    before = np.zeros(len(new), np.int64)
    if len(new) > 1:
        before[1:] = ends.to_numpy(zero_copy_only=False)[new[1:] - 1]
    base = np.repeat(before, np.diff(np.append(new, len(parents))))
    return pa.table({"doc": doc, "end": pc.subtract(ends, pa.array(base)), "id": ids,
                     "at": pa.array(np.arange(len(parents)))})


class Aligned:
    """One block: its tokens on both sides, the links in order, and the number of each per document."""

    def __init__(self, block: spans.Block, a: Side, b: Side):
        self.rows = len(block.offsets) - 1
        distinct = Distinct(block)
        lists_a, same_a = a.lists(distinct)
        lists_b, same_b = b.lists(distinct)
        owner = spans.rows_of(distinct.firsts)
        whole = np.ones(self.rows, bool)
        whole[owner[~(same_a & same_b)[distinct.which]]] = False
        keep = whole[owner]
        which, owner = distinct.which[keep], owner[keep]
        left = tokens(lists_a, which, owner, a.lengths).rename_columns(["doc", "end", "a", "at_a"])
        right = tokens(lists_b, which, owner, b.lengths).rename_columns(["doc", "end", "b", "at_b"])
        self.links = left.join(right, ["doc", "end"], join_type="inner", use_threads=False).sort_by("at_a")
        self.a, self.b = left["a"].to_numpy(), right["b"].to_numpy()
        self.n_a, self.n_b, self.n_links = (self._each(t["doc"]) for t in (left, right, self.links))

    def _each(self, documents: pa.ChunkedArray) -> np.ndarray:
        return np.bincount(documents.to_numpy(), minlength=self.rows)

    def group_bytes(self, rendered: pa.Array, a: Side, b: Side) -> Iterator[bytes]:
        """The text of each document's groups, `a1,a2|b1;a3|b2,b3`; empty without tokens."""
        last_a, last_b = self.links["at_a"].to_numpy(), self.links["at_b"].to_numpy()
        group_a = np.searchsorted(last_a, np.arange(len(self.a)))
        group_b = np.searchsorted(last_b, np.arange(len(self.b)))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        # a token comes after all tokens of earlier groups on both sides, and one of the second side after its group's first
        at_a = np.arange(len(self.a)) + np.append(0, last_b + 1)[group_a]
        at_b = np.arange(len(self.b)) + (last_a + 1)[group_b] if len(last_a) else np.zeros(0, np.int64)
        ends_a, ends_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        ends_a[last_a] = ends_b[last_b] = True
        code[at_a] = self.a + a.last_of_group * ends_a
        code[at_b] = self.b + b.last_of_group * ends_b + 2 * a.last_of_group
        text = rendered.take(pa.array(code))
        places = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
        data = memoryview(text.buffers()[2] or b"")
        edges = places[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield data[low:high - 1] if high > low else b""

    def pairs(self) -> pa.Table:
        """The linked id pairs of the block: a, b, n."""
        return self.links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "n"])

    def per_document(self, pairs: pa.Table) -> tuple[pa.Array, pa.Array]:
        """For each document its pairs, as places in `pairs`, and how often it has each."""
        numbered = pairs.select(["a", "b"]).append_column("pair", pa.array(np.arange(len(pairs), dtype=np.int32)))
        own = (self.links.select(["doc", "a", "b"]).join(numbered, ["a", "b"], join_type="inner", use_threads=False)
               .group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
               .sort_by([("doc", "ascending"), ("pair", "ascending")]))
        places = np.concatenate([[0], np.cumsum(self._each(own["doc"]))]).astype(np.int32)
        return tuple(pa.ListArray.from_arrays(pa.array(places), own[name].combine_chunks().cast(pa.int32()))
                     for name in ("pair", "count_all"))


def _counted(path_a: str | None, path_b: str | None, key_type: pa.DataType):
    """Rows of documents, and after those of each block one row with the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, rendered = sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
            for block in spans.blocks(spaced, BLOCK_BYTES):
                found = Aligned(block, a, b)
                pairs = found.pairs()
                pair, times = found.per_document(pairs)
                digests = [hashlib.sha256(g).hexdigest() if len(g) else "" for g in found.group_bytes(rendered, a, b)]
                rows, nothing = found.rows, pa.nulls(found.rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict({
                    "_doc": batch.column(0).slice(block.first, rows), "block": pa.array(np.full(rows, number)),
                    "n_a": pa.array(found.n_a), "n_b": pa.array(found.n_b), "n_groups": pa.array(found.n_links),
                    "n_links": pa.array(found.n_links), "groups_sha256": pa.array(digests, pa.string()),
                    "pair": pair, "times": times, "a": nothing, "b": nothing, "n": pa.nulls(rows, pa.list_(pa.int64()))})
                yield pa.RecordBatch.from_pydict({
                    "_doc": pa.nulls(1, key_type), "block": pa.array([number]),
                    **{name: pa.nulls(1, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")},
                    "groups_sha256": pa.nulls(1, pa.string()), "pair": pa.nulls(1, pa.list_(pa.int32())),
                    "times": pa.nulls(1, pa.list_(pa.int32())),
                    **{name: pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs[name].combine_chunks())
                       for name in ("a", "b", "n")}})
                number += 1

    return run


def _summed(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one block with the corpus-wide counts of the block's pairs."""
    documents = documents.combine_chunks()
    order = pc.sort_indices(counts["pos"])
    total, best = counts["total"].take(order), counts["is_best"].take(order)
    lists = documents["pair"].chunk(0)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    times = pc.list_flatten(documents["times"].chunk(0)).cast(pa.int64())
    sums = pa.table({"row": parents, "n_best": pc.multiply(times, best.take(flat).cast(pa.int64())),
                     "count_sum": pc.multiply(times, total.take(flat))}) \
        .group_by("row", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
    found = {"n_best": np.zeros(len(documents), np.int64), "count_sum": np.zeros(len(documents), np.int64)}
    for name, values in found.items():
        values[sums["row"].to_numpy()] = sums[f"{name}_sum"].to_numpy()
    for name, values in found.items():
        documents = documents.append_column(name, pa.array(values))
    return documents.drop_columns(["block", "pair", "times"])


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text: str = "text",
            doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """How a byte-level vocabulary file (a) and a piece model (b) cut each text, and the linked id pairs of all texts.

    Without paths the files are those of the installed vocabulary package, looked up where the work runs.

    The first result has a row a document: `doc`, n_a and n_b tokens, n_groups, n_links, n_best (links whose pair is as
    frequent as any of its b id), count_sum (over links, the frequency of the pair) and groups_sha256. The second has a, b,
    total and is_best. A space precedes every text, since b puts one there. Texts that are null or empty, or that one
    side does not give back byte by byte, have no tokens: zeros and an empty digest. Repeated rows count each; equal
    counts are all the best; an empty table gives empty results; only the two named columns are read, so others may
    have any name. A text is one row in a block however long it is.
    """
    kind = docs.schema[doc].dataType
    narrow = docs.select(F.col(doc).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    key_type = pa.int64() if kind.simpleString() == "bigint" else narrow.select("_doc").limit(0).toArrow().schema.types[0]
    stored = cut(narrow.mapInArrow(_counted(path_a, path_b, key_type), f"_doc {kind.simpleString()}, {COUNTED}, {PARTIAL}"),
                 "aligned-blocks")
    partial = (stored.filter(F.col("a").isNotNull())
               .select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pos", "p"))
               .select("block", "pos", "p.a", "p.b", "p.n"))
    totals = cut(partial.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    totals = cut(totals.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("is_best")),
                 "pair-best")
    counts = partial.join(totals, ["a", "b"]).select(F.col("block").alias("_block"), "pos", "total", "is_best")
    documents = stored.filter(F.col("pair").isNotNull()).drop("a", "b", "n")
    schema = (f"_doc {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "n_best long, count_sum long")
    found = documents.groupBy("block").cogroup(counts.groupBy("_block")).applyInArrow(_summed, schema)
    return found.withColumnRenamed("_doc", doc), totals


def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level pairs against pieces over every whole text."""
    found, _ = aligned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
