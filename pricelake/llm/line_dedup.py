"""Line dedup with two Bloom filters.

1. Every task hashes the lines of its documents (128 bits) and keeps the places of their bits in a once-seen filter of 2^34
   bits; bits that it meets in a second document are in a twice-seen filter as well. Filters come in shards, whose set bits
   are listed while they are few, so a task holds its own lines and never a whole filter. Shards merge as
   (a1 or b1, a2 or b2 or (a1 and b1)), a bounded number of them at a time.
2. The merged twice-seen filter is folded to 32 bits for each of its set bits, 2^30 at most, and goes to all tasks. A line not
   in it occurs in one document only. The others are suspects: one row for each suspect and task, with its text, its
   number of documents and its first occurrence, is shuffled, so hot lines are counted before the shuffle. The exact
   counts give the repeated lines.
3. Lines are dropped where they stand. Repeated lines are broadcast as hashes if they are at most `BROADCAST_LINES`;
   beyond that the suspects' hashes are joined with them and come back to each document.

A fuller filter only makes more suspects, never another result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import by_batch, table
from pricelake.session import cut

SHARDS, SHARD_BITS = 256, 1 << 26   # the once-seen filter has 2^34 bits, of which only the set ones are stored
FOLDED_BITS = 1 << 22               # a shard of the twice-seen filter has no more after folding: 128 MB in all
SPARE = 32                          # bits of the folded filter for each set one
FAN_IN = 16                         # filters of one shard that one task merges
HELD = 1 << 21                      # places that a task gathers before it sorts them in
BROADCAST_LINES = 1 << 19           # 16 bytes each
MIN_DOCUMENTS = 10


class Lines:
    """The lines of a block: extent, trimmed extent, key hashes, and the first line of each row (one more)."""

    def __init__(self, block: spans.Block):
        self.block = block
        self.starts, self.ends, self.firsts = spans.lines(block)
        self.key_starts, self.key_ends = spans.trimmed(block.data, self.starts, self.ends)
        self.some = self.key_ends > self.key_starts
        self.one = spans.hashes(block.data, self.key_starts, self.key_ends, spans.LOWER, 0)
        self.two = spans.hashes(block.data, self.key_starts, self.key_ends, spans.LOWER, 1)
        self.rows = spans.rows_of(self.firsts)

    def per_document(self) -> np.ndarray:
        """One line of each key of a row, blank lines left out."""
        at = np.flatnonzero(self.some)
        order = at[np.lexsort((at, self.two[at], self.one[at], self.rows[at]))]
        new = np.ones(len(order), bool)
        new[1:] = ((self.rows[order][1:] != self.rows[order][:-1]) | (self.one[order][1:] != self.one[order][:-1])
                   | (self.two[order][1:] != self.two[order][:-1]))
        return order[new]

    def key(self, line: int) -> str:
        return spans.LOWER[self.block.data[self.key_starts[line]:self.key_ends[line]]].tobytes().decode()


def places(one: np.ndarray, two: np.ndarray, shard_bits: int = SHARD_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a key, in one shard. Fewer bits a shard fold the places of more."""
    shard = (one >> np.uint64(56)).astype(np.int64) * shard_bits
    mask = np.uint64(shard_bits - 1)
    return shard + (one & mask).astype(np.int64), shard + (two & mask).astype(np.int64)


def _packed(bits: np.ndarray) -> bytes:
    """Set bits of one shard: their places if they are few, else a bitmap."""
    if len(bits) * 32 < SHARD_BITS:
        return bits.astype(np.uint32).tobytes()
    mask = np.zeros(SHARD_BITS, bool)
    mask[bits] = True
    return np.packbits(mask).tobytes()


def _unpacked(stored: bytes) -> np.ndarray:
    if len(stored) * 8 >= SHARD_BITS:
        return np.flatnonzero(np.unpackbits(np.frombuffer(stored, np.uint8)))
    return np.frombuffer(stored, np.uint32).astype(np.int64)


def _joined(once: list[np.ndarray], twice: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places set in any of `once`; places in any of `twice` or more than once in `once`."""
    every, counts = np.unique(np.concatenate(once), return_counts=True)
    return every, np.unique(np.concatenate([every[counts > 1], *twice]))


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    once, twice, held = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for batch in batches:
        for block in spans.blocks(batch.column(0)):
            found = Lines(block)
            at = found.per_document()
            a, b = places(found.one[at], found.two[at])
            held += [a, b[a != b]]
            if sum(map(len, held)) > max(HELD, len(once)):
                once, twice = _joined([once, *held], [twice])
                held = []
    once, twice = _joined([once, *held], [twice])
    edges = np.arange(SHARDS + 1) * SHARD_BITS
    edges_once, edges_twice = np.searchsorted(once, edges), np.searchsorted(twice, edges)
    rows = [(shard, _packed(once[edges_once[shard]:edges_once[shard + 1]] - edges[shard]),
             _packed(twice[edges_twice[shard]:edges_twice[shard + 1]] - edges[shard]))
            for shard in np.flatnonzero(np.diff(edges_once)).tolist()]
    if rows:
        yield pa.RecordBatch.from_pydict({"shard": pa.array([r[0] for r in rows], pa.int32()),
                                          "once": pa.array([r[1] for r in rows], pa.binary()),
                                          "twice": pa.array([r[2] for r in rows], pa.binary())})
    del once, twice, rows
    spans.release()


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    once, twice = _joined([_unpacked(x) for x in rows["once"]], [_unpacked(x) for x in rows["twice"]])
    made = pd.DataFrame({"shard": [rows["shard"].iloc[0]], "once": [_packed(once)], "twice": [_packed(twice)]})
    del once, twice
    spans.release()
    return made


def _merged_twice(rows: pd.DataFrame) -> pd.DataFrame:
    made = _merged(rows)[["shard", "twice"]]
    return made.assign(n=[len(_unpacked(x)) for x in made["twice"]])


def twice_seen(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """The merged and folded twice-seen filter as a bitmap, and the number of bits of each of its shards."""
    schema = "shard int, once binary, twice binary"
    filters = cut(docs.select(F.coalesce(text, F.lit(""))).mapInArrow(_filters, schema), "line-filters")
    most = filters.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    while most > FAN_IN:
        groups = -(-most // FAN_IN)
        filters = filters.withColumn("part", F.pmod(F.xxhash64("once", "twice"), F.lit(groups)))
        filters = cut(filters.groupBy("shard", "part").applyInPandas(_merged, schema), "line-filters")
        most = filters.groupBy("shard").count().agg(F.max("count")).first()[0]
    merged = cut(filters.groupBy("shard").applyInPandas(_merged_twice, "shard int, twice binary, n long"), "twice-seen")
    most_set = merged.agg(F.max("n")).first()[0] or 0
    shard_bits = min(max(1 << (SPARE * most_set - 1).bit_length(), 1 << 12), FOLDED_BITS) if most_set else 1 << 12
    whole = np.zeros((SHARDS, shard_bits // 8), np.uint8)
    for row in merged.select("shard", "twice").toLocalIterator():
        mask = np.zeros(shard_bits, bool)
        mask[_unpacked(row.twice) & (shard_bits - 1)] = True
        whole[row.shard] = np.packbits(mask)
    return whole.reshape(-1), shard_bits


def suspects(docs: DataFrame, text: str, doc: str, shared: Broadcast, shard_bits: int) -> DataFrame:
    """For each block of documents and line that may occur elsewhere: its key and hashes, in how many of the block's
    documents it is, and its first occurrence there. `shared` is the twice-seen filter."""

    def work(batch: pa.RecordBatch) -> dict | None:
        bits, ids = shared.value, batch.column(0)
        made = defaultdict(list)
        for block in spans.blocks(batch.column(1)):
            found = Lines(block)
            at = found.per_document()
            a, b = places(found.one[at], found.two[at], shard_bits)
            at = at[(bits[a >> 3] >> (7 - (a & 7)) & bits[b >> 3] >> (7 - (b & 7)) & 1).astype(bool)]
            # of a key's occurrences the one with the smallest id, and then line, leads
            ranks = pc.rank(ids.slice(block.first, block.last - block.first), "ascending", null_placement="at_start",
                            tiebreaker="dense").to_numpy()
            place = at - found.firsts[found.rows[at]]
            at = at[np.lexsort((place, ranks[found.rows[at]], found.two[at], found.one[at]))]
            new = np.ones(len(at), bool)
            new[1:] = (found.one[at][1:] != found.one[at][:-1]) | (found.two[at][1:] != found.two[at][:-1])
            first = np.flatnonzero(new)
            made["n_docs"].append(np.diff(np.append(first, len(at))))
            lead = at[first]
            made["one"].append(found.one[lead].view(np.int64))
            made["two"].append(found.two[lead].view(np.int64))
            made["line"].append(lead - found.firsts[found.rows[lead]])
            made["at"].append(found.rows[lead] + block.first)
            made["key"] += [found.key(line) for line in lead]
        if not made["key"]:
            return None
        column = {name: np.concatenate(made[name]) for name in ("n_docs", "one", "two", "line", "at")}
        return {"key": pa.array(made["key"], pa.string()), "one": pa.array(column["one"]),
                "two": pa.array(column["two"]), "n_docs": pa.array(column["n_docs"], pa.int64()),
                "first_doc": ids.take(pa.array(column["at"])), "first_line": pa.array(column["line"], pa.int64())}

    kind = docs.schema[doc].dataType.simpleString()
    return by_batch(docs.select(doc, F.coalesce(text, F.lit("")).alias("_text")),
                    f"key string, one long, two long, n_docs long, first_doc {kind}, first_line long", work)


def repeated_lines(docs: DataFrame, text: str, doc: str, least: int) -> DataFrame:
    """Lines found in at least `least` documents (2 or more): hashes, document count, first occurrence."""
    if least < 2:
        raise ValueError("a repeated line is in two documents at least")
    twice, shard_bits = twice_seen(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(twice)
    found = suspects(docs, text, doc, shared, shard_bits)
    lines = cut(found.groupBy("key", "one", "two")
               .agg(F.sum("n_docs").alias("n_docs"), F.min(F.struct("first_doc", "first_line")).alias("first"))
               .filter(F.col("n_docs") >= least)
               .select("one", "two", "n_docs", "first.first_doc", "first.first_line"), "repeated-lines")
    shared.unpersist()
    return lines


def _dropped(found: Lines, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each line, the place of its key in the sorted hashes, or -1."""
    where = np.full(len(found.starts), -1, np.int64)
    if len(one):
        at = np.searchsorted(one, found.one)
        for step in (0, 1):  # two keys may share the first hash
            near = np.minimum(at + step, len(one) - 1)
            where = np.where(found.some & (one[near] == found.one) & (two[near] == found.two), near, where)
    return where


def _without(found: Lines, drop: np.ndarray, row: int) -> str:
    lines = range(found.firsts[row], found.firsts[row + 1])
    data = found.block.data
    return b"\n".join(data[found.starts[i]:found.ends[i]].tobytes() for i in lines if not drop[i]).decode()


RESULT = "n_lines long, n_dropped long, kept string"


def _rewritten(values: pa.Array, chosen: Callable[[Lines, int], np.ndarray]) -> pa.Array:
    n_lines, n_dropped, kept = [], [], []
    for block in spans.blocks(values):
        found = Lines(block)
        drop = chosen(found, block.first)
        n_lines.append(np.diff(found.firsts))
        n_dropped.append(spans.row_sums(drop.astype(np.int64), found.firsts))
        whole = values.slice(block.first, block.last - block.first)
        kept += [_without(found, drop, row) if n_dropped[-1][row] else whole[row].as_py() or ""
                 for row in range(block.last - block.first)]
        del found, drop
    spans.release()
    return pa.StructArray.from_arrays([pa.array(np.concatenate(n_lines)), pa.array(np.concatenate(n_dropped)),
                                       pa.array(kept, pa.string())], ["n_lines", "n_dropped", "kept"])


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc: str = "doc_id", least: int = MIN_DOCUMENTS,
                        keep_first: bool = False, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """`docs` with one column more, `_lines`: n_lines before dropping, n_dropped, and `kept`, the text that stays.

    A line's key is the line without white space at its ends and with A-Z lower-cased; blank lines have none and
    stay. Keys in at least `least` documents (rows; a row counts once, repeated rows count each) lose all lines, or,
    with `keep_first`, all but the one with the smallest id and line number. Null and empty texts are one empty line.
    A column named `_lines` is replaced.
    """
    lines = repeated_lines(docs, text, doc, least)
    docs = docs.drop("_lines")
    if lines.count() <= broadcast_lines:
        stored = lines.toArrow()
        one = stored["one"].to_numpy().view(np.uint64)
        two = stored["two"].to_numpy().view(np.uint64)
        order = np.lexsort((two, one))
        firsts = stored.take(pa.array(order)).select(["first_doc", "first_line"]).to_pylist() if keep_first else None
        shared = docs.sparkSession.sparkContext.broadcast((one[order], two[order], firsts))

        @F.arrow_udf(RESULT)
        def rewritten(ids: pa.Array, values: pa.Array) -> pa.Array:
            one_, two_, firsts_ = shared.value

            def chosen(found: Lines, row: int) -> np.ndarray:
                where = _dropped(found, one_, two_)
                drop = where >= 0
                for i in np.flatnonzero(drop) if firsts_ else ():
                    first = firsts_[where[i]]
                    drop[i] = (first["first_line"] != i - found.firsts[found.rows[i]]
                               or first["first_doc"] != ids[row + int(found.rows[i])].as_py())
                return drop

            return _rewritten(values, chosen)

        return docs.withColumn("_lines", rewritten(F.col(doc), F.col(text)))
    return _by_join(docs, text, doc, lines, keep_first)


def _by_join(docs: DataFrame, text: str, doc: str, lines: DataFrame, keep_first: bool) -> DataFrame:
    """The same where the repeated lines are too many to broadcast: each document gets its own by a join on its id."""

    def work(batch: pa.RecordBatch) -> dict:
        ids, one, two = [], [], []
        for block in spans.blocks(batch.column(1)):
            found = Lines(block)
            at = found.per_document()
            ids.append(found.rows[at] + block.first)
            one.append(found.one[at].view(np.int64))
            two.append(found.two[at].view(np.int64))
        return {"_doc": batch.column(0).take(pa.array(np.concatenate(ids))), "one": pa.array(np.concatenate(one)),
                "two": pa.array(np.concatenate(two))}

    kind = docs.schema[doc].dataType.simpleString()
    held = by_batch(docs.select(doc, F.coalesce(text, F.lit("")).alias("_text")), f"_doc {kind}, one long, two long",
                    work)
    own = (held.join(lines, ["one", "two"]).groupBy("_doc")
           .agg(F.collect_set(F.struct("one", "two", "first_doc", "first_line")).alias("_own")))

    @F.arrow_udf(RESULT)
    def rewritten(ids: pa.Array, values: pa.Array, own_lines: pa.Array) -> pa.Array:
        known = [{(x["one"], x["two"]): (x["first_doc"], x["first_line"]) for x in row.as_py() or ()}
                 for row in own_lines]

        def chosen(found: Lines, row: int) -> np.ndarray:
            drop = np.zeros(len(found.starts), bool)
            for i in np.flatnonzero(found.some):
                first = known[row + found.rows[i]].get((int(found.one[i].view(np.int64)), int(found.two[i].view(np.int64))))
                drop[i] = first is not None and not (
                    keep_first and first == (ids[row + int(found.rows[i])].as_py(), i - found.firsts[found.rows[i]]))
            return drop

        return _rewritten(values, chosen)

    joined = docs.join(own, docs[doc].eqNullSafe(own["_doc"]), "left")
    return joined.withColumn("_lines", rewritten(F.col(doc), F.col(text), F.col("_own"))).drop("_doc", "_own")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in ten or more documents go; counts and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "_lines.n_lines", "_lines.n_dropped",
                                            F.sha2("_lines.kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (SELECT r, i, line, translate(
    regexp_replace(regexp_replace(line, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
repeated AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
stays AS (SELECT k.r, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
    FROM keyed k WHERE key NOT IN (SELECT key FROM repeated) GROUP BY k.r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN stays USING (r)
"""
