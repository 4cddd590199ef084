"""Token ids of a corpus in wavelet-matrix files: written in id order, read, counted and searched without decoding.

Rows are dealt by ranges of (id, hash of the text, position), so an id with many rows is spread as well, and sorted inside
each range. A task encodes its texts block by block and writes a shard whenever `SHARD_TOKENS` are together: one row with
the shard's document ids, their lengths and the compressed wavelet matrix of its tokens. Spark's own committer writes the
rows, so a lost or doubled task leaves no half file. Where a shard begins in the corpus is a running sum over the shards'
lengths, and no token passes through it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.llm.tables import by_batch, table
from pricelake.llm.units import byte_level_tokens
from pricelake.llm.wavelet import WaveletMatrix, encode
from pricelake.session import scratch_path

SHARD_TOKENS = 1 << 20
END = 0


def _with_ends(flat: np.ndarray, lengths: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of all documents one after another, each followed by the end id."""
    return np.insert(flat, np.cumsum(lengths), end_id)


def _shards(path: str | None, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = byte_level_tokens(path or public_tokenizers.path("byte_bpe_50k.json"))
        part, shard = TaskContext.get().partitionId(), 0
        ids, lengths, docs = [], [], []

        def closed() -> pa.RecordBatch:
            sizes = np.concatenate(lengths)
            every = pa.concat_arrays(docs)
            whole = pa.array([0, len(every)], pa.int32())
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "n_tokens": pa.array([int(sizes.sum())]), "docs": pa.ListArray.from_arrays(whole, every),
                "lengths": pa.ListArray.from_arrays(whole, pa.array(sizes)),
                "file": pa.array([encode(np.concatenate(ids))], pa.binary())})

        for batch in batches:
            for block in spans.blocks(batch.column(1), min(spans.BLOCK_BYTES, 4 * shard_tokens)):
                flat, each = encoder(block)
                ids.append(_with_ends(flat, each, end_id))
                lengths.append(each + 1)
                docs.append(batch.column(0).slice(block.first, block.last - block.first))
                if sum(map(len, ids)) >= shard_tokens:
                    yield closed()
                    shard, ids, lengths, docs = shard + 1, [], [], []
        if ids:
            yield closed()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, text: str = "text", doc: str = "doc_id",
                 end_id: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of all texts to `folder` in ascending order of `doc` and give the stored shards.

    `path` is a byte-level vocabulary file; without it the installed package's is used, where the work runs. A null or empty
    text is its end id alone. Null ids come first; rows of one id are ordered by their texts, and repeated rows are kept
    each. An empty table gives an empty folder. A document is never cut, so a very long text makes a longer shard. Only the
    two named columns are read.
    """
    kind = docs.schema[doc].dataType.simpleString()
    keys = ["_doc", "_hash", "_tie"]
    narrow = docs.select(F.col(doc).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                         F.xxhash64(F.col(text)).alias("_hash"), F.monotonically_increasing_id().alias("_tie"))
    ordered = narrow.repartitionByRange(*keys).sortWithinPartitions("_doc", "_hash", "_text", "_tie")
    schema = f"part int, shard int, n_tokens long, docs array<{kind}>, lengths array<long>, file binary"
    made = ordered.select("_doc", "_text").mapInArrow(_shards(path, end_id, shard_tokens), schema)
    made.write.option("compression", "none").parquet(folder)
    return read_tokens(docs.sparkSession, folder, kind)


def read_tokens(spark: SparkSession, folder: str, kind: str = "bigint") -> DataFrame:
    """The shards in `folder`; `kind` is the type of document ids."""
    schema = f"part int, shard int, n_tokens long, docs array<{kind}>, lengths array<long>, file binary"
    return spark.read.schema(schema).parquet(folder)


def shard_starts(stored: DataFrame) -> DataFrame:
    """part, shard and how many ids stand before the shard. The second sum has a row for each range only."""
    sizes = stored.select("part", "shard", "n_tokens")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    return sizes.withColumn("_inside", inside).join(before, "part").select(
        "part", "shard", (F.col("_before") + F.col("_inside")).alias("before"))


def _kind(stored: DataFrame) -> str:
    return stored.schema["docs"].dataType.elementType.simpleString()


def documents(stored: DataFrame) -> DataFrame:
    """Every document read back from its shard: doc, start, n_tokens and the crc32 of its little-endian 32-bit ids."""

    def work(batch: pa.RecordBatch) -> dict:
        at, crcs, offsets = [], [], []
        for row in range(batch.num_rows):
            data = memoryview(WaveletMatrix(batch["file"][row].as_py()).decode().astype("<u4").tobytes())
            sizes = batch["lengths"][row].values.to_numpy()
            ends = np.cumsum(sizes)
            at.append(np.full(len(sizes), row))
            offsets.append(ends - sizes)
            crcs += [zlib.crc32(data[4 * (end - size):4 * end]) for size, end in zip(sizes.tolist(), ends.tolist(), strict=True)]
        rows = pa.array(np.concatenate(at))
        return {"part": batch["part"].take(rows), "shard": batch["shard"].take(rows), "doc": batch["docs"].flatten(),
                "offset": pa.array(np.concatenate(offsets)), "n_tokens": batch["lengths"].flatten(),
                "ids_crc32": pa.array(crcs, pa.int64())}

    read = by_batch(stored.select("part", "shard", "docs", "lengths", "file"),
                    f"part int, shard int, doc {_kind(stored)}, offset long, n_tokens long, ids_crc32 long", work)
    return read.join(shard_starts(stored), ["part", "shard"]).select(
        "doc", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_counts(stored: DataFrame, tokens: list[int]) -> DataFrame:
    """token and n for each of a given list of ids, from two ranks a level and shard; ids never seen have 0."""

    def work(batch: pa.RecordBatch) -> dict:
        counts = np.zeros(len(tokens), np.int64)
        for blob in batch["file"]:
            matrix = WaveletMatrix(blob.as_py())
            counts += [matrix.count(token) for token in tokens]
        return {"token": pa.array(tokens, pa.int64()), "n": pa.array(counts)}

    every = stored.sparkSession.createDataFrame([(t,) for t in sorted(set(tokens))], "token long")
    found = by_batch(stored.select("file"), "token long, n long", work).groupBy("token").agg(F.sum("n").alias("n"))
    return every.join(found, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def occurrences(stored: DataFrame, tokens: list[int]) -> DataFrame:
    """doc, token and place inside the document for every occurrence of the given ids."""

    def work(batch: pa.RecordBatch) -> dict:
        made = {"doc": [], "token": [], "place": []}
        for row in range(batch.num_rows):
            matrix, docs = WaveletMatrix(batch["file"][row].as_py()), batch["docs"][row].values
            ends = np.cumsum(batch["lengths"][row].values.to_numpy())
            for token in tokens:
                at = matrix.occurrences(token)
                owner = np.searchsorted(ends, at, "right")
                made["doc"].append(docs.take(pa.array(owner)))
                made["token"].append(np.full(len(at), token))
                made["place"].append(at - np.append(0, ends)[owner])
        return {"doc": pa.concat_arrays(made["doc"]), "token": pa.array(np.concatenate(made["token"]), pa.int64()),
                "place": pa.array(np.concatenate(made["place"]), pa.int64())}

    if not tokens:
        raise ValueError("no token asked for")
    return by_batch(stored.select("docs", "lengths", "file"), f"doc {_kind(stored)}, token long, place long", work)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all whole texts to wavelet-matrix files in the shared folder and reads the documents back."""
    docs = table(spark, sf_dir, "documents")
    stored = write_tokens(docs, scratch_path(spark, "token-files"))
    return documents(stored).withColumnRenamed("doc", "doc_id")
