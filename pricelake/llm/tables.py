"""What the queries of this subpackage share: reading tables, folds, Arrow columns and batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import spans
from pricelake.packaging import ship

BATCH_BYTES = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPACE_WORD = "[^\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """The session with this package on its executors. Texts may be long, so Arrow batches end by bytes and not only by rows;
    a smaller size set by the user stays."""
    if spark.conf.get(BATCH_SETTING, None) in (None, "2147483647", "2147483647b"):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def in_fold(doc_id: Column, parts: int, chosen: int) -> Column:
    """Whether the id is in the chosen fold; false for a null id."""
    return F.coalesce(fold(doc_id, parts) == chosen, F.lit(False))


def arrow_struct(text: Column, schema: str, work: Callable[[pa.Array], dict[str, pa.Array]]) -> Column:
    """A struct column made from a string column, an Arrow batch at a time."""

    @F.arrow_udf(schema)
    def made(values: pa.Array) -> pa.Array:
        fields = work(values)
        spans.release()
        return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))

    return made(text)


def by_batch(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """Apply `work` to each Arrow batch; it returns the columns as a dict in the schema's order, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (made := work(batch)) is not None:
                yield pa.RecordBatch.from_pydict(made)
        spans.release()

    return df.mapInArrow(run, schema)
