"""The corpus pipeline: documents through five stages, each stored before the next reads it.

Quality classifier, line dedup, near duplicates, benchmark decontamination, and a mix of sources. Each stage takes the
documents that its predecessor kept and the folder of the other tables. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.decontamination import find_windows, n_hit, without_ranges
from pricelake.llm.jaccard_join import near_duplicates
from pricelake.llm.line_dedup import drop_repeated_lines
from pricelake.llm.quality_classifier import keep_good, trained_scorer
from pricelake.llm.source_mix import mix
from pricelake.llm.tables import ready, table
from pricelake.operators.dedup import keep_last
from pricelake.session import cut

REJECTED_BELOW = 0.3    # a document goes only if its quality score is clearly low


def _with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of `docs`, with the text in column `text` of `changed` and n_chars counted again where it is new."""
    fresh = F.col(text)
    columns = []
    for name in docs.columns:
        old = F.col(f"`{name}`")
        if name == "text":
            old = fresh
        elif name == "n_chars":
            old = F.when(fresh.eqNullSafe(F.col("text")), old).otherwise(F.length(fresh).cast(docs.schema[name].dataType))
        columns.append(old.alias(name))
    return changed.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is not clearly low; learned from the labelled ones outside the held-out fold."""
    return keep_good(docs, trained_scorer(spark, sf_dir, docs)(F.col("text")), REJECTED_BELOW)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents have. Null texts stay null."""
    ready(spark)
    kept = drop_repeated_lines(docs, text="text", doc="doc_id")
    kept = kept.withColumn("_kept", F.when(F.col("text").isNotNull(), F.col("_lines.kept")))
    return _with_text(docs, kept, "_kept")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; rows without an id stay if they are
    copies of nothing. Of repeated rows one stays, and of rows with one id and different texts each is judged by its text."""
    ready(spark)
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = near_duplicates(docs)
        first = found.filter(F.col("doc").eqNullSafe(F.col("component_id"))).select(F.col("doc").alias("_doc")).distinct()
        return docs.join(first, docs["doc_id"].eqNullSafe(F.col("_doc")), "left_semi")
    # an id with several rows does not name a text: (id, text) does, and rows without an id come last
    named = docs.withColumn("_named", F.concat(
        F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("~")), F.lit(":"), F.hex(F.xxhash64("text"))))
    found = near_duplicates(named, doc="_named")
    first = found.filter("doc = component_id").select(F.col("doc").alias("_doc")).distinct()
    kept = named.join(first, F.col("_named") == F.col("_doc"), "left_semi")
    return keep_last(kept, ["_named"], ["doc_id"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that stand in any window of ten benchmark words, and what is between these words."""
    found = docs.withColumn("_found", find_windows(F.col("text"), table(spark, sf_dir, "benchmark")))
    cleaned = F.when(n_hit(F.col("_found.ranges")) > 0, without_ranges(F.col("text"), F.col("_found.ranges")))
    return _with_text(docs, found.withColumn("_clean", F.coalesce(cleaned, F.col("text"))), "_clean")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies. Documents without words
    have size 0; a null source is a source of its own."""
    ready(spark)
    return mix(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_copies),
          ("benchmark decontamination", decontaminated), ("source mix", mixed)]

ORACLE_SQL = None   # the classifier and the balanced sampling are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents that come through all stages. An empty table gives an empty mix; further columns of documents
    are carried up to the mix, whatever their names."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
