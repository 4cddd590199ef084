"""The batch catalog source: header CSV files per dataset, landed raw."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import dates
from pricelake.schemas import schema
from pricelake.sources.lake import Lake

SOURCE = "retail_catalog"
DATASETS = ("products", "price_facts", "time")


def row_position() -> Column:
    """Where a row stands in a dataset of several files: file by path, part of the file, place in that part.

    Spark reads large files first, so a running number alone does not follow the files' order.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_csv(spark: SparkSession, path: str, dataset: str, position: str | None = None) -> DataFrame:
    """One dataset with its explicit schema, columns matched by header; a missing file raises.

    `position` names a further column that orders the rows as they stand in the files.
    """
    more = [row_position().alias(position)] if position else []
    declared = schema(dataset)
    header = spark.read.option("header", True).csv(path).columns
    by_name = {f.name: f for f in declared.fields}
    ordered = type(declared)([by_name[c] for c in header if c in by_name])
    unknown = [c for c in header if c not in by_name]
    if unknown:  # extra columns: read all as text, keep the declared ones
        text = spark.read.option("header", True).csv(path)
        return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ordered.fields], *more)
    return spark.read.option("header", True).schema(ordered).csv(path).select("*", *more)


def rebase_dates(time: DataFrame, as_of: dt.date) -> DataFrame:
    """Shift all days so that the newest becomes the day before `as_of`; days come out as text."""
    days = time.withColumn("full_date", dates.day_of(F.col("full_date")))
    newest = days.agg(F.max("full_date").alias("d"))
    shift = F.datediff(F.date_sub(F.lit(as_of), 1), newest.scalar())
    return days.withColumn("full_date",
                           F.date_format(F.date_add("full_date", shift), "yyyy-MM-dd"))


def extract(lake: Lake, folder: str, load_date: str, rebase_to: dt.date | None = None,
            file_names: dict[str, str] | None = None) -> list[DataFrame]:
    """Land every dataset of `folder` raw; returns the manifests.

    `rebase_to` re-dates a bundled sample so that its history ends the day before; leave it out for
    real deliveries. `file_names` maps datasets to file names where they differ from `<dataset>.csv`.
    """
    names = {d: f"{d}.csv" for d in DATASETS} | (file_names or {})
    manifests = []
    for dataset in DATASETS:
        path = f"{folder.rstrip('/')}/{names[dataset]}"
        frame = read_csv(lake.spark, path, dataset, "_ordinal")
        if dataset == "time" and rebase_to is not None:
            frame = rebase_dates(frame, rebase_to)
        manifests.append(lake.land(frame, SOURCE, dataset, load_date,
                                   {"origin": path, "mode": "batch"}))
    return manifests
