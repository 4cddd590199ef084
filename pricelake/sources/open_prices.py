"""Crowd-sourced price records: landed JSON pages, flattened and loaded by watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.dedup import keep_last
from pricelake.schemas import schema
from pricelake.sources.lake import Lake

SOURCE = "open_prices"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All landed pages (one JSON record per line, any number of files) as flat rows."""
    return flatten(spark.read.schema(schema("open_prices_nested")).json(path))


def flatten(records: DataFrame) -> DataFrame:
    """Nine flat columns; a record without its product keeps a null name."""
    columns = schema("open_prices").fieldNames()
    return records.select([
        F.col("product.product_name").alias(c) if c == "product_name" else F.col(c) for c in columns])


def delta(records: DataFrame, watermark: str | None, created: str = "created",
          key: str = "id") -> DataFrame:
    """Records at or after the watermark, each key once.

    The boundary is inclusive, so the records that set the watermark come again; one row per key
    remains within the delta.
    """
    young = records
    if watermark is not None:
        young = records.filter(F.col(created) >= F.lit(watermark))
    return keep_last(young, [key], [created])


def extract(lake: Lake, path: str, load_date: str, batch_id: str | None = None) -> DataFrame | None:
    """Land the records young enough, then advance the watermark; None where there are none.

    Every run lands as a batch of its own, named after the watermark it started from, so repeated runs
    of one day neither lose nor double rows.
    """
    watermark = lake.watermark(SOURCE)
    rows = delta(read_pages(lake.spark, path), watermark)
    newest = rows.agg(F.max("created")).first()[0]
    if newest is None:
        return None
    manifest = lake.land(rows, SOURCE, "prices", load_date,
                         {"watermark": watermark or "", "mode": "incremental"},
                         batch_id or f"from_{(watermark or 'start').replace(':', '')}")
    lake.set_watermark(SOURCE, newest)
    return manifest
