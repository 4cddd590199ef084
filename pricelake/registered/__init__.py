"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelake.registered.entries import ENTRIES, Entry
from pricelake.registered import lake_queries, model_queries, stream_queries  # noqa: F401
from pricelake.registered import serving_queries, warehouse_queries, written_queries  # noqa: F401
from pricelake.sources.trade_feed import feed_of


def _runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return entry.present(entry.plan(feed_of(spark, folder)))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(entry) for name, entry in ENTRIES.items()}


def all_sql() -> dict[str, str]:
    return {name: entry.full_sql() for name, entry in ENTRIES.items() if entry.sql is not None}
