"""The layered lake: paths, readers, idempotent writers, manifests, state and run journal.

Parquet only. Every write is repeatable: it replaces exactly the partitions it brings, or appends one
immutable row set. Row counts come from an observation on the write itself, not from a second pass.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import dates
from pricelake.operators.checks import CheckFailed
from pricelake.schemas import schema

LAYERS = ("raw", "bronze", "silver", "gold", "warehouse", "state")


def schema_fingerprint(df: DataFrame) -> str:
    """The first half of the MD5 digest of the columns as DDL, a line each, in the order of their names."""
    columns = sorted(f"`{field.name}` {field.dataType.simpleString().upper()}" for field in df.schema)
    return hashlib.md5("\n".join(columns).encode(), usedforsecurity=False).hexdigest()[:16]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


@dataclass(frozen=True)
class Lake:
    """A lake below `root`, any folder or object-store URI Hadoop can reach."""

    spark: SparkSession
    root: str

    # ---- paths and readers ----
    def path(self, layer: str, *parts: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown lake layer {layer!r}; expected one of {LAYERS}")
        return "/".join([self.root.rstrip("/"), layer, *parts])

    def _located(self, layer: str, *parts: str):
        """Path and file system, as Hadoop has them."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(layer, *parts))
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, layer: str, *parts: str) -> bool:
        target, system = self._located(layer, *parts)
        return system.exists(target)

    def remove(self, layer: str, *parts: str) -> None:
        """Remove one dataset or partition; nothing happens where there is none."""
        if not parts:
            raise ValueError("a whole layer is never removed")
        target, system = self._located(layer, *parts)
        system.delete(target, True)

    def read(self, layer: str, *parts: str) -> DataFrame:
        """A dataset of the lake, lazily. Hive partitions become columns, and filters on them prune."""
        return self.spark.read.parquet(self.path(layer, *parts))

    # ---- writers ----
    def write(self, df: DataFrame, layer: str, *parts: str, partition_by: list[str] | None = None,
              mode: str = "overwrite") -> int:
        """Write a dataset and return its row count.

        With `partition_by`, overwriting replaces only the partitions present in `df`.
        """
        counted = Observation()
        writer = (
            df.observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.mode(mode).option("compression", "zstd"))
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(layer, *parts))
        return counted.get["rows"]

    def land(self, df: DataFrame, source: str, dataset: str, load_date: str,
             params: dict[str, str] | None = None, batch_id: str = "0") -> DataFrame:
        """Land one immutable batch raw and record its manifest; returns the one-row manifest.

        Landing the same batch of the same day again replaces that batch and nothing else, also by an
        empty one. Two batches of one day stand side by side; they follow each other by `batch_id`.
        """
        rows = self.write(df, "raw", source, dataset, f"dt={load_date}", f"batch_id={batch_id}")
        manifest = self.spark.createDataFrame(
            [(source, dataset, load_date, rows, schema_fingerprint(df),
              dt.datetime.now(dt.UTC), params or {})], schema("manifests"))
        keyed = manifest.withColumn("batch_id", F.lit(batch_id)).coalesce(1)
        path_keys = keyed.select("*", F.col("source").alias("of_source"),
                                 F.col("dataset").alias("of_dataset"), F.col("load_date").alias("dt"))
        self.write(path_keys, "state", "manifests",
                   partition_by=["of_source", "of_dataset", "dt", "batch_id"])
        return manifest

    def manifests(self) -> DataFrame:
        return self.read("state", "manifests").select(*schema("manifests").fieldNames())

    def landed(self, source: str, dataset: str, load_date: str, with_batch: bool = False) -> DataFrame:
        """All batches landed for one day, `with_batch` with their `batch_id` as text; other days are not
        even listed."""
        rows = self.read("raw", source, dataset, f"dt={load_date}")
        return rows.withColumn("batch_id", F.col("batch_id").cast("string")) if with_batch else rows.drop("batch_id")

    def quarantine(self, rejected: DataFrame, source: str, dataset: str, load_date: str) -> int:
        """Keep rejected rows with reason and load date in place of those of an earlier run of the day; an
        empty set leaves no files. Returns rows."""
        if rejected.isEmpty():
            self.remove("raw", "_rejected", source, dataset, f"dt={load_date}")
            return 0
        kept = rejected.withColumn("_load_date", F.lit(load_date)).withColumn("dt", F.lit(load_date))
        return self.write(kept, "raw", "_rejected", source, dataset, partition_by=["dt"])

    def write_observations(self, observations: DataFrame) -> int:
        """Silver observations in monthly partitions; each month in the batch is replaced whole.

        Rows are range-partitioned by month and product, so a month of any size is written by several
        tasks, and sorted, so product filters skip row groups.
        """
        by_month = observations.withColumn("month", dates.month_label(F.col("observed_date")))
        placed = by_month.repartitionByRange("month", "product_id").sortWithinPartitions(
            "month", "product_id", "observed_date")
        return self.write(placed, "silver", "price_observations", partition_by=["month"])

    def write_facts(self, facts: DataFrame, by_day: bool = True) -> int:
        """The fact table below month_sk=yyyymm and, by default, date_sk=yyyymmdd.

        Month predicates prune, and replacing days rewrites those days only. Prices must be positive.
        """
        bad = facts.filter(~F.coalesce(F.col("price") > 0, F.lit(False)))
        if not bad.isEmpty():
            raise CheckFailed("fact_price_observation: price must be positive")
        keyed = facts.withColumn("month_sk", dates.month_key(F.col("date_sk")))
        days = ["month_sk", "date_sk"] if by_day else ["month_sk"]
        placed = keyed.repartitionByRange("date_sk", "product_nk").sortWithinPartitions(
            "date_sk", "product_nk")
        return self.write(placed, "warehouse", "fact_price_observation", partition_by=days)

    def facts(self) -> DataFrame:
        """The fact table, date_sk an integer whichever layout wrote it."""
        return self.read("warehouse", "fact_price_observation").withColumn(
            "date_sk", F.col("date_sk").cast("int"))

    def newest_facts(self) -> DataFrame:
        """The facts of the newest month, found by the names of the partitions; all of them where there is none."""
        target, system = self._located("warehouse", "fact_price_observation")
        months = [entry.getPath().getName() for entry in system.listStatus(target)]
        months = [name.split("=")[1] for name in months if name.startswith("month_sk=")]
        return self.facts().filter(F.col("month_sk") == max(months, key=int)) if months else self.facts()

    def refresh_rollup(self, rollup: DataFrame, name: str = "agg_category_daily") -> int:
        """Create or fully refresh a stored aggregate."""
        return self.write(rollup, "warehouse", name)

    def write_report(self, report: DataFrame) -> None:
        """The quality report, appended as Parquet and rewritten as JSON for people."""
        self.write(report, "gold", "quality_report", mode="append")
        report.write.mode("overwrite").json(self.path("gold", "quality_report_json"))

    # ---- tables in buckets of a key ----
    def _bucket_table(self, layer: str, name: str) -> str:
        return f"lake_{hashlib.md5(self.path(layer, name).encode()).hexdigest()}"

    def write_bucketed(self, df: DataFrame, layer: str, name: str, key: str, buckets: int, sort: list[str] | None = None) -> DataFrame:
        """Replace a table, stored in buckets of `key` and sorted in each. Two tables with as many buckets of their keys join
        without a shuffle, and one key's rows are in one bucket. The layout is recorded, so any session can open it."""
        table, order = self._bucket_table(layer, name), sort or [key]
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        (df.repartition(buckets, key).write.mode("overwrite").option("compression", "zstd").option("path", self.path(layer, name))
         .bucketBy(buckets, key).sortBy(*order).saveAsTable(table))
        row = self.spark.createDataFrame([(key, buckets, order, _ddl(df))],
                                         "key string, buckets int, sort array<string>, columns string")
        self.write(row.coalesce(1), "state", "layouts", layer, name)
        return self.bucketed(layer, name)

    def bucketed(self, layer: str, name: str) -> DataFrame:
        """A table written by `write_bucketed`; its layout is read if this session does not know it yet."""
        table = self._bucket_table(layer, name)
        if not self.spark.catalog.tableExists(table):
            layout = self.read("state", "layouts", layer, name).first()
            order = ", ".join(f"`{c}`" for c in layout["sort"])
            self.spark.sql(f"CREATE TABLE {table} ({layout['columns']}) USING parquet CLUSTERED BY (`{layout['key']}`) "
                           f"SORTED BY ({order}) INTO {layout['buckets']} BUCKETS LOCATION '{self.path(layer, name)}'")
        return self.spark.table(table)

    # ---- versioned tables: new files first, then a pointer row ----
    def switch(self, df: DataFrame, layer: str, name: str) -> int:
        """Replace a table that `df` itself may read: write a new version, then point at it."""
        version = f"{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"
        rows = self.write(df, layer, name, f"version={version}")
        pointer = self.spark.createDataFrame([(version,)], "version string").coalesce(1)
        self.write(pointer, layer, f"{name}.current", mode="append")
        return rows

    def current(self, layer: str, name: str) -> DataFrame | None:
        """The version last switched to, or None."""
        if not self.exists(layer, f"{name}.current"):
            return None
        version = self.read(layer, f"{name}.current").agg(F.max("version")).first()[0]
        return self.read(layer, name, f"version={version}")

    # ---- watermarks ----
    def watermark(self, source: str) -> str | None:
        state = self.current("state", "ingestion_state")
        if state is None:
            return None
        row = state.filter(F.col("source") == source).select("watermark").first()
        return row[0] if row else None

    def set_watermark(self, source: str, value: str) -> None:
        """Advance one source; the others keep theirs. The state is one row per source."""
        row = self.spark.createDataFrame(
            [(source, value, dt.datetime.now(dt.UTC))], schema("ingestion_state"))
        state = self.current("state", "ingestion_state")
        if state is not None:
            row = state.filter(F.col("source") != source).unionByName(row)
        self.switch(row.coalesce(1), "state", "ingestion_state")

    # ---- run journal ----
    def log_run(self, experiment: str, params: dict, metrics: dict[str, float],
                tags: dict[str, str] | None = None, run_id: str | None = None) -> str:
        """Record one run; every run has a folder of its own, so runs may be recorded at the same time."""
        run_id = run_id or uuid.uuid4().hex[:12]
        record = (run_id, experiment, dt.datetime.now(dt.UTC),
                  {k: str(v) for k, v in params.items()},
                  {k: float(v) for k, v in metrics.items()}, tags or {})
        row = self.spark.createDataFrame([record], schema("runs")).coalesce(1)
        self.write(row, "state", "runs", f"run={run_id}")
        return run_id

    def runs(self) -> DataFrame:
        return self.read("state", "runs").select(*schema("runs").fieldNames())
