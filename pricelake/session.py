"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from pricelake.packaging import ship

CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, app: str = "pricelake", **settings) -> SparkSession:
    """A session with the settings the operators expect; `settings` are extra key/value pairs.

    shuffle.partitions is left to the cluster: with adaptive execution a generous start value is
    coalesced to the data at hand. Local runs pass their own small number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    A temporary folder is made only in local mode, where driver and executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="pricelake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    return f"{shared_folder(spark).rstrip('/')}/pricelake/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` below the shared folder and read it back.

    The result has no lineage beyond the files, survives lost executors, is columnar, and has file
    sizes from which Catalyst decides by itself whether a side is small enough to broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, size: str = "4m") -> None:
    """Arrow batches end by bytes and not only by rows, for tables whose rows are large; a setting of the user stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) in (None, "2147483647", "2147483647b"):
        spark.conf.set(setting, size)


def spread(stored: DataFrame) -> DataFrame:
    """A stored table in at least as many partitions as the cluster has cores, for work that is heavy per
    row. A large table has more to begin with and is left as it is, without a shuffle."""
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored.repartition(cores) if stored.rdd.getNumPartitions() < cores else stored


def drop_stored(stored: DataFrame) -> None:
    """Remove a table made by `cut` that nothing reads any more."""
    spark = stored.sparkSession
    for name in {path.rsplit("/", 1)[0] for path in stored.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
