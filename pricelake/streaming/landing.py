"""Structured Streaming forms of the two incremental loads.

Both write every micro-batch so that a batch delivered again after a failure gives the same files: landing by partitions
named after it, the late window by replacing the days it touches. Neither reads what it has stored to know what is new:
keys already seen are streaming state, and the newest loaded day is a row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricelake import fixed_values as fixed
from pricelake.functions import dates
from pricelake.operators.dedup import keep_last
from pricelake.plans import warehouse
from pricelake.session import cut
from pricelake.sources.lake import Lake

BUCKETS = 256           # groups of keys; the state of one is read and written as a whole
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _run(stream: DataFrame, each_batch, checkpoint: str) -> None:
    """All input available now, then stop; the checkpoint remembers what was read."""
    (stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _seen_before(bounded: bool):
    """Splits a group of keys into new and late records. The state is an Arrow table of keys and times; a key is forgotten
    when the watermark has passed its time, since its repetition would be late."""

    def remember(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        limit = state.getCurrentWatermarkMs() * 1000 if bounded else np.iinfo(np.int64).min
        seen = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else rows[["key", "at"]].iloc[:0]
        late = rows["at"] < limit
        # of a key's records in one batch the one created last counts
        fresh = rows[~late].sort_values(["at", "record"], na_position="first").drop_duplicates("key", keep="last")
        fresh = fresh[~fresh["key"].isin(seen["key"])]
        kept = pd.concat([part for part in (seen, fresh[["key", "at"]]) if len(part)] or [seen], ignore_index=True)
        kept = kept[~(kept["at"] < limit)].astype({"key": "string", "at": "Int64"})
        table = pa.Table.from_pandas(kept, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        yield pd.concat([fresh.assign(late=False), rows[late].assign(late=True)])[["record", "late"]]

    return remember


def split_by_state(records: DataFrame, key: str, created: str, late_after: str | None, buckets: int = BUCKETS) -> DataFrame:
    """The records of a stream that bring a new key, and those that come too late: `record` (as JSON) and `late`.

    With `late_after` a record older than the watermark is late; without, nothing is late and keys are never forgotten.
    """
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns]), TIMES)
    watched = records.withWatermark(created, late_after) if late_after else records
    narrow = watched.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), F.col(key).cast("string").alias("key"),
                            F.unix_micros(created).alias("at"), record.alias("record"),
                            *([F.col(created).alias("event_time")] if late_after else []))
    return narrow.groupBy("bucket").applyInPandasWithState(
        _seen_before(bool(late_after)), "record string, late boolean", "seen binary", "append", GroupStateTimeout.NoTimeout)


def land_incrementally(records: DataFrame, lake: Lake, source: str, dataset: str, key: str = "id", created: str = "created",
                       late_after: str | None = None) -> None:
    """Land new records raw below dt= and batch_id=, each key once.

    `records` is a stream. Keys already landed are streaming state, so no landed data is read again. With `late_after`
    ("30 days") the state ends at the watermark: records that are older go to the quarantine, below late/ with the same
    partitions, whether their key has landed or not.
    """
    schema = records.schema

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = cut(batch.select(F.from_json("record", schema, TIMES).alias("r"), "late").select("r.*", "late")
                   .withColumns({"dt": F.date_format(created, "yyyy-MM-dd"), "batch_id": F.lit(batch_id)}), "landing")
        for late, parts in ((False, (source, dataset)), (True, ("_rejected", source, dataset, "late"))):
            own = rows.filter(F.col("late") == late).drop("late")
            if not own.isEmpty():
                lake.write(own, "raw", *parts, partition_by=["dt", "batch_id"])

    _run(split_by_state(records, key, created, late_after), land, lake.path("state", "streams", source, dataset))


def late_records(lake: Lake, source: str, dataset: str) -> DataFrame:
    """What `land_incrementally` has found too late."""
    return lake.read("raw", "_rejected", source, dataset, "late")


def _newest_before(lake: Lake, table: str, batch_id: int) -> DataFrame | None:
    """The newest day that batches before this one have loaded, as a table of one row and column date_sk."""
    if not lake.exists("state", "newest_day", table):
        return None
    before = lake.read("state", "newest_day", table).filter(F.col("batch_id") < batch_id)
    return before.agg(F.max("date_sk").alias("date_sk"))


def load_late_window(facts: DataFrame, lake: Lake, table: str,
                     days: int = fixed.LATE_ARRIVAL_DAYS, compat: bool = False, by_day: bool = True) -> None:
    """Load a stream of facts (product_nk, date_sk, ...): a batch adds to or replaces the stored facts of
    days that lie within the late-arrival window before the newest loaded day; older rows are ignored.

    The days a batch touches are merged with what is stored of them and written whole and sorted, so a day is never a
    heap of small files and readers have nothing to resolve. Where days are small `by_day=False` does so by month. The
    newest day is a row that each batch writes.
    """
    parts = ["month_sk", "date_sk"] if by_day else ["month_sk"]

    def load(batch: DataFrame, batch_id: int) -> None:
        newest, floor = _newest_before(lake, table, batch_id), None
        if newest is not None:
            floor = warehouse.late_floor(newest, days, compat).first()["floor"]
            batch = batch.filter(F.col("date_sk") > F.lit(floor))
        rows = batch.withColumns({"month_sk": dates.month_key(F.col("date_sk")), "_loaded": F.lit(1)})
        if newest is not None and lake.exists("warehouse", table):
            # the literal prunes the scan to the window's partitions, the join to those the batch touches
            stored = lake.read("warehouse", table).withColumns({c: F.col(c).cast("int") for c in ("month_sk", "date_sk")})
            stored = stored.filter(F.col("month_sk") >= F.lit(floor // 100))
            touched = cut(rows.select(parts[-1]).distinct(), "touched")
            rows = rows.unionByName(stored.join(touched, parts[-1], "left_semi").withColumn("_loaded", F.lit(0)))
        # merging leaves a day's key, so the newest day is known from the rows
        tally = cut(rows.agg(F.max("date_sk").cast("int").alias("date_sk"), F.count("*").alias("n")), "batch-day")
        if not tally.first()["n"]:
            return
        day = tally.select("date_sk")
        # dealt once, in the order of the files: a key's rows meet in one range, where the last one is chosen
        placed = keep_last(rows.repartitionByRange("date_sk", "product_nk"), ["product_nk", "date_sk"], ["_loaded"]).drop("_loaded")
        lake.write(placed.sortWithinPartitions("date_sk", "product_nk"), "warehouse", table, partition_by=parts)
        if newest is not None:
            day = day.unionByName(newest).agg(F.max("date_sk").alias("date_sk"))
        lake.write(cut(day, "newest-day").withColumn("batch_id", F.lit(batch_id)).coalesce(1), "state", "newest_day", table,
                   partition_by=["batch_id"])
        # a batch delivered again needs the row before its own; older ones are needed no more
        lake.remove("state", "newest_day", table, f"batch_id={batch_id - 2}")

    _run(facts, load, lake.path("state", "streams", table))


def current_facts(lake: Lake, table: str) -> DataFrame:
    """The facts as of the last load: of each product and day the row loaded last. A plain scan."""
    return lake.read("warehouse", table).drop("month_sk").withColumn("date_sk", F.col("date_sk").cast("int"))
