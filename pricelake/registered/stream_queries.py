"""Registered queries that run a stream to its end and return what it stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.registered.entries import register
from pricelake.registered.warehouse_queries import FACT
from pricelake.session import scratch_path
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import TradeFeed
from pricelake.streaming import landing


@register("stream_incremental_landing", "id:i created:t dt:t event_type:s value:d", """
select event_id as id, ts as created, cast(ts as date) as dt, event_type, value from events""")
def stream_incremental_landing(feed: TradeFeed) -> DataFrame:
    """Runs twice over the events file; the second run finds nothing new."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    for _ in range(2):
        events = feed.spark.readStream.schema(feed.table("events").schema).option(
            "pathGlobFilter", "events.parquet").parquet(feed.folder)
        records = events.withColumnRenamed("event_id", "id").withColumn(
            "created", F.col("ts").cast("timestamp"))
        landing.land_incrementally(records, lake, "feed", "events")
    return lake.read("raw", "feed", "events")


@register("stream_late_records", "id:i created:t late:b", """
with told as (select event_id, ts, ts < date '2024-01-20' and event_id % 10 <> 0 as first_time from events),
mark as (select date_trunc('millisecond', max(ts)) - interval 5 day as floor_ts from told where first_time)
select event_id as id, ts as created, false as late from told where first_time
union all
select event_id, ts, ts < floor_ts from told, mark where ts < floor_ts or not first_time""")
def stream_late_records(feed: TradeFeed) -> DataFrame:
    """Two deliveries: nine tenths of the early events, then all events again. Of the second, what is older than five days
    before the newest of the first is late, and of the rest only new keys land."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    inbox = scratch_path(feed.spark, "inbox")
    events = feed.table("events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("created"))
    for delivery in (events.filter("created < timestamp '2024-01-20' and id % 10 <> 0"), events):
        delivery.write.mode("append").parquet(inbox)
        records = feed.spark.readStream.schema(events.schema).parquet(inbox)
        landing.land_incrementally(records, lake, "feed", "late_events", late_after="5 days")
    landed = lake.read("raw", "feed", "late_events").withColumn("late", F.lit(False))
    late = landing.late_records(lake, "feed", "late_events").withColumn("late", F.lit(True))
    return landed.unionByName(late).select("id", F.col("created").cast("timestamp_ntz").alias("created"), "late")


@register("stream_late_window", FACT, """
select * replace (case when date_sk > 19980628 then price + 1 else price end as price) from facts""")
def stream_late_window(feed: TradeFeed) -> DataFrame:
    """Two deliveries: all facts up to 1998-07-01, then everything again at a price one higher. The second
    counts from three days before the last stored day."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    inbox = scratch_path(feed.spark, "inbox")
    deliveries = [
        feed.facts.filter(F.col("date_sk") <= 19980701),
        feed.facts.withColumn("price", F.col("price") + 1),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(inbox)
        facts = feed.spark.readStream.schema(feed.facts.schema).parquet(inbox)
        landing.load_late_window(facts, lake, "fact_stream", by_day=False)
    return landing.current_facts(lake, "fact_stream")
