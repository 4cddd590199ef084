"""Registered queries of operators that write: each writes below the shared folder and reads back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.fixed_values import QUALITY_SLO, SNAPSHOT_CHECK_COLUMNS
from pricelake.operators import quality
from pricelake.operators.checks import CheckFailed
from pricelake.operators.contracts import PRICE_FACTS, PRODUCTS, REASON
from pricelake.operators.dedup import keep_last
from pricelake.operators.scd2 import snapshot
from pricelake.plans import serving, warehouse
from pricelake.registered.entries import register
from pricelake.registered.model_queries import zscore_flags
from pricelake.registered.warehouse_queries import FACT
from pricelake.session import cut, scratch_path
from pricelake.sources import catalog_files, open_prices
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import AS_OF, TradeFeed

DAY = str(AS_OF)


def _lake(feed: TradeFeed) -> Lake:
    return Lake(feed.spark, scratch_path(feed.spark, "lake"))


def _refused(action) -> bool:
    try:
        action()
    except CheckFailed:
        return True
    return False


@register("csv_last_of_files", "product_id:i name:s brand:s", """
select p_partkey as product_id, case when p_partkey % 3 = 0 then 'new ' || p_name else p_name end as name,
       p_brand as brand from part""")
def csv_last_of_files(feed: TradeFeed) -> DataFrame:
    """A delivery of two files: all parts, then every third again under another name. The later file counts,
    although Spark reads the larger one first."""
    folder, lake = scratch_path(feed.spark, "delivery"), _lake(feed)
    rows = feed.raw_products()
    later = rows.filter("product_id % 3 = 0").withColumn("name", F.concat(F.lit("new "), "name"))
    for at, part in enumerate((rows, later)):
        part.coalesce(1).write.option("header", True).csv(f"{folder}/products.csv/delivery={at}")
    frame = catalog_files.read_csv(feed.spark, f"{folder}/products.csv/delivery=*", "products", "_ordinal")
    lake.land(frame, "trade", "products", DAY)
    return keep_last(lake.landed("trade", "products", DAY, with_batch=True), ["product_id"], ["batch_id", "_ordinal"])


@register("json_pages_union", "id:i product_name:s price:d created:s", """
select event_id as id, case when event_id % 3 > 0 then event_type end as product_name, value as price,
       cast(ts as varchar) as created from events""")
def json_pages_union(feed: TradeFeed) -> DataFrame:
    """Records landed as two folders of JSON pages, read as one table; some records have no product."""
    folder = scratch_path(feed.spark, "pages")
    records = feed.table("events").select(
        F.col("event_id").alias("id"), F.col("value").alias("price"),
        F.col("ts").cast("timestamp_ntz").cast("string").alias("created"),
        F.when(F.col("event_id") % 3 > 0, F.struct(F.col("event_type").alias("product_name"))).alias("product"))
    for page in (0, 1):
        records.filter(F.col("id") % 2 == page).write.json(f"{folder}/page={page}")
    return open_prices.read_pages(feed.spark, f"{folder}/page=*")


@register("watermark_state", "source:s watermark:s", """
select 'events' as source, cast(max(ts) as varchar) as watermark from events
union all select 'lines', cast(max(cast(l_shipdate as date)) as varchar) from lineitem""")
def watermark_state(feed: TradeFeed) -> DataFrame:
    """Two sources; the first is set twice and does not disturb the second."""
    lake = _lake(feed)
    lake.set_watermark("events", "2000-01-01 00:00:00")
    newest = feed.table("lineitem").agg(F.max(F.col("l_shipdate").cast("date")).cast("string")).first()[0]
    lake.set_watermark("lines", newest)
    lake.set_watermark("events", feed.table("events").agg(F.max(F.col("ts").cast("timestamp_ntz")).cast("string")).first()[0])
    return lake.current("state", "ingestion_state")


@register("quarantine_after_correction", "fact_id:i reason:s load_date:s", f"""
select fact_id, reason, '{DAY}' as load_date from fact_reasons where reason is not null and fact_id % 2 = 0""")
def quarantine_after_correction(feed: TradeFeed) -> DataFrame:
    """A day delivered with all its faults and again with those of even facts only; another day's faults were
    corrected altogether."""
    lake = _lake(feed)
    bad = cut(PRICE_FACTS.split(feed.last_facts(), check_unique=False)[1], "rejected")
    other = str(AS_OF - dt.timedelta(days=1))
    for day, rows in ((DAY, bad), (other, bad), (DAY, bad.filter("fact_id % 2 = 0")), (other, bad.limit(0))):
        lake.quarantine(rows, "trade", "price_facts", day)
    return lake.read("raw", "_rejected", "trade", "price_facts").withColumnsRenamed({REASON: "reason", "_load_date": "load_date"})


@register("reland_empty_day", "day:s rows:i", f"""
select '{DAY}' as day, 0 as rows union all select 'other', count(*) from part""")
def reland_empty_day(feed: TradeFeed) -> DataFrame:
    """A landed day is landed again without rows; another day keeps its own."""
    lake = _lake(feed)
    for day, rows in ((DAY, feed.raw_products()), ("2001-11-04", feed.raw_products()), (DAY, feed.raw_products().limit(0))):
        lake.land(rows, "trade", "products", day)
    counts = [lake.landed("trade", "products", d).agg(F.lit(name).alias("day"), F.count("*").alias("rows"))
              for d, name in ((DAY, DAY), ("2001-11-04", "other"))]
    return counts[0].unionByName(counts[1])


@register("contract_missing_column", "valid:i rejected:i reason:s", """
select 0 as valid, count(*) as rejected, 'missing_column:base_price' as reason from part""")
def contract_missing_column(feed: TradeFeed) -> DataFrame:
    """A batch without a column of its contract is rejected whole."""
    valid, rejected = PRODUCTS.split(feed.raw_products().drop("base_price"))
    return rejected.agg(F.lit(0).alias("valid"), F.count("*").alias("rejected"), F.max(REASON).alias("reason")).withColumn(
        "valid", valid.agg(F.count("*")).scalar())


@register("months_replaced", "product_id:i observed_date:t price:d", """
select product_id, observed_date, case when date_trunc('month', observed_date) = date '1997-03-01' then price + 1
  else price end as price from observations
where date_trunc('month', observed_date) <> date '1997-03-01' or product_id % 2 = 0""")
def months_replaced(feed: TradeFeed) -> DataFrame:
    """All months, then one of them again with other prices and half of its products."""
    lake = _lake(feed)
    rows = feed.observations.drop("month")
    lake.write_observations(rows)
    again = rows.filter("date_trunc('month', observed_date) = date '1997-03-01' and product_id % 2 = 0")
    lake.write_observations(again.withColumn("price", F.col("price") + 1))
    return lake.read("silver", "price_observations")


@register("facts_by_month", FACT, "select * from facts")
def facts_by_month(feed: TradeFeed) -> DataFrame:
    """The fact table in its monthly layout."""
    lake = _lake(feed)
    lake.write_facts(feed.facts, by_day=False)
    return lake.facts()


@register("facts_bad_price_refused", "refused:b rows:i", "select true as refused, count(*) as rows from facts")
def facts_bad_price_refused(feed: TradeFeed) -> DataFrame:
    """A price of nothing stops the write, and the stored facts stay."""
    lake = _lake(feed)
    lake.write_facts(feed.facts)
    refused = _refused(lambda: lake.write_facts(feed.facts.withColumn("price", F.lit(0.0))))
    return lake.facts().agg(F.lit(refused).alias("refused"), F.count("*").alias("rows"))


@register("rollup_refreshed", "category:s full_date:t products_observed:i", """
select category, full_date, products_observed from rollup_daily where year(full_date) = 1996""")
def rollup_refreshed(feed: TradeFeed) -> DataFrame:
    """A stored rollup, refreshed from fewer rows, has those only."""
    lake = _lake(feed)
    lake.refresh_rollup(feed.rollup)
    lake.refresh_rollup(feed.rollup.filter(F.year("full_date") == 1996))
    return lake.read("warehouse", "agg_category_daily")


@register("quality_gates", "gate:s passed:b", """
select 'clean' as gate, true as passed union all select 'impossible', false
union all select 'empty', false
union all select 'fresh', greatest(0, 1 - (date '2001-11-05' - max(observed_date)) / 30.0) >= 0.5 from observations
union all select 'stale', greatest(0, 1 - (date '2001-11-05' + 20 - max(observed_date)) / 30.0) >= 0.5 from observations""")
def quality_gates(feed: TradeFeed) -> DataFrame:
    """The report of the observations passes a floor of half and no floor above one; that of no rows passes none. The
    freshness gate looks at a report of the day and at one of twenty days later."""
    report = quality.quality_report(feed.observations, AS_OF, 0)
    empty = quality.quality_report(feed.observations.limit(0), AS_OF, 0)
    cases = [("clean", report, 0.5), ("impossible", report, 1.01), ("empty", empty, QUALITY_SLO)]
    passed = [(name, not _refused(lambda r=r, floor=floor: quality.gate(r, floor=floor))) for name, r, floor in cases]
    for name, later in (("fresh", 0), ("stale", 20)):
        dated = quality.quality_report(feed.observations, AS_OF + dt.timedelta(days=later), 0)
        passed.append((name, not _refused(lambda r=dated: quality.freshness_gate(r))))
    return feed.spark.createDataFrame(passed, "gate string, passed boolean")


@register("snapshot_deleted_keys", "product_id:i versions:i still_open:b", """
select product_id, if(product_id % 10 = 0, 2, 1) as versions, true as still_open from products""")
def snapshot_deleted_keys(feed: TradeFeed) -> DataFrame:
    """A third delivery without every fourth product; what is not delivered stays open."""
    third = warehouse.stage_products(feed.changed_products()).filter("product_id % 4 <> 0")
    history = snapshot(feed.history(), third, "product_id", SNAPSHOT_CHECK_COLUMNS, dt.datetime(1999, 1, 1))
    return history.groupBy("product_id").agg(F.count("*").alias("versions"),
                                             F.bool_or(F.col("valid_to").isNull()).alias("still_open"))


@register("run_journal", "experiment:s runs:i rows_scored:d", """
select 'scan' as experiment, 2 as runs, 2.0 * count(*) as rows_scored from observations
union all select 'other', 1, 1.0""")
def run_journal(feed: TradeFeed) -> DataFrame:
    lake = _lake(feed)
    n = feed.observations.count()
    for experiment, rows in (("scan", n), ("scan", n), ("other", 1)):
        lake.log_run(experiment, {"table": "observations"}, {"rows": rows})
    return lake.runs().groupBy("experiment").agg(F.count("*").alias("runs"), F.sum(F.col("metrics")["rows"]).alias("rows_scored"))


@register("report_stored", "rows_evaluated:i rejected_rows:i completeness:d", """
select count(*) as rows_evaluated, 3 as rejected_rows, 1.0 as completeness from observations""")
def report_stored(feed: TradeFeed) -> DataFrame:
    """The quality report as its readers find it, written as Parquet and as JSON."""
    lake = _lake(feed)
    lake.write_report(quality.quality_report(feed.observations, AS_OF, 3, dt.datetime(2001, 11, 5)))
    report = lake.read("gold", "quality_report")
    as_json = feed.spark.read.schema(report.schema).json(lake.path("gold", "quality_report_json"))
    return report.intersect(as_json.select(*report.columns))


@register("schema_fingerprints", "same:b other:b digits:i", "select true as same, false as other, 16 as digits from part limit 1")
def schema_fingerprints(feed: TradeFeed) -> DataFrame:
    """Of the landed parts, of the same columns in another order, and of one column less, from the manifests."""
    lake = _lake(feed)
    rows = feed.raw_products()
    for batch, frame in (("a", rows), ("b", rows.select(*rows.columns[::-1])), ("c", rows.drop("brand"))):
        lake.land(frame, "trade", f"parts_{batch}", DAY)
    prints = lake.manifests().groupBy().pivot("dataset", ["parts_a", "parts_b", "parts_c"]).agg(F.max("schema_hash"))
    return prints.select((F.col("parts_a") == F.col("parts_b")).alias("same"),
                         (F.col("parts_a") == F.col("parts_c")).alias("other"), F.length("parts_a").alias("digits"))


@register("srv_kpis_quality", "products:i anomalies:i rows_evaluated:i rejected_rows:i", """
select count_if(is_current) as products, (select count_if(zscore_flag) from flagged) as anomalies,
       (select count(*) from observations) as rows_evaluated, 7 as rejected_rows from dim_product""")
def srv_kpis_quality(feed: TradeFeed) -> DataFrame:
    """The KPI row with the newer of two quality reports."""
    reports = [quality.quality_report(feed.observations, AS_OF, n, dt.datetime(2001, 11, n)) for n in (4, 7)]
    row = serving.kpis(feed.dim_product, feed.performance, feed.facts, feed.deals,
                       zscore_flags(feed).filter("zscore_flag"), reports[0].unionByName(reports[1]))
    return row.select("products", "anomalies", "quality.rows_evaluated", "quality.rejected_rows")
