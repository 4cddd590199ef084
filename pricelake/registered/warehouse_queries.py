"""Registered queries of the star schema and its marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.fixed_values import SNAPSHOT_CHECK_COLUMNS
from pricelake.operators.scd2 import snapshot
from pricelake.plans import warehouse
from pricelake.registered.entries import register
from pricelake.registered.lake_queries import CATEGORY_DAY, OBSERVATION, OBSERVATION_SQL
from pricelake.session import scratch_path
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import FIRST_SNAPSHOT, SECOND_SNAPSHOT, TradeFeed

STAGED = ("product_name:s category:s subcategory:s brand:s audience:s color_options:s base_price:d "
          "base_rating:d image_url:s ")
FACT = ("product_sk:s product_nk:i date_sk:i price:d original_price:d discount_percentage:d "
        "availability:s stock_level:i rating:d review_count:i sales_velocity:d is_trending:b")


@register("stg_observations", OBSERVATION, OBSERVATION_SQL)
def stg_observations(feed: TradeFeed) -> DataFrame:
    return warehouse.stage_observations(feed.observations)


@register("stg_products", "product_id:i " + STAGED, "select * from products")
def stg_products(feed: TradeFeed) -> DataFrame:
    return warehouse.stage_products(feed.products)


@register("scd2_snapshot", "product_id:i " + STAGED + "valid_from:t valid_to:t",
          "select * from history")
def scd2_snapshot(feed: TradeFeed) -> DataFrame:
    return feed.history()


@register("dim_product", "product_sk:s product_nk:i " + STAGED + "valid_from:t valid_to:t is_current:b",
          "select * from dim_product")
def dim_product(feed: TradeFeed) -> DataFrame:
    return warehouse.dim_product(feed.history())


@register("dim_date", "date_sk:i full_date:t year:i quarter:i month:i month_name:s week_of_year:i "
          "day_of_week:i day_name:s is_weekend:b", "select * from dim_date")
def dim_date(feed: TradeFeed) -> DataFrame:
    return warehouse.dim_date(feed.observations)


@register("fact_price_observation", FACT, "select * from facts")
def fact_price_observation(feed: TradeFeed) -> DataFrame:
    return warehouse.fact_price_observation(
        warehouse.stage_observations(feed.observations), feed.dim_product)


@register("fact_copartitioned", FACT, "select * from facts")
def fact_copartitioned(feed: TradeFeed) -> DataFrame:
    """The validity join of observations and history that are stored in like buckets of the product."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    observations = lake.write_bucketed(
        warehouse.stage_observations(feed.observations), "silver", "by_product", "product_id", 16, ["product_id", "observed_date"])
    dim = lake.write_bucketed(feed.dim_product, "warehouse", "dim_by_product", "product_nk", 16)
    return warehouse.fact_price_observation(observations, dim)


@register("scd2_snapshot_hashed", "product_id:i " + STAGED + "valid_from:t valid_to:t", "select * from history")
def scd2_snapshot_hashed(feed: TradeFeed) -> DataFrame:
    """Two snapshots by a digest of the checked columns, between tables in like buckets."""
    lake, check = Lake(feed.spark, scratch_path(feed.spark, "lake")), SNAPSHOT_CHECK_COLUMNS
    first = snapshot(None, warehouse.stage_products(feed.products), "product_id", check, FIRST_SNAPSHOT, hashed=True)
    first = lake.write_bucketed(first, "warehouse", "history", "product_id", 8)
    second = lake.write_bucketed(warehouse.stage_products(feed.changed_products()), "silver", "delivered", "product_id", 8)
    return snapshot(first, second, "product_id", check, SECOND_SNAPSHOT, hashed=True)


@register("fact_incremental_window", FACT + " reloaded:b", """
select *, date_sk > 19980628 as reloaded from facts""")
def fact_incremental_window(feed: TradeFeed) -> DataFrame:
    """A target that ends on 1998-07-01, with one wrong price per fact, takes the window's facts."""
    target = feed.facts.filter(F.col("date_sk") <= 19980701).withColumn(
        "price", F.when(F.col("date_sk") > 19980628, -1.0).otherwise(F.col("price")))
    young = warehouse.late_window(feed.facts, target)
    merged = warehouse.replace_days(target, young)
    return merged.withColumn("reloaded", F.col("date_sk") > 19980628)


@register("latest_per_product", FACT, "select * from latest")
def latest_per_product(feed: TradeFeed) -> DataFrame:
    return warehouse.latest_per_product(feed.facts)


DEAL = ("product_id:i product_name:s category:s brand:s image_url:s current_price:d original_price:d "
        "discount_percentage:d rating:d observed_date:t")


@register("mart_trending_deals", DEAL, "select * from deals")
def mart_trending_deals(feed: TradeFeed) -> DataFrame:
    return warehouse.trending_deals(feed.facts, feed.dim_product, feed.dim_date)


PERFORMANCE = ("product_id:i product_name:s category:s subcategory:s brand:s audience:s image_url:s "
               "base_rating:d avg_price:d min_price:d max_price:d avg_rating:d total_reviews:i "
               "avg_discount:d price_volatility:d data_points:i avg_sales_velocity:d")


@register("mart_product_performance", PERFORMANCE, "select * from performance")
def mart_product_performance(feed: TradeFeed) -> DataFrame:
    return warehouse.product_performance(feed.facts, feed.dim_product)


@register("agg_category_daily", "category:s full_date:t " + CATEGORY_DAY, "select * from rollup_daily")
def agg_category_daily(feed: TradeFeed) -> DataFrame:
    return warehouse.category_daily(feed.facts, feed.dim_product, feed.dim_date)
