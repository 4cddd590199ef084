"""Registered queries of the read side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.operators import quality
from pricelake.plans import serving
from pricelake.registered.entries import register
from pricelake.registered.lake_queries import CATEGORY_DAY, dirty_observations
from pricelake.registered.model_queries import zscore_flags
from pricelake.registered.warehouse_queries import DEAL, PERFORMANCE
from pricelake.session import scratch_path
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import AS_OF, TradeFeed

FILTERS = {"category": "Hardware", "search": "O", "min_price": 20000.0, "max_price": 60000.0,
           "min_rating": 2.0}
FILTERED_SQL = """category = 'Hardware' and (lower(product_name) like '%o%' or lower(brand) like '%o%')
  and avg_price >= 20000 and avg_price <= 60000 and avg_rating >= 2"""


def price_bands(feed: TradeFeed) -> DataFrame:
    """A two-band stand-in for the clustered segments, the same in both engines."""
    return feed.products.select("product_id", F.when(
        F.col("base_price") >= 950, "Premium").otherwise("Value").alias("segment_name"))


@register("srv_list_products", PERFORMANCE + " segment_name:s", f"""
select p.*, s.segment_name from performance p left join segments s using (product_id)
where {FILTERED_SQL} order by avg_price desc, product_id limit 50 offset 50""")
def srv_list_products(feed: TradeFeed) -> DataFrame:
    return serving.list_products(feed.performance, price_bands(feed), page=2, page_size=50,
                                 sort_by="avg_price", descending=True, **FILTERS)


@register("srv_list_after", PERFORMANCE + " segment_name:s", f"""
select p.*, s.segment_name from performance p left join segments s using (product_id)
where {FILTERED_SQL} order by avg_price desc, product_id limit 5 offset 10""")
def srv_list_after(feed: TradeFeed) -> DataFrame:
    """The third page, each reached from the last row of the one before."""
    page, cursor = None, None
    for _ in range(3):
        page = serving.list_after(feed.performance, price_bands(feed), cursor, 5, "avg_price", True, **FILTERS)
        rows = page.select("avg_price", "product_id").collect()
        cursor = tuple(rows[-1]) if rows else cursor
    return page


@register("srv_history_bucketed", "observed_date:t price:d original_price:d discount_percentage:d rating:d "
          "sales_velocity:d", """
select dd.full_date as observed_date, f.* from facts f join dim_date dd using (date_sk)
where f.product_nk = 10""")
def srv_history_bucketed(feed: TradeFeed) -> DataFrame:
    """The same history from facts in buckets of the product, of which one is read."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    facts = lake.write_bucketed(feed.facts, "warehouse", "price_history", "product_nk", 16, ["product_nk", "date_sk"])
    return serving.price_history(facts, feed.dim_date, 10)


@register("srv_page_info", "page:i page_size:i total:i total_pages:i", f"""
select 2 as page, 200 as page_size, count(*) as total,
       greatest(1, cast(ceil(count(*) / 200.0) as bigint)) as total_pages
from performance where {FILTERED_SQL}""")
def srv_page_info(feed: TradeFeed) -> DataFrame:
    return serving.page_info(feed.performance, page=2, page_size=10_000, **FILTERS)


@register("srv_product", PERFORMANCE + " segment_name:s", """
select p.*, s.segment_name from performance p left join segments s using (product_id)
where p.product_id = 10""")
def srv_product(feed: TradeFeed) -> DataFrame:
    return serving.product(feed.performance, price_bands(feed), 10)


@register("srv_price_history", "observed_date:t price:d original_price:d discount_percentage:d rating:d "
          "sales_velocity:d", """
select dd.full_date as observed_date, f.* from facts f join dim_date dd using (date_sk)
where f.product_nk = 10""")
def srv_price_history(feed: TradeFeed) -> DataFrame:
    return serving.price_history(feed.facts, feed.dim_date, 10)


@register("srv_top_deals", DEAL,
          "select * from deals order by discount_percentage desc, product_id limit 20")
def srv_top_deals(feed: TradeFeed) -> DataFrame:
    return serving.top_deals(feed.deals)


@register("srv_category_daily", "category:s full_date:t " + CATEGORY_DAY,
          "select * from rollup_daily")
def srv_category_daily(feed: TradeFeed) -> DataFrame:
    return serving.category_daily(feed.rollup)


@register("srv_facets", "facet:s value:s", """
select distinct 'categories' as facet, category as value from performance
union all select distinct 'brands', brand from performance where brand is not null
union all select distinct 'segments', segment_name from segments""")
def srv_facets(feed: TradeFeed) -> DataFrame:
    return serving.facets(feed.performance, price_bands(feed))


@register("srv_kpis", "products:i categories:i brands:i warehouse_rows:i active_deals:i anomalies:i "
          "avg_price:d avg_discount:d", """
select * from (select count_if(is_current) as products from dim_product)
  positional join (select count(distinct category) as categories, count(distinct brand) as brands,
                          round(avg(avg_price), 2) as avg_price,
                          round(avg(avg_discount), 2) as avg_discount from performance)
  positional join (select count(*) as warehouse_rows from facts)
  positional join (select count(*) as active_deals from deals)
  positional join (select count_if(zscore_flag) as anomalies from flagged)""")
def srv_kpis(feed: TradeFeed) -> DataFrame:
    found = zscore_flags(feed).filter("zscore_flag")
    return serving.kpis(feed.dim_product, feed.performance, feed.facts, feed.deals, found)


INSIGHTS_SQL = """
select category, round(100 * (new_mean / old_mean - 1), 1) as pct_change_7d,
       if(new_mean > old_mean, 'up', 'down') as direction
from (select category, avg(if(age < 7, avg_price, null)) as new_mean,
             avg(if(age between 7 and 13, avg_price, null)) as old_mean
      from (select r.category, r.avg_price, last_day - r.full_date as age
            from rollup_daily r join (select category, max(full_date) as last_day from rollup_daily
                                      group by category) using (category))
      group by category)
where old_mean is not null"""


@register("srv_insights", "category:s pct_change_7d:d direction:s", INSIGHTS_SQL)
def srv_insights(feed: TradeFeed) -> DataFrame:
    return serving.insights(feed.rollup)


@register("srv_headlines", "category:s headline:s", f"""
select category, format('{{}} prices {{}} {{:.1f}}% over the last 7 days', category,
         case when direction = 'up' then 'rose' else 'fell' end, abs(pct_change_7d)) as headline
from ({INSIGHTS_SQL}) where pct_change_7d is not null""")
def srv_headlines(feed: TradeFeed) -> DataFrame:
    return serving.headlines(serving.insights(feed.rollup))


@register("srv_quality", "completeness:d uniqueness:d rows_evaluated:i rejected_rows:i", """
select round(1 - sum(cast(price is null as int)) / (3.0 * count(*)), 4) as completeness,
       round((select count(*) from (select distinct product_id, observed_date from dirty_observations))
             / cast(count(*) as double), 4) as uniqueness,
       count(*) as rows_evaluated, 7 as rejected_rows from dirty_observations""")
def srv_quality(feed: TradeFeed) -> DataFrame:
    """Of two reports the one computed last."""
    old = quality.quality_report(feed.observations, AS_OF, 0, dt.datetime(2001, 11, 4))
    new = quality.quality_report(dirty_observations(feed), AS_OF, 7, dt.datetime(2001, 11, 5))
    return serving.latest_quality(old.unionByName(new))
