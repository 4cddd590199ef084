"""Registered queries of the ingestion, onboarding, bronze, silver, gold and quality steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import text
from pricelake.operators import checks, features, quality, ranks
from pricelake.operators.contracts import PRICE_FACTS, PRODUCTS, REASON
from pricelake.operators.observations import normalise_time, resolve_dates
from pricelake.plans import onboarding
from pricelake.registered.entries import register
from pricelake.session import cut, scratch_path
from pricelake.sources import catalog_files, open_prices
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import AS_OF, LEXICON, RULES, TradeFeed

OBSERVATION = ("product_id:i observed_date:t price:d original_price:d discount_percentage:d "
               "availability:s stock_level:i rating:d review_count:i sales_velocity:d is_trending:b")
OBSERVATION_SQL = "select * from observations"


# ---- sources and sinks ----
@register("silver_scan_month_pruned", "month:s observations:i avg_price:d", """
select strftime(observed_date, '%Y-%m') as month, count(*) as observations, avg(price) as avg_price
from observations where strftime(observed_date, '%Y-%m') between '1996-01' and '1999-12' group by 1""")
def silver_scan_month_pruned(feed: TradeFeed) -> DataFrame:
    months = feed.observations.filter(F.col("month").between("1996-01", "1999-12"))
    return months.groupBy("month").agg(
        F.count("*").alias("observations"), F.avg("price").alias("avg_price"))


@register("events_json_flatten", "id:i product_name:s price:d created:t", """
select event_id as id, json_extract_string(props, '$.k') as product_name, value as price,
       cast(ts as date) as created from events""")
def events_json_flatten(feed: TradeFeed) -> DataFrame:
    """The properties text stands for the optional nested product of a price record."""
    product = F.from_json("props", "k string")
    nested = feed.records().select(
        "id", F.lit(None).cast("string").alias("product_code"),
        F.struct(product["k"].alias("product_name")).alias("product"),
        F.col("event_type").alias("category_tag"), F.col("value").alias("price"),
        F.lit("EUR").alias("currency"), F.col("created").cast("date").cast("string").alias("date"),
        F.lit(None).cast("string").alias("location_osm_display_name"),
        F.col("created").cast("date").cast("string").alias("created"))
    return open_prices.flatten(nested)


@register("incremental_delta", "id:i created:t value:d new_watermark:t", """
select event_id as id, ts as created, value, max(ts) over () as new_watermark
from (select *, row_number() over (partition by event_id order by ts desc, value desc) as n from events
      where ts >= timestamp '2024-01-03 00:00:00') where n = 1""")
def incremental_delta(feed: TradeFeed) -> DataFrame:
    young = open_prices.delta(feed.records(), "2024-01-03 00:00:00")
    newest = feed.records().agg(F.max("created").alias("m"))
    return young.withColumn("new_watermark", newest.scalar())


@register("rebase_dates", "time_id:i full_date:s", """
select time_id, strftime(full_date + ((date '2026-01-14' - (select max(full_date) from days))
                                      * interval 1 day), '%Y-%m-%d') as full_date from days""")
def rebase_dates(feed: TradeFeed) -> DataFrame:
    return catalog_files.rebase_dates(feed.raw_time(), dt.date(2026, 1, 15))


@register("landing_manifest", "source:s dataset:s load_date:s rows:i", """
select 'trade' as source, 'products' as dataset, '2001-11-05' as load_date, count(*) as rows from part
union all select 'trade', 'price_facts', '2001-11-05', count(*) from lineitem
union all select 'trade', 'time', '2001-11-05', count(*) from days""")
def landing_manifest(feed: TradeFeed) -> DataFrame:
    """Lands all three datasets, one of them twice; the second landing replaces the first."""
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    landings = {"products": feed.raw_products(), "price_facts": feed.raw_facts(),
                "time": feed.raw_time()}
    for dataset, frame in [*landings.items(), ("products", feed.raw_products())]:
        lake.land(frame, "trade", dataset, str(AS_OF))
    return lake.manifests()


# ---- catalog onboarding ----
def _price_text(price, thousands_mark=","):
    cents = F.round(price * 100).cast("bigint")
    whole = F.floor(cents / 100)
    return F.concat(
        F.lit(' "'), F.floor(whole / 1000).cast("string"), F.lit(thousands_mark),
        F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"), F.lit('" '))


def export_of(feed: TradeFeed) -> DataFrame:
    """The parts as a marketplace export: prices as quoted text, categories as JSON, gaps throughout."""
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    quoted = F.concat(F.lit('["'), F.col("p_type"), F.lit('", 1, " ", "'), F.col("p_brand"),
                      F.lit('"]'))
    return feed.table("part").select(
        key.alias("row"),
        F.col("p_name").alias("title"),
        F.when(key % 4 != 0, F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))).alias("brand"),
        F.when(key % 8 != 0, F.when(key % 3 == 0, " ").otherwise("Maker")).alias("manufacturer"),
        F.when(key % 7 != 0, F.when(key % 11 == 0, F.lit("n/a")).otherwise(_price_text(price)))
        .alias("final_price"),
        F.when(key % 14 == 0, "-5").when(key % 77 != 11, _price_text(price + 1))
        .alias("initial_price"),
        F.when(key % 5 == 0, "[]").when(key % 9 == 0, "not json").when(key % 13 != 0, quoted)
        .alias("categories"),
        F.when(key % 6 != 0, F.when(key % 10 == 3, "nan").otherwise(
            (F.col("p_size").cast("double") / 7).cast("string"))).alias("rating"),
        F.concat(F.lit("https://img.example/"), key.cast("string")).alias("image_url"),
        F.concat(F.lit("A"), key.cast("string")).alias("asin"),
        F.concat(F.lit("https://shop.example/"), key.cast("string")).alias("url"),
    )


CLEAN_SQL = """
select p_partkey as row, p_name as name,
       case when p_partkey % 7 <> 0 and p_partkey % 11 <> 0 then round(p_retailprice, 2)
            when p_partkey % 14 = 0 then null
            when p_partkey % 77 <> 11 then round(p_retailprice + 1, 2) end as base_price,
       case when p_partkey % 6 <> 0 and p_partkey % 10 <> 3 then cast(p_size as double) / 7 end as base_rating,
       case when p_partkey % 4 <> 0 then p_brand when p_partkey % 8 = 0 then 'Unbranded'
            when p_partkey % 3 = 0 then 'Unbranded' else 'Maker' end as brand,
       case when p_partkey % 5 = 0 or p_partkey % 9 = 0 or p_partkey % 13 = 0
            then 'General Merchandise' else p_type end as category,
       case when p_partkey % 5 = 0 or p_partkey % 9 = 0 or p_partkey % 13 = 0
            then 'General' else p_brand end as subcategory
from part"""
IMPUTED_SQL = f"""
select row, name, category, subcategory, brand,
       round(coalesce(base_price, median(base_price) over ()), 2) as base_price,
       round(least(greatest(coalesce(base_rating, median(base_rating) over ()), 1), 5)
             + cast(1e-9 as double), 1) as base_rating
from ({CLEAN_SQL})"""


@register("catalog_clean_price", "row:i base_price:d", CLEAN_SQL)
def catalog_clean_price(feed: TradeFeed) -> DataFrame:
    return export_of(feed).select("row", onboarding.price_of(
        F.col("final_price"), F.col("initial_price")).alias("base_price"))


@register("catalog_categories", "row:i category:s subcategory:s", CLEAN_SQL)
def catalog_categories(feed: TradeFeed) -> DataFrame:
    department, node = onboarding.category_path(F.col("categories"))
    return export_of(feed).select("row", department.alias("category"), node.alias("subcategory"))


@register("catalog_brand", "row:i brand:s", CLEAN_SQL)
def catalog_brand(feed: TradeFeed) -> DataFrame:
    return export_of(feed).select(
        "row", onboarding.brand_of(F.col("brand"), F.col("manufacturer")).alias("brand"))


@register("catalog_impute", "row:i base_price:d base_rating:d", IMPUTED_SQL)
def catalog_impute(feed: TradeFeed) -> DataFrame:
    rows = export_of(feed).select(
        "row", onboarding.price_of(F.col("final_price"), F.col("initial_price")).alias("base_price"),
        F.col("rating").try_cast("double").alias("base_rating"))
    return onboarding.impute(cut(rows, "priced"))


@register("catalog_dense_id", "product_id:i row:i", f"""
select row_number() over (order by row) as product_id, row from ({CLEAN_SQL})
where name is not null and base_price is not null""")
def catalog_dense_id(feed: TradeFeed) -> DataFrame:
    rows = export_of(feed).select(
        "row", onboarding.price_of(F.col("final_price"), F.col("initial_price")).alias("base_price"))
    return ranks.dense_ids(rows.dropna(subset=["base_price"]), "row", "product_id")


@register("catalog_onboard", "product_id:i name:s category:s subcategory:s brand:s base_price:d "
          "base_rating:d", f"""
select row_number() over (order by row) as product_id, name, category, subcategory, brand, base_price,
       base_rating from ({IMPUTED_SQL})""")
def catalog_onboard(feed: TradeFeed) -> DataFrame:
    return onboarding.onboard(export_of(feed))


@register("catalog_profile", "category:s products:i catalog_brands:i", f"""
select category, count(*) as products, (select count(distinct brand) from ({CLEAN_SQL}))
  as catalog_brands from ({CLEAN_SQL}) group by category""")
def catalog_profile(feed: TradeFeed) -> DataFrame:
    department, _ = onboarding.category_path(F.col("categories"))
    return onboarding.profile(export_of(feed).select(
        department.alias("category"),
        onboarding.brand_of(F.col("brand"), F.col("manufacturer")).alias("brand")))


# ---- bronze ----
@register("bronze_dedup_keep_last", "fact_id:i product_id:i time_id:i price:d sales_velocity:d",
          "select * from last_facts")
def bronze_dedup_keep_last(feed: TradeFeed) -> DataFrame:
    return feed.last_facts()


@register("bronze_normalise_date", "time_id:i full_date:t", "select * from days")
def bronze_normalise_date(feed: TradeFeed) -> DataFrame:
    return normalise_time(feed.raw_time())


def dirty_products(feed: TradeFeed) -> DataFrame:
    key = F.col("product_id")
    return feed.raw_products().withColumns({
        "name": F.when(key % 13 == 1, "").otherwise(F.col("name")),
        "category": F.when(key % 23 != 1, F.col("category")),
        "base_price": F.when(key % 17 == 1, -F.col("base_price")).otherwise(F.col("base_price")),
        "base_rating": F.when(key % 19 == 1, 9.0).otherwise(F.col("base_rating")),
    })


@register("contract_products_reasons", "product_id:i reason:s", """
select product_id, case when product_id <= 0 then 'gt_0:product_id'
  when length(name) < 1 then 'min_length_1:name' when category is null then 'not_null:category'
  when base_price <= 0 then 'gt_0:base_price'
  when not (base_rating between 0 and 5) then 'between_0_5:base_rating' end as reason
from dirty_products""")
def contract_products_reasons(feed: TradeFeed) -> DataFrame:
    return PRODUCTS.annotate(dirty_products(feed)).withColumnRenamed(REASON, "reason")


@register("contract_facts_reasons", "fact_id:i reason:s", "select fact_id, reason from fact_reasons")
def contract_facts_reasons(feed: TradeFeed) -> DataFrame:
    return PRICE_FACTS.annotate(feed.last_facts(), check_unique=False).withColumnRenamed(
        REASON, "reason")


@register("contract_valid_count", "valid:i rejected:i", """
select count(*) filter (where reason is null) as valid,
       count(*) filter (where reason is not null) as rejected from fact_reasons""")
def contract_valid_count(feed: TradeFeed) -> DataFrame:
    marked = PRICE_FACTS.annotate(feed.last_facts(), check_unique=False)
    return marked.agg(F.count_if(F.col(REASON).isNull()).alias("valid"),
                      F.count_if(F.col(REASON).isNotNull()).alias("rejected"))


@register("contract_coerce", "product_id:i base_price:d base_rating:d reason:s", """
select product_id, case when product_id % 11 = 3 then null else base_price end as base_price,
       base_rating, case when product_id <= 0 then 'gt_0:product_id'
                         when product_id % 11 = 3 then 'coerce:base_price' end as reason
from raw_products""")
def contract_coerce(feed: TradeFeed) -> DataFrame:
    """Everything arrives as text, some prices not numbers, and one column nobody declared."""
    raw = feed.raw_products()
    texts = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    texts = texts.withColumn("base_price", F.when(
        F.col("product_id").cast("bigint") % 11 == 3, "n/a").otherwise(F.col("base_price")))
    marked = PRODUCTS.annotate(texts.withColumn("undeclared", F.lit(1)))
    typed = [F.col(r.column).try_cast(r.type).alias(r.column) for r in PRODUCTS.rules]
    return marked.select(*typed, F.col(REASON).alias("reason"))


@register("contract_unique", "reason:s rows:i", """
select case when fact_id <= 0 then 'gt_0:fact_id' when n > 1 then 'unique:fact_id' end as reason,
       count(*) as rows
from (select fact_id, count(*) over (partition by fact_id) as n from raw_facts) group by 1
having reason is null or reason like '%:fact_id'""")
def contract_unique(feed: TradeFeed) -> DataFrame:
    """Contract uniqueness on raw facts, before deduplication; later rules left out."""
    only = type(PRICE_FACTS)("facts_key", PRICE_FACTS.rules[:1])
    marked = only.annotate(feed.raw_facts())
    return marked.groupBy(F.col(REASON).alias("reason")).agg(F.count("*").alias("rows"))


@register("bronze_counts", "products:i time:i price_facts:i rejected:i", """
select (select count(*) from bronze_products) as products, (select count(*) from days) as time,
       (select count(*) from bronze_facts) as price_facts,
       (select count(*) from fact_reasons where reason is not null)
       + (select count(*) from raw_products) - (select count(*) from bronze_products) as rejected""")
def bronze_counts(feed: TradeFeed) -> DataFrame:
    """All four counts from one pass over each source."""
    def tally(marked: DataFrame) -> DataFrame:
        return marked.agg(F.count_if(F.col(REASON).isNull()).alias("ok"),
                          F.count_if(F.col(REASON).isNotNull()).alias("bad"))

    facts = tally(PRICE_FACTS.annotate(feed.last_facts(), check_unique=False))
    products = tally(PRODUCTS.annotate(feed.raw_products()))
    days = feed.time.agg(F.count("*").alias("n"))
    pair = products.select(F.struct("ok", "bad").alias("p")).scalar()
    return facts.withColumn("p", pair).select(
        F.col("p.ok").alias("products"), days.scalar().alias("time"), F.col("ok").alias("price_facts"),
        (F.col("bad") + F.col("p.bad")).alias("rejected"))


# ---- silver ----
@register("conform_category", "product_id:i category:s subcategory:s", """
select product_id, case when regexp_matches(lower(name), 'bolt|ring|rod|plate') then 'Hardware'
  when regexp_matches(lower(name), 'gizmo|widget') then 'Gadgets' else 'General Merchandise' end
  as category, case when regexp_matches(lower(name), 'bolt|ring') then 'Fasteners'
  when regexp_matches(lower(name), 'rod|plate') then 'Bar stock'
  when regexp_matches(lower(name), 'gizmo|widget') then 'Gadgets' else 'General' end as subcategory
from raw_products""")
def conform_category(feed: TradeFeed) -> DataFrame:
    category, subcategory = text.category_of(F.col("name"), RULES)
    return feed.raw_products().select(
        "product_id", category.alias("category"), subcategory.alias("subcategory"))


@register("conform_brand", "product_id:i brand:s", """
select product_id, case when name ilike '%red%' then 'Red' when name ilike '%blue%' then 'Blue'
  when name ilike '%hot%' then 'Hot' when name ilike '%cold%' then 'Cold'
  when name ilike '%old%' then 'Old' else 'House Brand' end as brand from raw_products""")
def conform_brand(feed: TradeFeed) -> DataFrame:
    return feed.raw_products().select(
        "product_id", text.brand_of(F.col("name"), LEXICON).alias("brand"))


@register("conform_audience", "product_id:i audience:s", """
select product_id, case when product_id % 5 = 0 then 'Infants' when product_id % 5 = 1 then 'Mens'
  when product_id % 5 = 2 then 'Infants' else 'Unisex' end as audience from raw_products""")
def conform_audience(feed: TradeFeed) -> DataFrame:
    prefix = F.element_at(F.array(*[F.lit(w) for w in ("Infant ", "Mens ", "Infants ", "mens ", "")]),
                          (F.col("product_id") % 5).cast("int") + 1)
    named = feed.raw_products().withColumn("name", F.concat(prefix, F.col("name")))
    return named.select("product_id", text.audience_of(F.col("name")).alias("audience"))


@register("conform_colors", "product_id:i color_options:s", """
select product_id, case when product_id % 6 > 0 then split_part(subcategory, chr(39), 2) || '|'
  || split_part(subcategory, chr(39), 4) end as color_options from raw_products""")
def conform_colors(feed: TradeFeed) -> DataFrame:
    raw = F.when(F.col("product_id") % 6 > 0, F.col("subcategory")).otherwise("no colours here")
    return feed.raw_products().select("product_id", text.color_options(raw).alias("color_options"))


PRODUCT = ("product_id:i product_name:s category:s subcategory:s brand:s audience:s color_options:s "
           "base_price:d base_rating:d image_url:s source_category:s source_brand:s")


@register("silver_products", PRODUCT, "select * from products")
def silver_products(feed: TradeFeed) -> DataFrame:
    return feed.conformed()


@register("silver_time_join", "fact_id:i product_id:i observed_date:t price:d",
          "select *, full_date as observed_date from bronze_facts join days using (time_id)")
def silver_time_join(feed: TradeFeed) -> DataFrame:
    return resolve_dates(feed.bronze_facts()[0], feed.time)


@register("silver_observations", OBSERVATION, OBSERVATION_SQL)
def silver_observations(feed: TradeFeed) -> DataFrame:
    return feed.observed()


# ---- gold ----
KEY = "product_id:i observed_date:t "


def _with_key(feed: TradeFeed, **columns) -> DataFrame:
    return feed.observations.select(
        "product_id", "observed_date", *[c.alias(name) for name, c in columns.items()])


@register("feat_lags", KEY + "price_lag_1:d price_lag_7:d velocity_lag_1:d", "select * from features")
def feat_lags(feed: TradeFeed) -> DataFrame:
    return _with_key(feed, price_lag_1=features.lagged("price", 1),
                     price_lag_7=features.lagged("price", 7),
                     velocity_lag_1=features.lagged("sales_velocity", 1))


@register("feat_rolling_mean", KEY + "price_ma_7:d price_ma_30:d velocity_ma_7:d",
          "select * from features")
def feat_rolling_mean(feed: TradeFeed) -> DataFrame:
    return _with_key(feed, price_ma_7=features.rolling_mean("price", 7),
                     price_ma_30=features.rolling_mean("price", 30),
                     velocity_ma_7=features.rolling_mean("sales_velocity", 7))


@register("feat_rolling_std", KEY + "price_std_7:d", "select * from features")
def feat_rolling_std(feed: TradeFeed) -> DataFrame:
    return _with_key(feed, price_std_7=features.rolling_std("price", 7))


@register("feat_pct_change", KEY + "price_pct_change:d", "select * from features")
def feat_pct_change(feed: TradeFeed) -> DataFrame:
    return _with_key(feed, price_pct_change=features.pct_change("price"))


@register("feat_calendar", KEY + "day_of_week:i is_weekend:b month_num:i", "select * from features")
def feat_calendar(feed: TradeFeed) -> DataFrame:
    return _with_key(feed, **features.calendar())


@register("product_daily_features", OBSERVATION + " price_lag_1:d price_lag_7:d price_ma_7:d "
          "price_ma_30:d price_std_7:d price_pct_change:d velocity_lag_1:d velocity_ma_7:d "
          "day_of_week:i is_weekend:b month_num:i", "select * from features")
def product_daily_features(feed: TradeFeed) -> DataFrame:
    return features.daily_features(feed.observations.drop("month"))


CATEGORY_DAY = ("products_observed:i avg_price:d min_price:d max_price:d avg_discount:d "
                "total_sales_velocity:d")


@register("gold_category_daily", "category:s observed_date:t " + CATEGORY_DAY, """
select category, observed_date, count(*) as products_observed, avg(price) as avg_price,
       min(price) as min_price, max(price) as max_price, avg(discount_percentage) as avg_discount,
       sum(sales_velocity) as total_sales_velocity
from observations join products using (product_id) group by 1, 2""")
def gold_category_daily(feed: TradeFeed) -> DataFrame:
    return features.category_daily(feed.observations, feed.products)


@register("product_profile", "product_id:i avg_price:d price_volatility:d avg_discount:d avg_rating:d "
          "avg_velocity:d", "select * from profile")
def product_profile(feed: TradeFeed) -> DataFrame:
    return features.product_profile(feed.observations)


# ---- quality ----
def dirty_observations(feed: TradeFeed) -> DataFrame:
    """Raw facts on their days: repeated keys, missing prices, broken discounts, unfair prices."""
    stock = F.col("stock_level")
    return resolve_dates(feed.raw_facts(), feed.time).select(
        "fact_id", "product_id", "observed_date",
        F.when(F.col("review_count") % 50 != 0, F.col("price")).alias("price"),
        F.when(stock == 2, F.col("original_price") / 2)
        .when(stock != 1, F.col("original_price")).alias("original_price"),
        F.when(stock == 3, F.col("discount_percentage") + 60)
        .otherwise(F.col("discount_percentage")).alias("discount_percentage"),
        "rating")


COMPLETENESS = """1 - sum(cast(product_id is null as int) + cast(observed_date is null as int)
  + cast(price is null as int)) / (3.0 * count(*))"""
UNIQUENESS = """(select count(*) from (select distinct product_id, observed_date
  from dirty_observations)) / cast(count(*) as double)"""
VALIDITY = """avg(case when price > 0 and discount_percentage between 0 and 95
  and (rating is null or rating between 0 and 5) then 1.0 else 0.0 end)"""
CONSISTENCY = """count(*) filter (where price <= original_price * 1.001)
  / cast(count(original_price) as double)"""
FRESHNESS = "greatest(0.0, 1 - (date '2001-11-05' - max(observed_date)) / 30.0)"
DIMENSIONS = {"completeness": COMPLETENESS, "uniqueness": UNIQUENESS, "validity": VALIDITY,
              "consistency": CONSISTENCY, "freshness": FRESHNESS}


def _dimension(name: str):
    @register(f"dq_{name}", f"{name}:d", f"select {DIMENSIONS[name]} as {name} from dirty_observations")
    def plan(feed: TradeFeed) -> DataFrame:
        return quality.dimensions(dirty_observations(feed), AS_OF).select(name)


for _name in DIMENSIONS:
    _dimension(_name)


REPORT = ("completeness:d uniqueness:d validity:d consistency:d freshness:d "
          "composite_score:d rows_evaluated:i rejected_rows:i")
REPORT_SQL = f"""
select *, round(0.25 * completeness + 0.25 * uniqueness + 0.20 * validity + 0.15 * consistency
                + 0.15 * freshness, 4) as composite_score
from (select round({COMPLETENESS}, 4) as completeness, round({UNIQUENESS}, 4) as uniqueness,
             round({VALIDITY}, 4) as validity, round({CONSISTENCY}, 4) as consistency,
             round({FRESHNESS}, 4) as freshness, count(*) as rows_evaluated,
             (select count(*) from fact_reasons where reason is not null) as rejected_rows
      from dirty_observations)"""


@register("quality_report", REPORT, REPORT_SQL)
def quality_report(feed: TradeFeed) -> DataFrame:
    rejected = feed.bronze_facts()[1].agg(F.count("*").alias("n")).scalar()
    return quality.quality_report(dirty_observations(feed), AS_OF, rejected)


@register("quality_report_from_state", REPORT, REPORT_SQL)
def quality_report_from_state(feed: TradeFeed) -> DataFrame:
    """Three deliveries of whole days, the last of which brings some days again; the report reads the daily state alone."""
    rejected = feed.bronze_facts()[1].agg(F.count("*").alias("n")).scalar()
    rows, day = dirty_observations(feed), F.coalesce(F.col("observed_date"), F.lit("1970-01-01").cast("date"))
    state = cut(quality.daily_counts(rows.filter(day <= F.lit("1998-07-01"))), "quality-state")
    for low, high in (("1998-07-01", "2000-03-01"), ("2000-02-01", "9999-12-31")):
        fresh = quality.daily_counts(rows.filter((day > F.lit(low)) & (day <= F.lit(high))))
        state = cut(quality.merged_counts(state, cut(fresh, "quality-days")), "quality-state")
    return quality.quality_report_of(state, AS_OF, rejected)


@register("features_incremental", OBSERVATION + " price_lag_1:d price_lag_7:d price_ma_7:d "
          "price_ma_30:d price_std_7:d price_pct_change:d velocity_lag_1:d velocity_ma_7:d "
          "day_of_week:i is_weekend:b month_num:i", "select * from features")
def features_incremental(feed: TradeFeed) -> DataFrame:
    """A first load and two increments, each computed from its days and the tail of the series."""
    rows, day = feed.observations.drop("month"), F.col("observed_date")
    first = rows.filter(day <= F.lit("1998-07-01"))
    made, tail = cut(features.daily_features(first), "features"), cut(features.series_tail(first), "series-tail")
    for low, high in (("1998-07-01", "2000-03-01"), ("2000-03-01", "9999-12-31")):
        found, next_tail = features.increment(tail, rows.filter((day > F.lit(low)) & (day <= F.lit(high))))
        made, tail = made.unionByName(cut(found, "features")), cut(next_tail, "series-tail")
    return made


@register("check_not_null", "fact_id:i observed_date:t",
          "select * from dirty_observations where price is null")
def check_not_null(feed: TradeFeed) -> DataFrame:
    return checks.not_null(dirty_observations(feed), "price")


@register("check_unique", "fact_id:i n:i",
          "select fact_id, count(*) as n from dirty_observations group by 1 having count(*) > 1")
def check_unique(feed: TradeFeed) -> DataFrame:
    return checks.unique(dirty_observations(feed), "fact_id")


@register("check_relationships", "from_key:i", """
select distinct product_id as from_key from dirty_observations
where product_id is not null and product_id not in (select product_id from products)""")
def check_relationships(feed: TradeFeed) -> DataFrame:
    return checks.relationships(dirty_observations(feed), "product_id", feed.products, "product_id")


@register("check_grain", "product_id:i observed_date:t n:i", """
select product_id, observed_date, count(*) as n from dirty_observations group by 1, 2
having count(*) > 1""")
def check_grain(feed: TradeFeed) -> DataFrame:
    return checks.unique_grain(dirty_observations(feed), ["product_id", "observed_date"])
