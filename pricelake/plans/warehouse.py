"""Star schema and marts over the silver layer. Every function maps DataFrames to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.functions import dates, numbers
from pricelake.operators.dedup import keep_last
from pricelake.schemas import OBSERVATION_COLUMNS, STAGED_PRODUCT_COLUMNS
from pricelake.sources.lake import Lake


def stage_products(products: DataFrame) -> DataFrame:
    return products.select(*STAGED_PRODUCT_COLUMNS)


def stage_observations(observations: DataFrame) -> DataFrame:
    return observations.select(*OBSERVATION_COLUMNS)


def dim_product(history: DataFrame) -> DataFrame:
    """Product dimension: surrogate key, the first version backdated, open versions to 9999-12-31.

    The key hashes the validity start as recorded, before backdating.
    """
    first = F.row_number().over(Window.partitionBy("product_id").orderBy("valid_from")) == 1
    key = F.md5(F.concat_ws("|", F.col("product_id").cast("string"),
                            F.col("valid_from").cast("string")))
    return history.select(
        key.alias("product_sk"),
        F.col("product_id").alias("product_nk"),
        *[c for c in STAGED_PRODUCT_COLUMNS if c != "product_id"],
        F.when(first, F.lit("1900-01-01").cast("timestamp"))
        .otherwise(F.col("valid_from")).alias("valid_from"),
        F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp")).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_date(observations: DataFrame, extra_days: int = fixed.DIM_DATE_EXTRA_DAYS) -> DataFrame:
    """Every day from the first observation to `extra_days` after the last."""
    bounds = observations.agg(
        F.min("observed_date").alias("lo"),
        F.date_add(F.max("observed_date"), extra_days).alias("hi"),
    )
    day = F.col("full_date")
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("full_date")).select(
        dates.day_key(day).alias("date_sk"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.monday_week(day).alias("week_of_year"),
        dates.iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dates.is_weekend(day).alias("is_weekend"),
    )


def fact_price_observation(observations: DataFrame, dim: DataFrame) -> DataFrame:
    """Observations under the product version valid on their day.

    The product key is an equality, so the join shuffles (or broadcasts, by size) on it and the validity
    interval is a residual test against the few versions of one product.
    """
    versions = dim.select(
        "product_sk", "product_nk",
        F.col("valid_from").cast("date").alias("_from"), F.col("valid_to").cast("date").alias("_to"))
    day = F.col("observed_date")
    matched = observations.join(
        versions,
        (F.col("product_id") == F.col("product_nk")) & (day >= F.col("_from")) & (day < F.col("_to")))
    measures = [c for c in OBSERVATION_COLUMNS if c not in ("product_id", "observed_date")]
    return matched.select("product_sk", "product_nk", dates.day_key(day).alias("date_sk"), *measures)


def late_floor(target: DataFrame, days: int = fixed.LATE_ARRIVAL_DAYS,
               compat: bool = False) -> DataFrame:
    """One row `floor`: facts with a greater date_sk are young enough; 0 where the target is empty.

    Days are calendar days. `compat=True` subtracts from the yyyymmdd integer instead, which at the start
    of a month does not reach into the month before.
    """
    newest = target.agg(F.max("date_sk").alias("newest"))
    if compat:
        return newest.select(F.coalesce(F.col("newest") - days, F.lit(0)).alias("floor"))
    last = F.to_date(F.col("newest").cast("string"), "yyyyMMdd")
    return newest.select(F.coalesce(dates.day_key(F.date_sub(last, days)), F.lit(0)).alias("floor"))


def late_window(facts: DataFrame, target: DataFrame, days: int = fixed.LATE_ARRIVAL_DAYS,
                compat: bool = False) -> DataFrame:
    """Facts young enough to be (re)loaded into `target`; all of them where it is empty."""
    return facts.filter(F.col("date_sk") > late_floor(target, days, compat).scalar())


def young_months(observations: DataFrame, target: DataFrame,
                 days: int = fixed.LATE_ARRIVAL_DAYS) -> DataFrame:
    """Observations of the months the late window reaches into. On a table partitioned by month the
    filter prunes partitions at run time, so an increment does not read the history."""
    floor = F.lpad(F.col("floor").cast("string"), 8, "0")
    month = late_floor(target, days).select(
        F.concat(floor.substr(1, 4), F.lit("-"), floor.substr(5, 2)).alias("month"))
    return observations.filter(F.col("month") >= month.scalar())


def replace_days(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Delete-and-insert by day: the target without the days of the batch, plus the batch.

    The days are at most the calendar days on record, so they are broadcast and the target stays put.
    """
    days = F.broadcast(batch.select("date_sk").distinct())
    return target.join(days, "date_sk", "left_anti").select(*target.columns).unionByName(batch)


def latest_per_product(facts: DataFrame) -> DataFrame:
    return keep_last(facts, ["product_nk"], ["date_sk"])


def trending_deals(facts: DataFrame, dim: DataFrame, calendar: DataFrame,
                   min_discount: float = fixed.DEAL_MIN_DISCOUNT) -> DataFrame:
    """Products whose latest observation is discounted enough, dearest discount first."""
    shown = facts.select("product_sk", "product_nk", "date_sk", "price", "original_price", "discount_percentage", "rating")
    latest = latest_per_product(shown).filter(F.col("discount_percentage") >= min_discount)
    product = dim.select("product_sk", "product_name", "category", "brand", "image_url")
    return (
        latest.join(product, "product_sk")
        .join(calendar.select("date_sk", "full_date"), "date_sk")
        .select(
            F.col("product_nk").alias("product_id"),
            "product_name", "category", "brand", "image_url",
            F.col("price").alias("current_price"),
            "original_price", "discount_percentage", "rating",
            F.col("full_date").alias("observed_date"),
        )
        .orderBy(F.desc("discount_percentage"), "product_id")
    )


def product_performance(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Rollup per product over the facts of its current version only.

    Facts are reduced to one row per version before they meet the dimension, so the join moves products
    rather than observations. Listings are filtered and sorted by the means, so these do not depend on the order of rows.
    """
    rolled = facts.groupBy("product_sk").agg(
        numbers.mean("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        numbers.mean("rating").alias("avg_rating"),
        F.max("review_count").alias("total_reviews"),
        numbers.mean("discount_percentage").alias("avg_discount"),
        numbers.ratio(F.stddev_samp("price"), F.avg("price")).alias("price_volatility"),
        F.count("*").alias("data_points"),
        numbers.mean("sales_velocity").alias("avg_sales_velocity"),
    )
    current = dim.filter("is_current").select(
        "product_sk", F.col("product_nk").alias("product_id"), "product_name", "category",
        "subcategory", "brand", "audience", "image_url", "base_rating")
    return current.join(rolled, "product_sk").drop("product_sk")


def category_daily(facts: DataFrame, dim: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rollup per category and day. The calendar joins the rollup, not the facts.

    At the grain of the facts, one row per product and day, rows are products, so all aggregates combine
    before the shuffle and no product is moved.
    """
    rolled = (
        facts.join(dim.select("product_sk", "category"), "product_sk")
        .groupBy("category", "date_sk")
        .agg(
            F.count("*").alias("products_observed"),
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.avg("discount_percentage").alias("avg_discount"),
            F.sum("sales_velocity").alias("total_sales_velocity"),
        )
    )
    return rolled.join(calendar.select("date_sk", "full_date"), "date_sk").select(
        "category", "full_date", *[c for c in rolled.columns if c not in ("category", "date_sk")])


# ---- published scores: the columns each table shows to readers ----
PUBLISHED = {
    "ml_forecast": ["product_id", "forecast_date", "target", "yhat", "yhat_lower", "yhat_upper",
                    "model_run_id"],
    "ml_anomaly": ["product_id", "observed_date", "price", "price_pct_change", "robust_z",
                   "iforest_score", "anomaly_type", "model_run_id"],
    "ml_recommendation": ["product_id", "recommended_product_id", "rank", "similarity", "reason"],
    "product_segment": ["product_id", "product_name", "category", "brand", "segment_id",
                        "segment_name", *fixed.PROFILE_COLUMNS],
    "dq_report": ["computed_at", *fixed.QUALITY_WEIGHTS, "composite_score", "rows_evaluated",
                  "rejected_rows"],
}


def publish(name: str, scores: DataFrame) -> DataFrame:
    return scores.select(*PUBLISHED[name])


def store_forecast(lake: Lake, scores: DataFrame, target: str) -> int:
    """Replace the stored forecasts of one target; those of the others stay."""
    return lake.write(publish("ml_forecast", scores), "gold", "ml", f"forecast_{target}")


def stored_forecasts(lake: Lake) -> DataFrame:
    """The forecasts of every stored target as one table, whatever targets there are."""
    return lake.read("gold", "ml", "forecast_*").select(*PUBLISHED["ml_forecast"])
