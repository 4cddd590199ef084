"""Row-offset time-series features and product profiles.

All series windows share one specification, so the whole feature table costs one exchange. A series is
at most one row per calendar day (the declared grain of the observations), which bounds what a window
task holds for one product to the number of days on record, whatever share of the raw facts it had.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pricelake.functions import dates, numbers


def series() -> WindowSpec:
    return Window.partitionBy("product_id").orderBy("observed_date")


def lagged(column: str, rows: int) -> Column:
    return F.lag(column, rows).over(series())


def _full(column: str, rows: int, statistic: Callable, before: int) -> Column:
    frame = series().rowsBetween(-(rows - 1) - before, -before)
    return F.when(F.count(column).over(frame) >= rows, statistic(column).over(frame))


def rolling_mean(column: str, rows: int, before: int = 0) -> Column:
    """Mean of the last `rows` rows, null until the window is full; `before` rows are left out."""
    return _full(column, rows, F.avg, before)


def rolling_std(column: str, rows: int, before: int = 0) -> Column:
    return _full(column, rows, F.stddev_samp, before)


def pct_change(column: str) -> Column:
    previous = lagged(column, 1)
    return numbers.ratio(F.col(column) - previous, previous) * 100


def calendar(day: str = "observed_date") -> dict[str, Column]:
    return {
        "day_of_week": dates.iso_weekday(F.col(day)),
        "is_weekend": dates.is_weekend(F.col(day)),
        "month_num": F.month(day),
    }


def daily_features(observations: DataFrame) -> DataFrame:
    """The feature table: every observation with its lags, rolling statistics and calendar."""
    return observations.select(
        *observations.columns,
        lagged("price", 1).alias("price_lag_1"),
        lagged("price", 7).alias("price_lag_7"),
        rolling_mean("price", 7).alias("price_ma_7"),
        rolling_mean("price", 30).alias("price_ma_30"),
        rolling_std("price", 7).alias("price_std_7"),
        pct_change("price").alias("price_pct_change"),
        lagged("sales_velocity", 1).alias("velocity_lag_1"),
        rolling_mean("sales_velocity", 7).alias("velocity_ma_7"),
        *[c.alias(name) for name, c in calendar().items()],
    )


REACH = 30      # rows that the longest window looks at, its own included


def series_tail(observations: DataFrame, rows: int = REACH) -> DataFrame:
    """The newest rows of each series: all that features of later days need of the past."""
    newest = Window.partitionBy("product_id").orderBy(F.desc("observed_date"))
    return observations.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= rows).drop("_back")


def increment(tail: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feature rows of days later than the tail's, and the next tail; what is stored is not read again.

    A product's fresh days must follow its stored ones; a product with late days is computed anew from its series.
    """
    both = tail.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
    made = daily_features(both).filter("_fresh").drop("_fresh")
    return made, series_tail(both.drop("_fresh"))


def category_daily(observations: DataFrame, products: DataFrame) -> DataFrame:
    """Market aggregate per category and day; observations of unknown products do not count."""
    named = observations.join(products.select("product_id", "category"), "product_id")
    return named.groupBy("category", "observed_date").agg(
        F.count("*").alias("products_observed"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("discount_percentage").alias("avg_discount"),
        F.sum("sales_velocity").alias("total_sales_velocity"),
    )


def product_profile(observations: DataFrame) -> DataFrame:
    """Price level, relative volatility, discount, rating and velocity per product; gaps are 0."""
    raw = observations.groupBy("product_id").agg(
        F.avg("price").alias("avg_price"),
        numbers.ratio(F.stddev_samp("price"), F.avg("price")).alias("price_volatility"),
        F.avg("discount_percentage").alias("avg_discount"),
        F.avg("rating").alias("avg_rating"),
        F.avg("sales_velocity").alias("avg_velocity"),
    )
    return raw.select("product_id", *[
        numbers.zero_if_missing(F.col(c)).alias(c) for c in raw.columns if c != "product_id"])
