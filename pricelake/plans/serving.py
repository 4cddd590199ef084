"""The read side: each function takes marts and parameters and returns a DataFrame.

Values reach the plan as literals and sort columns only from a list, so no text from a caller is ever parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed


def page_size_of(requested: int = fixed.PAGE_SIZE_DEFAULT) -> int:
    return min(requested, fixed.PAGE_SIZE_MAX)


def _matching(performance: DataFrame, category=None, brand=None, search=None, min_price=None,
              max_price=None, min_rating=None) -> DataFrame:
    found = performance
    if category:
        found = found.filter(F.col("category") == category)
    if brand:
        found = found.filter(F.col("brand") == brand)
    if search:
        wanted = search.lower()
        found = found.filter(F.lower("product_name").contains(wanted)
                             | F.lower("brand").contains(wanted))
    if min_price is not None:
        found = found.filter(F.col("avg_price") >= min_price)
    if max_price is not None:
        found = found.filter(F.col("avg_price") <= max_price)
    if min_rating is not None:
        found = found.filter(F.col("avg_rating") >= min_rating)
    return found


def _with_segment(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """The rows of a page, or of one product, with their segments.

    Segments are reduced to the products of the page before they are joined. There is one for every product, and files of
    few distinct values look small enough to broadcast, whatever their rows take in memory; the page's keys are a page.
    """
    shown = F.broadcast(rows.select("product_id"))
    own = segments.select("product_id", "segment_name").join(shown, "product_id", "left_semi")
    return rows.join(own, "product_id", "left")


def list_products(performance: DataFrame, segments: DataFrame, page: int = 1,
                  page_size: int = fixed.PAGE_SIZE_DEFAULT, sort_by: str = fixed.DEFAULT_SORT,
                  descending: bool = False, **filters) -> DataFrame:
    """One page of the filtered listing; equal sort values are ordered by product.

    The page is cut before the segment is looked up: the join then moves one page of rows.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    size = page_size_of(page_size)
    column = sort_by if sort_by in fixed.SORTABLE else fixed.DEFAULT_SORT
    order = [F.desc_nulls_last(column) if descending else F.asc_nulls_last(column), F.asc("product_id")]
    # limit before offset: after offset().limit() adaptive execution was seen to drop the last sort
    rows = _matching(performance, **filters).orderBy(*order).limit(page * size).offset(
        (page - 1) * size)
    return _with_segment(rows, segments).orderBy(*order)


def list_after(performance: DataFrame, segments: DataFrame, cursor: tuple | None = None,
               page_size: int = fixed.PAGE_SIZE_DEFAULT, sort_by: str = fixed.DEFAULT_SORT,
               descending: bool = False, **filters) -> DataFrame:
    """The page that follows a cursor, the (sort value, product_id) of the last row seen; the first page without one.

    However deep the page, each task keeps one page of rows and the filter skips what lies before the cursor.
    """
    if page_size < 1:
        raise ValueError("page_size starts at 1")
    column = sort_by if sort_by in fixed.SORTABLE else fixed.DEFAULT_SORT
    order = [F.desc_nulls_last(column) if descending else F.asc_nulls_last(column), F.asc("product_id")]
    rows = _matching(performance, **filters)
    if cursor is not None:
        value, last = cursor
        later = F.col("product_id") > F.lit(last)
        if value is None:       # products without a value come last
            rows = rows.filter(F.col(column).isNull() & later)
        else:
            beyond = F.col(column) < F.lit(value) if descending else F.col(column) > F.lit(value)
            rows = rows.filter(beyond | ((F.col(column) == F.lit(value)) & later) | F.col(column).isNull())
    return _with_segment(rows.orderBy(*order).limit(page_size_of(page_size)), segments).orderBy(*order)


def page_info(performance: DataFrame, page: int = 1, page_size: int = fixed.PAGE_SIZE_DEFAULT,
              **filters) -> DataFrame:
    """Total of the filtered listing and the page arithmetic; never less than one page."""
    size = page_size_of(page_size)
    return _matching(performance, **filters).agg(F.count("*").alias("total")).select(
        F.lit(page).alias("page"),
        F.lit(size).alias("page_size"),
        "total",
        F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("total_pages"),
    )


def product(performance: DataFrame, segments: DataFrame, product_id: int) -> DataFrame:
    """The product with its segment, or no row."""
    return _with_segment(performance.filter(F.col("product_id") == product_id), segments)


def price_history(facts: DataFrame, calendar: DataFrame, product_id: int) -> DataFrame:
    return (
        facts.filter(F.col("product_nk") == product_id)
        .join(calendar.select("date_sk", "full_date"), "date_sk")
        .select(F.col("full_date").alias("observed_date"), "price", "original_price",
                "discount_percentage", "rating", "sales_velocity")
        .orderBy("observed_date")
    )


def forecast(forecasts: DataFrame, product_id: int, target: str = "price") -> DataFrame:
    return (
        forecasts.filter((F.col("product_id") == product_id) & (F.col("target") == target))
        .select("forecast_date", "yhat", "yhat_lower", "yhat_upper", "model_run_id")
        .orderBy("forecast_date")
    )


def recommendations(recommended: DataFrame, performance: DataFrame, product_id: int) -> DataFrame:
    picks = recommended.filter(F.col("product_id") == product_id).select(
        F.col("recommended_product_id").alias("product_id"), "rank", "similarity", "reason")
    named = performance.select("product_id", "product_name", "category", "brand", "avg_price",
                               "avg_rating", "image_url")
    return picks.join(named, "product_id").orderBy("rank")


def anomalies(found: DataFrame, performance: DataFrame, limit: int = 50) -> DataFrame:
    """The most severe anomalies of the listed products."""
    return (
        found.join(performance.select("product_id", "product_name", "category"), "product_id")
        .select("product_id", "product_name", "category", "observed_date", "price",
                "price_pct_change", "robust_z", "iforest_score", "anomaly_type")
        .orderBy(F.abs("robust_z").desc_nulls_last(), "product_id", "observed_date")
        .limit(limit)
    )


def top_deals(deals: DataFrame, limit: int = 20) -> DataFrame:
    return deals.orderBy(F.desc("discount_percentage"), "product_id").limit(limit)


def category_daily(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy("category", "full_date")


def facets(performance: DataFrame, segments: DataFrame) -> DataFrame:
    """(facet, value): the distinct categories, brands and segments to filter by."""
    def values(df: DataFrame, facet: str, column: str) -> DataFrame:
        return df.select(F.lit(facet).alias("facet"), F.col(column).alias("value")).distinct()

    return (
        values(performance, "categories", "category")
        .unionByName(values(performance.filter(F.col("brand").isNotNull()), "brands", "brand"))
        .unionByName(values(segments, "segments", "segment_name"))
        .orderBy("facet", "value")
    )


def kpis(dim: DataFrame, performance: DataFrame, facts: DataFrame, deals: DataFrame,
         anomalies_found: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """One row of headline numbers, the newest quality report's columns included where there is one."""
    market = performance.agg(
        F.count_distinct("category").alias("categories"),
        F.count_distinct("brand").alias("brands"),
        F.round(F.avg("avg_price"), 2).alias("avg_price"),
        F.round(F.avg("avg_discount"), 2).alias("avg_discount"),
    )

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*").alias("n")).scalar()

    row = market.select(
        rows(dim.filter("is_current")).alias("products"),
        "categories", "brands",
        rows(facts).alias("warehouse_rows"),
        rows(deals).alias("active_deals"),
        rows(anomalies_found).alias("anomalies"),
        "avg_price", "avg_discount",
    )
    if reports is None:
        return row
    newest = latest_quality(reports)
    return row.withColumn("quality", newest.select(F.struct(*newest.columns).alias("q")).scalar())


def insights(rollup: DataFrame) -> DataFrame:
    """Mean daily price of each category, last 7 days against the 7 before, largest change first.

    A category has at most one row per day, which bounds the window.
    """
    latest = F.max("full_date").over(Window.partitionBy("category"))
    age = F.datediff(latest, "full_date")
    pair = (
        rollup.select("category", "avg_price", age.alias("age"))
        .filter(F.col("age") < 14)
        .groupBy("category")
        .agg(
            F.avg(F.when(F.col("age") < 7, F.col("avg_price"))).alias("recent"),
            F.avg(F.when(F.col("age") >= 7, F.col("avg_price"))).alias("prior"),
        )
        .filter(F.col("prior").isNotNull())
    )
    recent, prior = F.col("recent"), F.col("prior")
    base = F.nullif(prior, F.lit(0.0))
    return (
        pair.select(
            "category",
            F.round(F.lit(100.0) * (recent - prior) / base, 1).alias("pct_change_7d"),
            F.when(recent > prior, "up").otherwise("down").alias("direction"),
            (F.abs(recent - prior) / base).alias("_size"),
        )
        .orderBy(F.desc_nulls_last("_size"), "category")
        .drop("_size")
    )


def headlines(found: DataFrame) -> DataFrame:
    """Insights with their sentence; those without a percentage are left out."""
    verb = F.when(F.col("direction") == "up", "rose").otherwise("fell")
    return found.filter(F.col("pct_change_7d").isNotNull()).select(
        "*",
        F.format_string("%s prices %s %.1f%% over the last 7 days",
                        F.col("category"), verb, F.abs("pct_change_7d")).alias("headline"))


def latest_quality(reports: DataFrame) -> DataFrame:
    return reports.orderBy(F.desc("computed_at")).limit(1)
