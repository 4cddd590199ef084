import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.plans import serving, warehouse


@pytest.fixture(scope="module")
def performance(spark):
    rows = [(i, f"Product {i}", "Footwear" if i % 2 else "Apparel", "sub", "Teva" if i % 5 == 0 else "Keen",
             "Unisex", "url", 4.0, float(i % 10), 1.0, 9.0, i % 5 + 0.5, i, float(i), 0.1, 7, 1.0)
            for i in range(1, 24)]
    return spark.createDataFrame(rows, (
        "product_id bigint, product_name string, category string, subcategory string, brand string, "
        "audience string, image_url string, base_rating double, avg_price double, min_price double, "
        "max_price double, avg_rating double, total_reviews bigint, avg_discount double, "
        "price_volatility double, data_points bigint, avg_sales_velocity double"))


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame([(i, "Value") for i in range(1, 20)],
                                 "product_id bigint, segment_name string")


def test_page_arithmetic(performance, segments):
    info = serving.page_info(performance, page=1, page_size=7).first()
    assert (info["page_size"], info["total"], info["total_pages"]) == (7, 23, 4)
    pages = [serving.list_products(performance, segments, page=p, page_size=7).collect()
             for p in (1, 2, 3, 4, 5)]
    assert [len(p) for p in pages] == [7, 7, 7, 2, 0]
    seen = [(r["avg_price"], r["product_id"]) for p in pages for r in p]
    assert seen == sorted(seen) and len(set(seen)) == 23


@pytest.mark.parametrize("descending", [False, True])
def test_pages_after_a_cursor_equal_numbered_pages(performance, segments, descending):
    """Also across ties and into the products without a value, which come last."""
    mixed = performance.withColumn("avg_price", F.when(F.col("product_id") % 4 > 0, F.col("avg_price")))
    cursor, seen = None, []
    while rows := serving.list_after(mixed, segments, cursor, 5, "avg_price", descending).collect():
        seen += [r["product_id"] for r in rows]
        cursor = rows[-1]["avg_price"], rows[-1]["product_id"]
    every = serving.list_products(mixed, segments, page=1, page_size=100, sort_by="avg_price", descending=descending).collect()
    assert seen == [r["product_id"] for r in every] and len(seen) == 23


def test_deep_pages_keep_one_page_of_rows(performance, segments):
    plan = serving.list_after(performance, segments, (8.0, 1), 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan or "GlobalLimit 5" in plan


def test_no_match_still_has_one_page(performance):
    info = serving.page_info(performance, category="Nothing").first()
    assert (info["total"], info["total_pages"]) == (0, 1)


def test_filter_is_exhaustive(performance, segments):
    rows = serving.list_products(performance, segments, page_size=200, category="Footwear").collect()
    assert len(rows) == 12 and {r["category"] for r in rows} == {"Footwear"}


def test_range_filters_and_descending(performance, segments):
    rows = serving.list_products(performance, segments, page_size=50, min_price=2.0, max_price=5.0,
                                 min_rating=2.0, sort_by="total_reviews", descending=True).collect()
    assert all(2 <= r["avg_price"] <= 5 and r["avg_rating"] >= 2 for r in rows)
    assert [r["total_reviews"] for r in rows] == sorted((r["total_reviews"] for r in rows), reverse=True)


def test_search_hits_brands_and_is_literal(performance):
    assert serving.page_info(performance, search="teva").first()["total"] == 4
    for hostile in ("'; DROP TABLE dim_product;--", "%", "_"):
        assert serving.page_info(performance, search=hostile).first()["total"] == 0


def test_page_size_is_capped_and_sort_listed(performance, segments):
    assert serving.page_info(performance, page_size=10_000).first()["page_size"] == 200
    rows = serving.list_products(performance, segments, sort_by="image_url; --", page_size=3).collect()
    assert [r["avg_price"] for r in rows] == [0.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        serving.list_products(performance, segments, page=0)


def test_lookup(performance, segments):
    assert serving.product(performance, segments, 999_999).isEmpty()
    assert serving.product(performance, segments, 22).first()["segment_name"] is None


def test_listing_is_a_top_k(performance, segments):
    plan = serving.list_products(performance, segments)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_facets(performance, segments):
    got = [(r["facet"], r["value"]) for r in serving.facets(performance, segments).collect()]
    assert got == [("brands", "Keen"), ("brands", "Teva"), ("categories", "Apparel"),
                   ("categories", "Footwear"), ("segments", "Value")]


def rollup(spark, series):
    last = dt.date(2026, 2, 1)
    rows = [(c, last - dt.timedelta(days=age), price) for c, s in series.items() for age, price in s]
    return spark.createDataFrame(rows, "category string, full_date date, avg_price double")


def test_insights_week_over_week(spark):
    found = serving.headlines(serving.insights(rollup(spark, {
        "Up": [(0, 12.0), (6, 12.0), (7, 10.0), (13, 10.0), (14, 99.0)],
        "Down": [(0, 5.0), (7, 10.0)],
        "Equal": [(0, 5.0), (8, 5.0)],
        "New": [(0, 5.0), (3, 5.0)],
        "Free": [(0, 5.0), (8, 0.0)],
    }))).collect()
    assert [(r["category"], r["pct_change_7d"], r["direction"]) for r in found] == [
        ("Down", -50.0, "down"), ("Up", 20.0, "up"), ("Equal", 0.0, "down")]
    assert found[1]["headline"] == "Up prices rose 20.0% over the last 7 days"


def test_only_current_version_counts(spark):
    dim = spark.createDataFrame(
        [("k1", 1, "old", False), ("k2", 1, "new", True), ("k3", 2, "x", True)],
        "product_sk string, product_nk bigint, product_name string, is_current boolean")
    for column in ("category", "subcategory", "brand", "audience", "image_url"):
        dim = dim.withColumn(column, F.lit("c"))
    dim = dim.withColumn("base_rating", F.lit(4.0))
    facts = spark.createDataFrame(
        [("k1", 1, 10.0), ("k2", 1, 20.0), ("k2", 1, 30.0)],
        "product_sk string, product_nk bigint, price double")
    for column in ("rating", "review_count", "discount_percentage", "sales_velocity"):
        facts = facts.withColumn(column, F.lit(1.0))
    rows = warehouse.product_performance(facts, dim).collect()
    assert [(r["product_id"], r["product_name"], r["avg_price"], r["data_points"]) for r in rows] == [
        (1, "new", 25.0, 2)]
