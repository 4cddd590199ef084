"""The whole run on a small catalog, twice, and the read side on what it stored."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricelake.ml.forecast import Windows
from pricelake.operators.checks import CheckFailed
from pricelake.plans import daily_run
from pricelake.plans.storefront import Storefront
from pricelake.sources.lake import Lake

DAYS, PRODUCTS = 45, 12
LAST = dt.date(2026, 1, 9)
NAMES = ["Womens Teva Sandals", "Buck Folding Knife", "Cordura Pack", "Mens Bogs Boots", "Wool Sweater",
         "Camp Stove"]


def write_csv(path, header, rows):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def delivery(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    rng = random.Random(4)
    write_csv(folder / "products.csv",
              ["product_id", "name", "category", "subcategory", "brand", "base_price", "base_rating",
               "image_url"],
              [[i, NAMES[i % 6], "Fashion", "['Navy']", "Generic", 10 + i, 4.0, "u"]
               for i in range(1, PRODUCTS + 1)] + [[99, "No price", "Fashion", "", "x", -1, 4.0, "u"]])
    days = [LAST - dt.timedelta(days=d) for d in range(DAYS)]
    write_csv(folder / "time.csv",
              ["time_id", "full_date", "day_of_week", "day_of_month", "month", "month_name", "quarter",
               "year", "is_weekend"],
              [[i + 1, f"{d} 18:38:42.334901", d.strftime("%A"), d.day, d.month, d.strftime("%B"),
                (d.month + 2) // 3, d.year, d.weekday() >= 5] for i, d in enumerate(days)])
    facts = []
    for p in range(1, PRODUCTS + 1):
        for t in range(1, DAYS + 1):
            price = round((10 + p) * rng.uniform(0.7, 1.0), 2)
            facts.append([len(facts) + 1, p, t, price, 10 + p, round(rng.uniform(0, 40), 1), "In Stock", 5,
                          4.5, 10, round(rng.uniform(1, 9), 2), "True"])
    facts.append([len(facts) + 1, 1, 1, 5.0, 6, 1.0, "Maybe", 5, 4.5, 10, 1.0, "True"])
    facts.append([len(facts) + 1, 1, 777, 5.0, 6, 1.0, "In Stock", 5, 4.5, 10, 1.0, "True"])
    write_csv(folder / "price_facts.csv",
              ["fact_id", "product_id", "time_id", "price", "original_price", "discount_percentage",
               "availability", "stock_level", "rating", "review_count", "sales_velocity", "is_trending"],
              facts)
    return str(folder)


SETTINGS = daily_run.Settings(boosting_rounds=2, windows=Windows(7, 14), forest_trees=20)


@pytest.fixture(scope="module")
def ran(spark, delivery, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("run") / "lake"))
    first = daily_run.run_all(lake, delivery, "2026-01-10", dt.datetime(2026, 1, 10), settings=SETTINGS)
    again = daily_run.run_all(lake, delivery, "2026-01-10", dt.datetime(2026, 1, 11), settings=SETTINGS)
    return lake, first, again


def test_counts(ran):
    lake, first, again = ran
    assert first["bronze"] == {"products": PRODUCTS, "price_facts": PRODUCTS * DAYS + 1, "time": DAYS,
                               "rejected": 2}
    assert first["silver"] == {"products": PRODUCTS, "price_observations": PRODUCTS * DAYS, "orphans": 1}
    assert first["warehouse"]["facts_loaded"] == PRODUCTS * DAYS
    assert first["quality"]["composite_score"] > 0.9
    assert first["models"]["forecast"] == PRODUCTS * 14 * 2


def test_a_rerun_changes_nothing(ran):
    lake, first, again = ran
    assert again["warehouse"]["facts_loaded"] == PRODUCTS * 3  # the late-arrival window
    assert lake.facts().count() == PRODUCTS * DAYS
    assert again["warehouse"]["product_history"] == PRODUCTS
    assert lake.manifests().count() == 3 and lake.read("gold", "quality_report").count() == 2
    reasons = lake.read("raw", "_rejected", "retail_catalog", "price_facts").collect()
    assert [r["_dq_reason"] for r in reasons] == ["isin:availability"]


def test_data_tests_are_empty(ran):
    tests = daily_run.data_tests(ran[0])
    assert len(tests) == 19 and all(t.isEmpty() for t in tests.values())


def test_storefront(ran):
    shop = Storefront(ran[0])
    assert shop.page_info(page_size=5).first()["total_pages"] == 3
    assert shop.list_products(page_size=5, search="teva").count() == 2
    assert shop.product(1).first()["segment_name"]
    assert shop.price_history(1).count() == DAYS
    points = shop.forecast(1).collect()
    assert len(points) == 14 and all(p["yhat_lower"] <= p["yhat"] <= p["yhat_upper"] for p in points)
    picks = shop.recommendations(1).collect()
    assert [p["rank"] for p in picks] == [1, 2, 3, 4, 5, 6] and all(p["product_id"] != 1 for p in picks)
    kpis = shop.kpis().first()
    assert (kpis["products"], kpis["warehouse_rows"]) == (PRODUCTS, PRODUCTS * DAYS)
    assert kpis["quality"]["composite_score"] > 0.9
    assert shop.quality().first()["composite_score"] > 0.9
    assert shop.anomalies(5).count() <= 5 and shop.top_deals(3).count() == 3
    assert shop.category_daily().count() > 0 and shop.insights().count() > 0
    assert {r["facet"] for r in shop.facets().collect()} == {"brands", "categories", "segments"}


def test_a_changed_name_versions_the_product(ran):
    lake, *_ = ran
    products = lake.read("silver", "products").withColumn(
        "product_name", F.when(F.col("product_id") == 3, "Renamed").otherwise(F.col("product_name")))
    lake.write(daily_run.cut(products), "silver", "products")
    daily_run.build_warehouse(lake, dt.datetime(2026, 1, 12), SETTINGS)
    versions = lake.read("warehouse", "dim_product").filter("product_nk = 3").collect()
    assert sorted((v["product_name"], v["is_current"]) for v in versions) == [
        (NAMES[3], False), ("Renamed", True)]
    # all its facts are older than the change, so the current version has none
    assert lake.read("warehouse", "mart_product_performance").filter("product_id = 3").isEmpty()


def test_the_gate_stops_the_run(ran):
    with pytest.raises(CheckFailed, match="composite_score"):
        daily_run.check_quality(ran[0], dt.date(2026, 6, 1), 0, floor=0.99)
