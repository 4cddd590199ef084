import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import checks, quality
from pricelake.operators.contracts import PRICE_FACTS, PRODUCTS, REASON
from pricelake.schemas import schema

SUNDAY = dt.date(2025, 6, 1)
SOUND = dict(fact_id=501, product_id=33, time_id=20250601, price=7.25, original_price=7.25,
             discount_percentage=0.0, availability="Low Stock", stock_level=40, rating=None, review_count=0,
             sales_velocity=2.5, is_trending=False)


def lines(spark, *faults):
    """Sound fact rows, numbered from 501, each with its own faults."""
    declared = schema("price_facts")
    rows = [{**SOUND, "fact_id": 501 + i, **own} for i, own in enumerate(faults)]
    return spark.createDataFrame([tuple(row[name] for name in declared.names) for row in rows], declared)


def reasons(frame):
    return [row[REASON] for row in PRICE_FACTS.annotate(frame).orderBy("fact_id").collect()]


@pytest.mark.parametrize("fault, reason", [
    ({}, None), ({"price": 0.0}, "gt_0:price"), ({"availability": "Backorder"}, "isin:availability"),
    ({"discount_percentage": 95.5}, "between_0_95:discount_percentage"), ({"rating": 5.5}, "between_0_5:rating"),
    ({"is_trending": None}, "not_null:is_trending"), ({"time_id": -3}, "gt_0:time_id"),
    ({"price": None, "review_count": -1}, "not_null:price"),
])
def test_a_row_is_rejected_for_its_first_fault(spark, fault, reason):
    assert reasons(lines(spark, fault)) == [reason]


def test_split_loses_no_row(spark):
    faults = [{}, {"stock_level": -2}, {}, {"sales_velocity": None}, {}]
    valid, rejected = PRICE_FACTS.split(lines(spark, *faults))
    assert sorted(r["fact_id"] for r in valid.collect()) == [501, 503, 505]
    assert sorted(r["fact_id"] for r in rejected.collect()) == [502, 504]
    assert REASON not in valid.columns


def test_all_rows_of_a_repeated_key_go(spark):
    assert reasons(lines(spark, {"fact_id": 9}, {"fact_id": 10}, {"fact_id": 9}, {"fact_id": 9})) == [
        *["unique:fact_id"] * 3, None]


def test_text_is_coerced_and_unknown_columns_stay_with_rejects(spark, sample_products):
    text = sample_products.select(*[F.col(c).cast("string") for c in sample_products.columns], F.lit("?").alias("note"))
    broken = text.withColumn("base_rating", F.when(F.col("product_id") == "12", "good").otherwise(F.col("base_rating")))
    valid, rejected = PRODUCTS.split(broken)
    assert valid.columns == PRODUCTS.columns
    assert {f.name: f.dataType.simpleString() for f in valid.schema}["base_rating"] == "double"
    assert [(r["product_id"], r["note"], r[REASON]) for r in rejected.collect()] == [("12", "?", "coerce:base_rating")]


@pytest.mark.parametrize("column", ["category", "product_id"])
def test_batches_without_a_column_are_rejected_whole(spark, sample_products, column):
    valid, rejected = PRODUCTS.split(sample_products.drop(column))
    assert (valid.count(), rejected.filter(F.col(REASON) == f"missing_column:{column}").count()) == (0, 3)


def observed(spark, days_ago=0, **columns):
    """Four observations of two products on two days."""
    rows = [(p, SUNDAY - dt.timedelta(days=days_ago + d), 3.0 * p, 4.0 * p, 25.0, 2.0 + p) for p in (1, 2) for d in (0, 1)]
    frame = spark.createDataFrame(rows, "product_id bigint, observed_date date, price double, "
                                        "original_price double, discount_percentage double, rating double")
    return frame.withColumns({name: F.expr(text) for name, text in columns.items()})


def report(frame, rejected=0):
    return quality.quality_report(frame, SUNDAY, rejected).first()


@pytest.mark.parametrize("columns, dimension, value", [
    ({}, "composite_score", 1.0), ({"price": "if(product_id = 1, null, price)"}, "completeness", 0.8333),
    ({"product_id": "1"}, "uniqueness", 0.5), ({"product_id": "cast(null as bigint)"}, "uniqueness", 0.5),
    ({"discount_percentage": "if(product_id = 1, 140.0, 10.0)"}, "validity", 0.5),
    ({"original_price": "price / 2"}, "consistency", 0.0),
])
def test_each_dimension(spark, columns, dimension, value):
    assert report(observed(spark, **columns))[dimension] == pytest.approx(value, abs=1e-4)


def test_age_counts_for_freshness_alone(spark):
    by_age = {days: report(observed(spark, days)) for days in (-5, 0, 7, 300)}
    assert by_age[-5]["freshness"] == by_age[0]["freshness"] == 1.0
    assert 0 < by_age[7]["freshness"] < 1 and by_age[300]["freshness"] == 0.0
    assert {r["completeness"] for r in by_age.values()} == {1.0}


def test_report_of_nothing_scores_nothing(spark):
    empty = report(observed(spark).limit(0), rejected=11)
    assert [empty[c] for c in ("completeness", "composite_score", "rows_evaluated", "rejected_rows")] == [0.0, 0.0, 0, 11]


def test_gates(spark):
    young, old = (quality.quality_report(observed(spark, days), SUNDAY) for days in (0, 90))
    assert quality.gate(young) == quality.freshness_gate(young) == 1.0
    with pytest.raises(checks.CheckFailed, match="freshness"):
        quality.freshness_gate(old)
    with pytest.raises(checks.CheckFailed, match="composite_score"):
        quality.gate(young, floor=1.2)


def test_checks_return_what_violates_them(spark):
    children = spark.createDataFrame([("a", 1), ("b", 2), ("b", 4), (None, 4)], "name string, parent int")
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    assert checks.not_null(children, "name").count() == 1
    assert {r["name"]: r["n"] for r in checks.unique(children, "name").collect()} == {"b": 2}
    assert {r[0] for r in checks.relationships(children, "parent", parents, "id").collect()} == {4}
    assert checks.unique_grain(children, ["name", "parent"]).isEmpty()
    checks.require_empty({"fine": parents.limit(0)})
    with pytest.raises(checks.CheckFailed, match="name is unique"):
        checks.require_empty({"fine": parents.limit(0), "name is unique": checks.unique(children, "name")})
