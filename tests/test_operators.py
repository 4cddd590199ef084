import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.functions import dates, numbers
from pricelake.operators import features, ranks
from pricelake.operators.dedup import keep_last
from pricelake.operators.observations import daily_observations
from pricelake.operators.scd2 import snapshot
from pricelake.plans import onboarding, warehouse


def test_keep_last_with_a_hot_key(spark):
    rows = [(1 if i % 3 == 0 else i, i, f"v{i}") for i in range(3000)]
    random.Random(3).shuffle(rows)
    expected = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        expected[k] = v
    frame = spark.createDataFrame(rows, "k bigint, o bigint, v string")
    for parts in (1, 8):
        got = {r["k"]: r["v"] for r in keep_last(frame.repartition(parts), ["k"], ["o"]).collect()}
        assert got == expected


def test_keep_last_reduces_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 3 as k", "id as o")
    plan = keep_last(frame, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_max(" in before_exchange and "Window" not in plan


def test_keep_last_with_unordered_columns(spark):
    frame = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k bigint, o bigint, m map<string,int>")
    assert [r["m"] for r in keep_last(frame, ["k"], ["o"]).collect()] == [{"b": 2}]


def test_grain_takes_highest_fact(spark):
    columns = ("fact_id bigint, product_id bigint, time_id bigint, price double, original_price double, "
               "discount_percentage double, availability string, stock_level bigint, rating double, "
               "review_count bigint, sales_velocity double, is_trending boolean")
    rows = [(i, 1, t, float(i), 1.0, 0.0, "In Stock", 1, None, 0, 1.0, True)
            for i, t in ((5, 1), (9, 1), (7, 2), (8, 99))]
    time = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 2))],
                                 "time_id bigint, full_date date")
    got = daily_observations(spark.createDataFrame(rows, columns), time)
    assert sorted((str(r["observed_date"]), r["price"]) for r in got.collect()) == [
        ("2026-01-01", 9.0), ("2026-01-02", 7.0)]


def series(spark, prices, product=1):
    first = dt.date(2026, 1, 1)
    rows = [(product, first + dt.timedelta(days=2 * i), p, float(i)) for i, p in enumerate(prices)]
    return spark.createDataFrame(
        rows, "product_id bigint, observed_date date, price double, sales_velocity double")


def test_features_by_row_offset(spark):
    prices = [float(p) for p in random.Random(5).choices(range(1, 100), k=35)]
    prices[3] = 0.0
    rows = features.daily_features(series(spark, prices)).orderBy("observed_date").collect()
    for i, row in enumerate(rows):
        last = prices[max(0, i - 6):i + 1]
        assert row["price_lag_1"] == (prices[i - 1] if i else None)
        assert row["price_lag_7"] == (prices[i - 7] if i >= 7 else None)
        if i < 6:
            assert row["price_ma_7"] is None and row["price_std_7"] is None
        else:
            assert row["price_ma_7"] == pytest.approx(statistics.fmean(last))
            assert row["price_std_7"] == pytest.approx(statistics.stdev(last))
        assert (row["price_ma_30"] is None) == (i < 29)
        if i and prices[i - 1]:
            assert row["price_pct_change"] == pytest.approx((prices[i] / prices[i - 1] - 1) * 100)
        else:
            assert row["price_pct_change"] is None
        day = row["observed_date"]
        assert (row["day_of_week"], row["is_weekend"], row["month_num"]) == (
            day.isoweekday(), day.isoweekday() >= 6, day.month)


def test_features_take_one_exchange(spark):
    plan = features.daily_features(series(spark, [1.0, 2.0]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "Python" not in text


def test_profile_fills_gaps(spark):
    rows = spark.createDataFrame([(1, 5.0, 1.0, None, 2.0)],
                                 "product_id bigint, price double, discount_percentage double, "
                                 "rating double, sales_velocity double")
    got = features.product_profile(rows).first()
    assert (got["price_volatility"], got["avg_rating"], got["avg_price"]) == (0.0, 0.0, 5.0)


def test_week_and_keys(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    frame = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d", dates.monday_week(F.col("d")).alias("w"), dates.day_key(F.col("d")).alias("k"),
        dates.month_key(dates.day_key(F.col("d"))).alias("m"))
    for row in frame.collect():
        assert row["w"] == int(row["d"].strftime("%W"))
        assert (row["k"], row["m"]) == (int(row["d"].strftime("%Y%m%d")), int(row["d"].strftime("%Y%m")))


@pytest.mark.parametrize("raw, value", [
    (' "1,234.50" ', 1234.5), ("0", None), ("-3", None), ("n/a", None), (None, None), ("12.345", 12.35),
    ('1"2', None),
])
def test_clean_price(spark, raw, value):
    frame = spark.createDataFrame([(raw,)], "x string")
    assert frame.select(numbers.clean_price(F.col("x"))).first()[0] == value


@pytest.mark.parametrize("raw, path", [
    ('["A", "B", "C"]', ("A", "C")), ('["A"]', ("A", "A")), ('["", 1, "A", "  "]', ("A", "A")),
    ("[]", ("General Merchandise", "General")), ("nonsense", ("General Merchandise", "General")),
    ('{"a": 1}', ("General Merchandise", "General")), (None, ("General Merchandise", "General")),
    ("[1, true, null]", ("General Merchandise", "General")),
])
def test_category_path(spark, raw, path):
    frame = spark.createDataFrame([(raw,)], "x string")
    assert tuple(frame.select(*onboarding.category_path(F.col("x"))).first()) == path


def test_dense_ids_follow_the_order(spark):
    keys = random.Random(1).sample(range(10 ** 9), 5000)
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(7)
    got = ranks.dense_ids(frame, "k", "id", bucket_rows=300).collect()
    assert {r["k"]: r["id"] for r in got} == {k: i + 1 for i, k in enumerate(sorted(keys))}
    assert ranks.dense_ids(frame.limit(0), "k", "id").count() == 0


@pytest.mark.parametrize("kind", ["smooth", "hot", "two_hot", "few"])
def test_order_statistics_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(ranks, "LOOK_UP", 100)
    random_ = np.random.default_rng(7)
    n = 6000
    smooth = random_.normal(size=n)
    values = {
        "smooth": smooth,
        "hot": np.where(random_.random(n) < 0.34, 0.5, smooth),
        "two_hot": np.where(random_.random(n) < 0.5, 1.0, np.where(random_.random(n) < 0.9, 2.0,
                                                                     1 + random_.random(n))),
        "few": random_.integers(0, 4, n).astype(float),
    }[kind]
    missing = [(None,), (float("nan"),)] * 50
    frame = spark.createDataFrame([(float(v),) for v in values] + missing, "v double").cache()
    ordered = np.sort(values)
    wanted = [0, n // 3, n // 2, int(n * 0.995), n - 1, n]
    assert ranks.values_at_ranks(frame, "v", wanted) == [
        *[ordered[r] for r in wanted[:-1]], None]
    assert ranks.quantile(frame, "v", 0.95) == pytest.approx(np.quantile(values, 0.95), abs=1e-12)
    frame.unpersist()


@pytest.mark.parametrize("distinct", [10 ** 9, 40, 3])
def test_budget_equals_average_rank(spark, distinct):
    random_ = random.Random(distinct)
    values = [float(random_.randrange(distinct)) for _ in range(1500)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    budget, threshold, inclusive = ranks.top_share(frame, "v", 0.01)
    assert budget == 15
    passed = sum(v > threshold or (inclusive and v == threshold) for v in values)
    expected = 0
    for v in values:
        above, ties = sum(x > v for x in values), values.count(v)
        expected += above + (ties + 1) / 2 <= budget
    assert passed == expected


def test_nearest_quantile(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=d) for d in (0, 0, 1, 5, 5, 5, 9, 11, 30, 31)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    assert ranks.nearest_quantile_by_count(frame, "d", 0.8).first()["cutoff"] == days[7]


# ---- type 2 history ----
COLUMNS = "product_id bigint, name string, price double"
T1, T2, T3 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)


def history(spark, *batches):
    current = None
    for effective, rows in batches:
        current = snapshot(current, spark.createDataFrame(rows, COLUMNS), "product_id", ["name"], effective)
    shown = current.select("*", F.date_format("valid_from", "MM").alias("f"),
                           F.date_format("valid_to", "MM").alias("t"))
    return sorted(((r["product_id"], r["name"], r["price"], r["f"], r["t"]) for r in shown.collect()),
                  key=str)


def test_snapshot_versions_checked_columns_only(spark):
    got = history(spark,
                  (T1, [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)]),
                  (T2, [(1, "A", 1.5), (2, "b", 9.0), (3, None, 3.0), (4, "d", 4.0)]))
    assert got == [(1, "A", 1.5, "02", None), (1, "a", 1.0, "01", "02"), (2, "b", 2.0, "01", None),
                   (3, None, 3.0, "01", None), (4, "d", 4.0, "02", None)]


def test_snapshot_repeated_is_idempotent_and_missing_keys_stay_open(spark):
    first = (T1, [(1, "a", 1.0), (2, "b", 2.0)])
    once = history(spark, first, (T2, [(1, "A", 1.0)]))
    again = history(spark, first, (T2, [(1, "A", 1.0)]), (T3, [(1, "A", 1.0)]))
    assert once == again
    assert (2, "b", 2.0, "01", None) in once


def test_snapshot_sees_null_changes(spark):
    got = history(spark, (T1, [(1, None, 1.0)]), (T2, [(1, "a", 1.0)]), (T3, [(1, None, 1.0)]))
    assert len(got) == 3


def test_late_window_at_a_month_edge(spark):
    facts = spark.createDataFrame([(d,) for d in (20260225, 20260226, 20260227, 20260301)], "date_sk int")
    target = spark.createDataFrame([(20260301,)], "date_sk int")
    got = sorted(r[0] for r in warehouse.late_window(facts, target).collect())
    assert got == [20260227, 20260301]
    compat = sorted(r[0] for r in warehouse.late_window(facts, target, compat=True).collect())
    assert compat == [20260301]
    assert warehouse.late_window(facts, target.limit(0)).count() == 4
