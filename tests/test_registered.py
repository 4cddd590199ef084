"""Registered queries against their SQL on the smallest tables, and what their plans may not contain."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from given import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
QUERIES, SQL = driver.queries(), driver.oracle_sql()
SLOW = {"recommend_topk", "recommend_metrics", "landing_manifest", "catalog_onboard"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    got = sorted((tuple(str(r[c]) for c in sorted(frame.columns)) for r in frame.collect()))
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    places = [columns.index(c) for c in sorted(frame.columns)]
    assert got == sorted(tuple(str(r[i]) for i in places) for r in cursor.fetchall())


def test_every_query_with_sql_is_registered():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) >= 85


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns[0] == "category" and driver.entry(spark).count() > 0


def test_partition_count_does_not_matter(spark):
    name = "product_daily_features"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for count in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        rows = QUERIES[name](spark, SMALL).collect()
        results.append(sorted(map(str, rows)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
