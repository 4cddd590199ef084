import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricelake.operators.checks import CheckFailed
from pricelake.operators.dedup import keep_last
from pricelake.operators.observations import orphan_facts
from pricelake.schemas import OBSERVATION_COLUMNS, schema
from pricelake.sources import catalog_files, open_prices
from pricelake.sources.lake import schema_fingerprint


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a bigint")


def test_unknown_layer_raises(lake):
    with pytest.raises(ValueError, match="platinum"):
        lake.path("platinum", "x")


def test_manifest_has_rows_and_fingerprint(spark, lake):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "a bigint, b string")
    manifest = lake.land(frame, "test", "d", "2026-01-01", {"mode": "batch"}).first()
    assert manifest["rows"] == 2 and len(manifest["schema_hash"]) == 16
    assert manifest["params"] == {"mode": "batch"}
    assert schema_fingerprint(frame) == schema_fingerprint(frame.select("b", "a"))
    assert schema_fingerprint(frame) != schema_fingerprint(frame.select("a"))


def test_landing_again_replaces_its_partition_only(spark, lake):
    lake.land(rows(spark, 1), "test", "d", "2026-01-01")
    lake.land(rows(spark, 7, 8), "test", "d", "2026-01-02")
    lake.land(rows(spark, 1), "test", "d", "2026-01-01")
    assert [r["a"] for r in lake.landed("test", "d", "2026-01-01").collect()] == [1]
    assert lake.landed("test", "d", "2026-01-02").count() == 2
    assert lake.manifests().count() == 2


def test_two_batches_of_a_day_stand_side_by_side(spark, lake):
    lake.land(rows(spark, 1), "test", "d", "2026-01-01", batch_id="a")
    lake.land(rows(spark, 2), "test", "d", "2026-01-01", batch_id="b")
    assert lake.landed("test", "d", "2026-01-01").count() == 2


def test_watermarks_are_isolated(lake):
    assert lake.watermark("src_a") is None
    lake.set_watermark("src_a", "2026-01-01T00:00:00Z")
    lake.set_watermark("src_c", "2025-01-01T00:00:00Z")
    lake.set_watermark("src_a", "2026-02-01T00:00:00Z")
    assert lake.watermark("src_a") == "2026-02-01T00:00:00Z"
    assert lake.watermark("src_c") == "2025-01-01T00:00:00Z"
    assert lake.watermark("src_b") is None


def test_quarantine_only_where_there_are_rows(spark, lake):
    bad = rows(spark, 1).withColumn("_dq_reason", F.lit("gt_0:a"))
    assert lake.quarantine(bad.limit(0), "s", "d", "2026-01-01") == 0
    assert not lake.exists("raw", "_rejected", "s", "d")
    assert lake.quarantine(bad, "s", "d", "2026-01-01") == 1
    kept = lake.read("raw", "_rejected", "s", "d").first()
    assert (kept["_dq_reason"], kept["_load_date"]) == ("gt_0:a", "2026-01-01")


def test_months_are_replaced_whole_and_others_stay(spark, lake):
    def batch(*days):
        return spark.createDataFrame([(i, d) for i, d in enumerate(days)],
                                     "product_id bigint, observed_date date")

    lake.write_observations(batch(dt.date(2026, 1, 5), dt.date(2026, 2, 5), dt.date(2026, 2, 6)))
    lake.write_observations(batch(dt.date(2026, 2, 7)))
    got = sorted(str(r["observed_date"]) for r in lake.read("silver", "price_observations").collect())
    assert got == ["2026-01-05", "2026-02-07"]


def test_month_filter_prunes_partitions(spark, lake):
    days = [dt.date(2026, m, 5) for m in (1, 2, 3)]
    lake.write_observations(spark.createDataFrame([(1, d) for d in days],
                                                  "product_id bigint, observed_date date"))
    read = lake.read("silver", "price_observations").filter("month = '2026-02'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and len(read.inputFiles()) == 3
    assert read.count() == 1


def test_facts_need_positive_prices(spark, lake):
    facts = spark.createDataFrame([("k", 1, 20260105, 1.0), ("k", 1, 20260205, 2.0)],
                                  "product_sk string, product_nk bigint, date_sk int, price double")
    assert lake.write_facts(facts) == 2
    assert lake.write_facts(facts.filter("date_sk = 20260205").withColumn("price", F.lit(3.0))) == 1
    assert sorted((r["date_sk"], r["price"]) for r in lake.facts().collect()) == [
        (20260105, 1.0), (20260205, 3.0)]
    assert dict(lake.facts().dtypes)["date_sk"] == "int"
    with pytest.raises(CheckFailed, match="price"):
        lake.write_facts(facts.withColumn("price", -F.col("price")))


def test_run_journal_appends(lake):
    first = lake.log_run("x", {"k": 4}, {"mae": 1}, {"target": "price"})
    lake.log_run("x", {}, {"mae": 2.5})
    runs = {r["run_id"]: r for r in lake.runs().collect()}
    assert len(runs) == 2 and runs[first]["params"] == {"k": "4"}
    assert runs[first]["metrics"] == {"mae": 1.0} and runs[first]["tags"] == {"target": "price"}


def test_rebase_ends_the_day_before(spark):
    time = spark.createDataFrame([(1, "2024-01-01 18:38:42.334901"), (2, "2024-01-02")],
                                 "time_id bigint, full_date string")
    days = [r["full_date"] for r in catalog_files.rebase_dates(time, dt.date(2026, 3, 1)).orderBy(
        "time_id").collect()]
    assert days == ["2026-02-27", "2026-02-28"]


def test_csv_by_header(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("name,product_id,base_price,surplus\nA,1,2.5,x\nB,2,bad,y\n")
    got = catalog_files.read_csv(spark, str(path), "products").orderBy("product_id").collect()
    assert [(r["product_id"], r["name"], r["base_price"]) for r in got] == [(1, "A", 2.5), (2, "B", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        catalog_files.read_csv(spark, str(tmp_path / "none.csv"), "products")


def pages(folder, *records):
    folder.mkdir(exist_ok=True)
    name = folder / f"page{len(list(folder.iterdir()))}.json"
    name.write_text("\n".join(json.dumps(r) for r in records))


def record(i, created, **more):
    return {"id": i, "product_code": str(i), "category_tag": "en:x", "price": 1.5, "currency": "EUR",
            "date": "2026-01-01", "created": created, "location_osm_display_name": "Here", **more}


def test_incremental_extract(spark, lake, tmp_path):
    inbox = tmp_path / "pages"
    pages(inbox, record(1, "2026-01-01T00:00:00Z", product={"product_name": "Tea"}),
          record(2, "2026-01-02T00:00:00Z", product=None))
    first = open_prices.extract(lake, str(inbox), "2026-01-05").first()
    assert first["rows"] == 2 and lake.watermark("open_prices") == "2026-01-02T00:00:00Z"
    pages(inbox, record(3, "2026-01-03T00:00:00Z"))
    second = open_prices.extract(lake, str(inbox), "2026-01-05").first()
    assert second["rows"] == 2  # the boundary record comes again
    landed = lake.landed("open_prices", "prices", "2026-01-05")
    assert landed.columns == schema("open_prices").fieldNames()
    assert sorted(r["id"] for r in landed.collect()) == [1, 2, 2, 3]
    assert {r["product_name"] for r in landed.filter("id = 1").collect()} == {"Tea"}


def test_no_records_land_nothing(lake, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "empty.json").write_text("")
    assert open_prices.extract(lake, str(tmp_path / "pages"), "2026-01-05") is None
    assert lake.watermark("open_prices") is None


def test_orphans_carry_their_reason(spark):
    facts = spark.createDataFrame([(1, 1), (2, 9)], "fact_id bigint, time_id bigint")
    time = spark.createDataFrame([(1, dt.date(2026, 1, 1))], "time_id bigint, full_date date")
    assert [(r["fact_id"], r["_dq_reason"]) for r in orphan_facts(facts, time).collect()] == [
        (2, "orphan_time_id")]


def test_empty_batch_replaces_a_landed_day(spark, lake):
    lake.land(rows(spark, 1, 2), "test", "d", "2026-01-01")
    lake.land(rows(spark, 1, 2).limit(0), "test", "d", "2026-01-01")
    assert lake.landed("test", "d", "2026-01-01").count() == 0
    assert [r["rows"] for r in lake.manifests().collect()] == [0]


def test_corrected_day_leaves_no_stale_rejects(spark, lake):
    bad = rows(spark, 1, 2).withColumn("_dq_reason", F.lit("gt_0:a"))
    for day in ("2026-01-01", "2026-01-02"):
        lake.quarantine(bad, "s", "d", day)
    lake.quarantine(bad.limit(0), "s", "d", "2026-01-01")
    assert {r["_load_date"] for r in lake.read("raw", "_rejected", "s", "d").collect()} == {"2026-01-02"}


def test_last_row_follows_the_files_order(spark, lake, tmp_path):
    """The second file is the larger one, which Spark reads first."""
    folder = tmp_path / "in" / "products.csv"
    folder.mkdir(parents=True)
    header = "product_id,name,category,subcategory,brand,base_price,base_rating,image_url\n"
    (folder / "part-0.csv").write_text(header + "1,old,c,s,b,1.0,4.0,u\n")
    (folder / "part-1.csv").write_text(header + "".join(f"{i},new{i},c,s,b,1.0,4.0,u\n" for i in range(1, 400)))
    frame = catalog_files.read_csv(spark, str(folder), "products", "_ordinal")
    lake.land(frame, "s", "products", "2026-01-01")
    last = keep_last(lake.landed("s", "products", "2026-01-01", with_batch=True), ["product_id"], ["batch_id", "_ordinal"])
    assert {r["product_id"]: r["name"] for r in last.collect()}[1] == "new1"


# ---- tables in buckets ----
def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_key_reads_one_bucket_in_any_session(spark, lake, request):
    # only a scan that keeps its buckets says how many it reads; others skip the same files
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled"))
    rows = spark.range(4000).selectExpr("id % 100 as product_nk", "cast(id / 100 as int) as date_sk", "id * 1.0 as price")
    facts = lake.write_bucketed(rows, "warehouse", "by_product", "product_nk", 8, ["product_nk", "date_sk"])
    one = facts.filter("product_nk = 7")
    assert "SelectedBucketsCount: 1 out of 8" in _plan(one) and one.count() == 40
    assert len(facts.inputFiles()) == 8
    spark.sql(f"DROP TABLE {lake._bucket_table('warehouse', 'by_product')}")     # as a session that does not know it
    again = lake.bucketed("warehouse", "by_product")
    assert "SelectedBucketsCount: 1 out of 8" in _plan(again.filter("product_nk = 7")) and again.count() == 4000
    lake.write_bucketed(rows.limit(5), "warehouse", "by_product", "product_nk", 8)
    assert lake.bucketed("warehouse", "by_product").count() == 5


def test_like_buckets_join_without_a_shuffle(spark, lake, request):
    from pricelake.operators.scd2 import snapshot
    from pricelake.plans import warehouse

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    products = spark.range(50).selectExpr("id as product_id", "concat('p', id) as product_name", "cast(null as string) as brand")
    changed = products.withColumn("brand", F.when(F.col("product_id") % 5 == 0, F.lit("")))     # null becomes an empty text
    first = snapshot(None, products, "product_id", ["product_name", "brand"], dt.datetime(2025, 1, 1), hashed=True)
    first = lake.write_bucketed(first, "warehouse", "history", "product_id", 4)
    second = lake.write_bucketed(changed, "silver", "delivered", "product_id", 4)
    history = snapshot(first, second, "product_id", ["product_name", "brand"], dt.datetime(2026, 1, 1), hashed=True)
    assert "Exchange" not in _plan(history) and history.count() == 60
    dim = lake.write_bucketed(history.selectExpr(
        "product_id as product_nk", "concat(product_id, valid_from) as product_sk", "valid_from", "coalesce(valid_to, timestamp '9999-01-01') as valid_to"),
        "warehouse", "dim", "product_nk", 4)
    names = [c for c in OBSERVATION_COLUMNS if c not in ("product_id", "observed_date")]
    observed = spark.range(100).selectExpr("id % 50 as product_id", "date '2025-06-01' + cast(id / 50 as int) * 300 as observed_date",
                                           *[f"1 as {c}" for c in names])
    facts = warehouse.fact_price_observation(
        lake.write_bucketed(observed, "silver", "by_product", "product_id", 4, ["product_id", "observed_date"]), dim)
    assert "Exchange" not in _plan(facts) and facts.count() == 100
