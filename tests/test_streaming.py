import datetime as dt

import pytest

from pricelake.streaming import landing


def deliver(spark, folder, *rows):
    frame = spark.createDataFrame([(i, dt.datetime(*t), v) for i, t, v in rows],
                                  "id bigint, created timestamp, value double")
    frame.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).parquet(folder)


def test_landing_keeps_every_key_once(spark, lake, tmp_path):
    inbox = str(tmp_path / "inbox")
    stream = deliver(spark, inbox, (1, (2026, 1, 1, 8), 1.0), (2, (2026, 1, 2, 8), 2.0),
                     (2, (2026, 1, 2, 8), 2.0))
    landing.land_incrementally(stream, lake, "s", "d")
    stream = deliver(spark, inbox, (2, (2026, 1, 2, 8), 2.0), (3, (2026, 1, 9, 8), 3.0),
                     (4, (2025, 6, 1, 8), 4.0))  # repeated, new, and very late
    landing.land_incrementally(stream, lake, "s", "d")
    landing.land_incrementally(stream, lake, "s", "d")  # nothing new
    assert sorted(r["id"] for r in lake.read("raw", "s", "d").collect()) == [1, 2, 3, 4]


def test_late_records_are_quarantined_and_keys_expire(spark, lake, tmp_path):
    inbox = str(tmp_path / "inbox")
    for rows in (
        [(1, (2026, 1, 1, 8), 1.0), (2, (2026, 1, 30, 8), 2.0), (3, (2026, 1, 31, 8), 3.0)],
        [(1, (2026, 1, 1, 8), 1.0), (2, (2026, 1, 30, 8), 2.0), (4, (2026, 1, 29, 9), 4.0), (5, (2026, 1, 2, 8), 5.0),
         (6, (2026, 2, 20, 8), None)],
        [(4, (2026, 1, 29, 9), 4.0), (6, (2026, 2, 20, 8), None), (7, (2026, 2, 18, 8), 7.0)],
    ):
        stream = deliver(spark, inbox, *rows)
        landing.land_incrementally(stream, lake, "s", "d", late_after="5 days")
    landed = {r["id"]: r["value"] for r in lake.read("raw", "s", "d").collect()}
    assert landed == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 6: None, 7: 7.0}
    late = sorted((r["id"], str(r["created"])) for r in landing.late_records(lake, "s", "d").collect())
    assert late == [(1, "2026-01-01 08:00:00"), (4, "2026-01-29 09:00:00"), (5, "2026-01-02 08:00:00")]


def test_landing_plan_reads_nothing_landed(spark, lake, tmp_path):
    stream = deliver(spark, str(tmp_path / "inbox"), (1, (2026, 1, 1, 8), 1.0))
    landing.land_incrementally(stream, lake, "s", "d")
    plan = landing.split_by_state(stream, "id", "created", "5 days")._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan and lake.root not in plan


def test_late_window_reads_are_plain_scans(spark, lake, tmp_path):
    inbox = str(tmp_path / "inbox")
    for price in (1.0, 2.0, 3.0):
        frame = spark.createDataFrame([(p, 20260301 + d, price) for p in range(40) for d in range(3)],
                                      "product_nk bigint, date_sk int, price double")
        frame.coalesce(1).write.mode("append").parquet(inbox)
        landing.load_late_window(spark.readStream.schema(frame.schema).parquet(inbox), lake, "f")
    facts = landing.current_facts(lake, "f")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert facts.count() == 120 and {r["price"] for r in facts.select("price").distinct().collect()} == {3.0}
    assert len(facts.inputFiles()) <= 12                        # days are rewritten whole, not added to
    assert lake.read("state", "newest_day", "f").count() <= 2   # and the newest day is a row, not a scan


@pytest.mark.parametrize("by_day", [True, False])
@pytest.mark.parametrize("compat, expected", [
    (False, {(1, 20260225): 1.0, (1, 20260227): 9.0, (1, 20260301): 9.0, (2, 20260227): 9.0,
             (2, 20260228): 2.0}),
    (True, {(1, 20260225): 1.0, (1, 20260227): 1.0, (1, 20260301): 9.0, (2, 20260228): 2.0}),
])
def test_late_window(spark, lake, tmp_path, compat, expected, by_day):
    inbox = str(tmp_path / "inbox")

    def push(*rows):
        frame = spark.createDataFrame(rows, "product_nk bigint, date_sk int, price double")
        frame.coalesce(1).write.mode("append").parquet(inbox)
        landing.load_late_window(spark.readStream.schema(frame.schema).parquet(inbox), lake, "f",
                                 compat=compat, by_day=by_day)

    push((1, 20260225, 1.0), (1, 20260227, 1.0), (1, 20260301, 1.0), (2, 20260228, 2.0))
    push((1, 20260225, 9.0), (1, 20260227, 9.0), (2, 20260227, 9.0), (1, 20260301, 9.0))
    got = {(r["product_nk"], r["date_sk"]): r["price"] for r in landing.current_facts(lake, "f").collect()}
    assert got == expected
