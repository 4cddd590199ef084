"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated) another choice of
queries. The stored layers that later queries read are built first and timed as layer_<name>, so no query
hides their cost and none pays it twice. Every query runs to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pricelake.registered import ENTRIES, all_queries
from pricelake.session import build_session
from pricelake.sources.trade_feed import feed_of

LAYERS = ["time", "products", "observations", "features", "dim_product", "dim_date", "facts", "performance",
          "deals", "rollup"]
HEADLINE = [
    "bronze_dedup_keep_last", "contract_facts_reasons", "contract_unique", "silver_observations",
    "silver_products", "product_daily_features", "gold_category_daily", "product_profile",
    "quality_report", "check_relationships", "scd2_snapshot", "dim_product", "dim_date",
    "fact_price_observation", "fact_incremental_window", "latest_per_product", "mart_trending_deals",
    "mart_product_performance", "agg_category_daily", "srv_list_products", "srv_price_history",
    "srv_kpis", "srv_insights", "catalog_onboard", "backtest_cutoff", "anomaly_robust_z",
    "anomaly_zscore_flags", "anomaly_iforest", "recommend_topk", "product_segments", "forecast_price",
    "stream_incremental_landing", "stream_late_window",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(f"local[{cpus}]", "pricelake-bench", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pricelake-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before timing
    feed = feed_of(spark, folder)
    seconds = {f"layer_{layer}": timed(lambda layer=layer: getattr(feed, layer)) for layer in LAYERS}
    queries = all_queries()
    for name in names:
        if name not in ENTRIES:
            raise SystemExit(f"unknown query {name}")
        seconds[name] = timed(
            lambda name=name: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
