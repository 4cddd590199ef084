"""The daily run: raw files to published marts, one function per stage.

Stages meet in the lake. Each reads what the stage before it stored and writes its own tables, so a failed
stage is run again by itself and an unchanged rerun of a day changes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from pricelake import fixed_values as fixed
from pricelake.ml import anomaly, forecast, neighbours, segments
from pricelake.operators import checks, features, quality
from pricelake.operators.conform import conform_products
from pricelake.operators.contracts import PRICE_FACTS, PRODUCTS
from pricelake.operators.dedup import keep_last
from pricelake.operators.observations import daily_observations, normalise_time, orphan_facts
from pricelake.operators.scd2 import snapshot
from pricelake.plans import warehouse
from pricelake.session import cut
from pricelake.sources import catalog_files
from pricelake.sources.lake import Lake

SOURCE = catalog_files.SOURCE
ORDINAL = "_ordinal"


@dataclass(frozen=True)
class Settings:
    """What a deployment may change."""

    rules: list | None = None
    lexicon: list | None = None
    horizon: int = fixed.FORECAST_HORIZON_DAYS
    boosting_rounds: int = forecast.ROUNDS
    windows: forecast.Windows = forecast.Windows()
    forest_trees: int = fixed.FOREST_TREES
    quality_floor: float = fixed.QUALITY_SLO
    late_days: int = fixed.LATE_ARRIVAL_DAYS


def _last(lake: Lake, dataset: str, key: str, load_date: str) -> DataFrame:
    landed = lake.landed(SOURCE, dataset, load_date, with_batch=True)
    return keep_last(landed, [key], ["batch_id", ORDINAL]).drop("batch_id", ORDINAL)


def to_bronze(lake: Lake, load_date: str) -> dict[str, int]:
    """Deduplicate, check contracts, quarantine; returns rows per dataset and rows rejected."""
    counts, rejected = {}, 0
    for dataset, key, contract in (("products", "product_id", PRODUCTS),
                                   ("price_facts", "fact_id", PRICE_FACTS)):
        marked = contract.annotate(_last(lake, dataset, key, load_date), check_unique=False)
        valid, bad = contract.parts(cut(marked, f"{dataset}_checked"))
        rejected += lake.quarantine(bad, SOURCE, dataset, load_date)
        counts[dataset] = lake.write(valid, "bronze", dataset, f"dt={load_date}")
    time = normalise_time(_last(lake, "time", "time_id", load_date))
    counts["time"] = lake.write(time, "bronze", "time", f"dt={load_date}")
    return counts | {"rejected": rejected}


def _bronze(lake: Lake, dataset: str, load_date: str) -> DataFrame:
    return lake.read("bronze", dataset, f"dt={load_date}")


def to_silver(lake: Lake, load_date: str, settings: Settings = Settings()) -> dict[str, int]:
    """Conform products, bring observations to their grain; unknown days go to the quarantine."""
    products = conform_products(_bronze(lake, "products", load_date), settings.rules, settings.lexicon)
    facts, time = _bronze(lake, "price_facts", load_date), _bronze(lake, "time", load_date)
    return {
        "products": lake.write(products, "silver", "products"),
        "price_observations": lake.write_observations(daily_observations(facts, time)),
        "orphans": lake.quarantine(orphan_facts(facts, time), SOURCE, "orphan_facts", load_date),
    }


def observations_of(lake: Lake) -> DataFrame:
    return lake.read("silver", "price_observations").drop("month")


def to_gold(lake: Lake) -> dict[str, int]:
    """Feature table, category aggregate and segments."""
    observed, products = observations_of(lake), lake.read("silver", "products")
    tables = {
        "product_daily_features": features.daily_features(observed),
        "category_daily": features.category_daily(observed, products),
        "product_segments": segments.product_segments(features.product_profile(observed), products),
    }
    return {name: lake.write(table, "gold", name) for name, table in tables.items()}


def check_quality(lake: Lake, as_of: dt.date, rejected: int, floor: float = fixed.QUALITY_SLO,
                  computed_at: dt.datetime | None = None) -> float:
    """Store the report, then stop the run where its score is below the floor."""
    stamp = computed_at or dt.datetime.now(dt.UTC)
    report = cut(quality.quality_report(observations_of(lake), as_of, rejected, stamp), "report")
    lake.write_report(report)
    return quality.gate(report, floor=floor)


def score_models(lake: Lake, settings: Settings = Settings()) -> dict[str, int]:
    """Forecasts, anomalies and recommendations, each run journalled. They do not depend on each other and
    run side by side."""
    def forecasts() -> int:
        made = forecast.train_and_forecast(observations_of(lake), settings.horizon,
                                           settings.boosting_rounds, settings.windows, lake=lake)
        return lake.write(made, "gold", "forecast", partition_by=["target"])

    def anomalies() -> int:
        found = anomaly.detect(lake.read("gold", "product_daily_features"), lake=lake,
                               trees=settings.forest_trees)
        return lake.write(found, "gold", "anomalies")

    def recommendations() -> int:
        return lake.write(neighbours.build(lake.read("gold", "product_segments"), lake=lake),
                          "gold", "recommendations")

    jobs = {"forecast": forecasts, "anomalies": anomalies, "recommendations": recommendations}
    with ThreadPool(len(jobs)) as pool:
        run = inheritable_thread_target(lake.spark)(lambda job: job())
        return dict(zip(jobs, pool.map(run, jobs.values())))


def build_warehouse(lake: Lake, effective: dt.datetime, settings: Settings = Settings()) -> dict[str, int]:
    """Snapshot products, rebuild dimensions and marts, load the young facts, run the data tests."""
    staged = warehouse.stage_products(lake.read("silver", "products"))
    observed = warehouse.stage_observations(observations_of(lake))
    history = snapshot(lake.current("warehouse", "product_history"), staged, "product_id",
                       fixed.SNAPSHOT_CHECK_COLUMNS, effective)
    counts = {"product_history": lake.switch(history, "warehouse", "product_history")}
    counts["dim_product"] = lake.write(
        warehouse.dim_product(lake.current("warehouse", "product_history")), "warehouse", "dim_product")
    counts["dim_date"] = lake.write(warehouse.dim_date(observed), "warehouse", "dim_date")
    dim, calendar = lake.read("warehouse", "dim_product"), lake.read("warehouse", "dim_date")

    facts = warehouse.fact_price_observation(observed, dim)
    if lake.exists("warehouse", "fact_price_observation"):
        newest = lake.newest_facts()    # holds the newest day, without a look at the other months
        young = warehouse.young_months(lake.read("silver", "price_observations"), newest, settings.late_days)
        facts = warehouse.late_window(
            warehouse.fact_price_observation(warehouse.stage_observations(young), dim),
            newest, settings.late_days)
    counts["facts_loaded"] = lake.write_facts(cut(facts, "young_facts"))
    stored = lake.facts()
    marts = {
        "mart_product_performance": warehouse.product_performance(stored, dim),
        "mart_trending_deals": warehouse.trending_deals(stored, dim, calendar),
        "ml_forecast": lake.read("gold", "forecast"),
        "ml_anomaly": lake.read("gold", "anomalies"),
        "ml_recommendation": lake.read("gold", "recommendations"),
        "product_segment": lake.read("gold", "product_segments"),
        "dq_report": lake.read("gold", "quality_report"),
    }
    for name, mart in marts.items():
        shown = warehouse.publish(name, mart) if name in warehouse.PUBLISHED else mart
        counts[name] = lake.write(shown, "warehouse", name)
    counts["agg_category_daily"] = lake.refresh_rollup(
        warehouse.category_daily(stored, dim, calendar))
    checks.require_empty(data_tests(lake))
    return counts


def data_tests(lake: Lake) -> dict[str, DataFrame]:
    """The violations of every data test of the warehouse."""
    def table(name: str) -> DataFrame:
        return lake.read("warehouse", name)

    staged = warehouse.stage_products(lake.read("silver", "products"))
    observed = warehouse.stage_observations(observations_of(lake))
    facts, dim, calendar = lake.facts(), table("dim_product"), table("dim_date")
    performance = table("mart_product_performance")
    return {
        "stg_products.product_id unique": checks.unique(staged, "product_id"),
        "stg_products.product_id not_null": checks.not_null(staged, "product_id"),
        "stg_observations grain": checks.unique_grain(observed, ["product_id", "observed_date"]),
        "stg_observations.product_id not_null": checks.not_null(observed, "product_id"),
        "stg_observations.price not_null": checks.not_null(observed, "price"),
        "dim_product.product_sk unique": checks.unique(dim, "product_sk"),
        "dim_product.product_sk not_null": checks.not_null(dim, "product_sk"),
        "dim_product.product_nk not_null": checks.not_null(dim, "product_nk"),
        "dim_date.date_sk unique": checks.unique(calendar, "date_sk"),
        "dim_date.date_sk not_null": checks.not_null(calendar, "date_sk"),
        "fact.product_sk not_null": checks.not_null(facts, "product_sk"),
        "fact.product_sk in dim_product": checks.relationships(facts, "product_sk", dim, "product_sk"),
        "fact.date_sk not_null": checks.not_null(facts, "date_sk"),
        "fact.date_sk in dim_date": checks.relationships(facts, "date_sk", calendar, "date_sk"),
        "fact.price not_null": checks.not_null(facts, "price"),
        "mart_product_performance.product_id unique": checks.unique(performance, "product_id"),
        "mart_product_performance.product_id not_null": checks.not_null(performance, "product_id"),
        "ml_forecast.yhat not_null": checks.not_null(table("ml_forecast"), "yhat"),
        "ml_recommendation.product_id not_null": checks.not_null(
            table("ml_recommendation"), "product_id"),
    }


def run_all(lake: Lake, folder: str, load_date: str, effective: dt.datetime | None = None,
            rebase_to: dt.date | None = None, settings: Settings = Settings()) -> dict[str, dict]:
    """Every stage in order for one load date; raises where the quality gate or a data test fails."""
    as_of = dt.date.fromisoformat(load_date)
    catalog_files.extract(lake, folder, load_date, rebase_to)
    report = {"bronze": to_bronze(lake, load_date), "silver": to_silver(lake, load_date, settings),
              "gold": to_gold(lake)}
    report["quality"] = {"composite_score": check_quality(
        lake, as_of, report["bronze"]["rejected"], settings.quality_floor)}
    report["models"] = score_models(lake, settings)
    report["warehouse"] = build_warehouse(
        lake, effective or dt.datetime.now(dt.UTC).replace(tzinfo=None), settings)
    return report
