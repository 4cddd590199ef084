"""Price anomalies: a robust z-score under an alert budget, joined with an isolation forest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.ml import iforest
from pricelake.operators import ranks
from pricelake.session import cut, spread

KEY = ["product_id", "observed_date"]


def robust_z(features: DataFrame) -> DataFrame:
    """Scored rows: 0.6745 * (change - median) / (MAD + epsilon) per product.

    Both medians run over one product's days, in the partitioning the first window made.
    """
    one_product = Window.partitionBy("product_id")
    rows = features.dropna(subset=["price_pct_change", "price_std_7"])
    centred = rows.withColumn(
        "_centred", F.col("price_pct_change") - F.median("price_pct_change").over(one_product))
    mad = F.median(F.abs("_centred")).over(one_product)
    return centred.withColumn(
        "robust_z", fixed.Z_SCALE * F.col("_centred") / (mad + fixed.Z_EPSILON)).drop("_centred")


def zscore_flags(scored: DataFrame, budget_share: float = fixed.ALERT_BUDGET) -> DataFrame:
    """Adds zscore_candidate and zscore_flag; `scored` should be a stored table, it is read repeatedly.

    A candidate is both unusual and material. Flags go to candidates whose average severity rank over all
    scored rows fits the budget; a tie group passes or fails as one.
    """
    severity = F.abs(F.col("robust_z"))
    _, threshold, inclusive = ranks.top_share(
        scored.withColumn("_severity", severity), "_severity", budget_share)
    candidate = (severity > fixed.Z_THRESHOLD) & (
        F.abs("price_pct_change") >= fixed.MATERIALITY_PCT)
    if threshold is None:
        in_budget = F.lit(False)
    else:
        in_budget = severity >= threshold if inclusive else severity > threshold
    return scored.withColumns({"zscore_candidate": candidate, "zscore_flag": candidate & in_budget})


def forest_flags(scored: DataFrame, contamination: float = fixed.FOREST_CONTAMINATION,
                 trees: int = fixed.FOREST_TREES, seed: int = fixed.SEED) -> DataFrame:
    """Adds iforest_score (four places) and iforest_flag, set above the exact score quantile; `scored` is a
    stored table."""
    n = scored.count()
    forest = iforest.fit(scored, KEY, fixed.FOREST_COLUMNS, n, trees, seed=seed)
    rated = cut(spread(scored).withColumn(
        "_score", iforest.score(scored, fixed.FOREST_COLUMNS, forest)), "forest_scores")
    limit = ranks.quantile(rated, "_score", 1 - contamination, n)
    return rated.withColumns({
        "iforest_score": F.round("_score", 4),
        "iforest_flag": F.col("_score") > limit,
    }).drop("_score")


def ensemble(flagged: DataFrame) -> DataFrame:
    """Rows that either detector flags, with the kind of anomaly."""
    z, forest = F.col("zscore_flag"), F.col("iforest_flag")
    kind = (
        F.when(z & forest, "price_shock_multivariate")
        .when(z, "price_shock")
        .when(forest, "contextual")
        .otherwise("normal")
    )
    return flagged.filter(z | forest).select(
        "product_id", "observed_date", "price", "price_pct_change",
        F.round("robust_z", 3).alias("robust_z"), "iforest_score", kind.alias("anomaly_type"))


def detect(features: DataFrame, contamination: float = fixed.FOREST_CONTAMINATION,
           lake=None, trees: int = fixed.FOREST_TREES, seed: int = fixed.SEED) -> DataFrame:
    """The anomalies of a feature table, journalled where a lake is given."""
    scored = cut(robust_z(features), "robust_z")
    rows = scored.count()
    if rows == 0:
        raise ValueError("no rows with a price change and a full volatility window")
    found = cut(ensemble(forest_flags(zscore_flags(scored), contamination, trees, seed)), "anomalies")
    run_id = "unlogged"
    if lake is not None:
        count = found.count()
        run_id = lake.log_run(
            "anomaly_detection",
            {"contamination": contamination, "z_threshold": fixed.Z_THRESHOLD,
             "alert_budget": fixed.ALERT_BUDGET, "materiality_pct": fixed.MATERIALITY_PCT,
             "detectors": "robust_z+isolation_forest"},
            {"rows_scored": rows, "anomalies_found": count,
             "anomaly_rate_pct": round(100 * count / rows, 3)})
    return found.withColumn("model_run_id", F.lit(run_id))
