"""Price and demand forecasts: gradient-boosted trees on lag features, rolled forward day by day."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.ml import boosting
from pricelake.ml.boosting import Forest, Model
from pricelake.operators import features, ranks
from pricelake.session import cut

TARGETS = ("price", "sales_velocity")
ROUNDS = 300
STEP = 0.05
DEPTH = 5
HELD_OUT = 0.1      # share of a training table's days that decide when boosting ends
TOLERANCE = 0.001


@dataclass(frozen=True)
class Windows:
    """Row counts of the short and the long rolling windows; the feature names keep 7 and 30."""

    short: int = 7
    long: int = 30


def training_frame(observations: DataFrame, windows: Windows = Windows(),
                   leaky: bool = False) -> DataFrame:
    """Complete feature rows with both targets.

    Rolling windows end at the row before, as they do when a forecast is made. `leaky=True` lets them
    include the target's own row, like the feature table does.
    """
    before = 0 if leaky else 1
    short, long = windows.short, windows.long
    calendar = features.calendar()
    frame = observations.select(
        "product_id", "observed_date", *TARGETS,
        features.lagged("price", 1).alias("price_lag_1"),
        features.lagged("price", short).alias("price_lag_7"),
        features.rolling_mean("price", short, before).alias("price_ma_7"),
        features.rolling_mean("price", long, before).alias("price_ma_30"),
        features.rolling_std("price", short, before).alias("price_std_7"),
        features.lagged("sales_velocity", 1).alias("velocity_lag_1"),
        features.rolling_mean("sales_velocity", short, before).alias("velocity_ma_7"),
        "discount_percentage",
        calendar["day_of_week"].alias("day_of_week"),
        calendar["month_num"].alias("month_num"),
    )
    return frame.dropna(subset=[*fixed.FORECAST_FEATURES, *TARGETS])


@dataclass(frozen=True)
class Regressor:
    """One model of a forest."""

    forest: Forest
    name: str

    def __len__(self) -> int:
        return len(self.forest.models[self.name])

    def predict(self, columns: list[np.ndarray]) -> np.ndarray:
        """Predictions for the forecast features in their order."""
        return self.forest.predict(self.name, columns)


def _held_back(table: DataFrame, share: float = HELD_OUT):
    """The last day before the newest `share` of the rows."""
    return ranks.nearest_quantile_by_count(table, "observed_date", 1 - share).first()["cutoff"]


def _pair(target: str, kind: str) -> list[Model]:
    """A run that finds the number of trees on the newest days of its rows, and the fit of all its rows that follows it."""
    return [Model(f"{target}:{kind}-length", target, f"{kind}_older", f"{kind}_newer"),
            Model(f"{target}:{kind}", target, f"{kind}_all", follows=f"{target}:{kind}-length")]


def _masked(table: DataFrame, kind: str, upto) -> DataFrame:
    """The masks of `_pair`: rows up to the day `upto` (all of them if it is None), split at the newest tenth of their days."""
    day = F.col("observed_date")
    inside = F.lit(True) if upto is None else day <= F.lit(upto)
    until = F.lit(_held_back(table.filter(inside)))
    return table.withColumns({f"{kind}_all": inside, f"{kind}_older": inside & (day <= until), f"{kind}_newer": inside & (day > until)})


def trained(table: DataFrame, targets: tuple[str, ...] = TARGETS, rounds: int = ROUNDS, step: float = STEP, depth: int = DEPTH,
            tolerance: float = TOLERANCE, with_backtest: bool = True) -> tuple[Forest, DataFrame, object]:
    """All models of a stored training table in lockstep: for each target the model of all rows ("price:full") and, with
    `with_backtest`, that of the days up to the backtest's cutoff ("price:backtest").

    Each has at most `rounds` trees. The newest tenth of its days is held out to find where a further tree improves
    the error by less than `tolerance`; that many trees are fitted to all its rows. A table of a few days, of which
    none can be held out, trains on all rounds. Also gives all rows with their predictions, and the cutoff.
    """
    masked, kinds, cutoff = _masked(table, "full", None), ["full"], None
    if with_backtest:
        cutoff = backtest_cutoff(table).first()["cutoff"]
        masked, kinds = _masked(masked, "backtest", cutoff), [*kinds, "backtest"]
    models = [m for target in targets for kind in kinds for m in _pair(target, kind)]
    forest, rows = boosting.grow(masked, fixed.FORECAST_FEATURES, models, rounds, step, depth, tolerance,
                                 keep=["observed_date", *targets])
    return forest, rows, cutoff


def fit(table: DataFrame, target: str, rounds: int = ROUNDS, step: float = STEP, depth: int = DEPTH,
        tolerance: float = TOLERANCE) -> Regressor:
    """The model of one target on all rows of a stored training table."""
    forest, _, _ = trained(table, (target,), rounds, step, depth, tolerance, with_backtest=False)
    return Regressor(forest, f"{target}:full")


def backtest_cutoff(frame: DataFrame) -> DataFrame:
    """One row: the day up to which rows train, the 0.8 quantile of the row dates."""
    return ranks.nearest_quantile_by_count(frame, "observed_date", 0.8)


def residuals(rows: DataFrame, target: str, cutoff) -> DataFrame:
    """residual and actual of the days after the cutoff, by the model that has not seen them."""
    return rows.filter(F.col("observed_date") > F.lit(cutoff)).select(
        (F.col(target) - F.col("predictions")[f"{target}:backtest"]).alias("residual"), F.col(target).alias("actual"))


def band(judged: DataFrame) -> dict:
    """Errors of a stored table of residuals, and its 5 % and 95 % quantiles."""
    size, mae, mape = judged.agg(
        F.count("*"), F.avg(F.abs("residual")),
        F.avg(F.abs(F.col("residual") / F.greatest("actual", F.lit(1e-6)))) * 100).first()
    low = ranks.quantile(judged, "residual", 0.05, size) if size else 0.0
    high = ranks.quantile(judged, "residual", 0.95, size) if size else 0.0
    return {"rows_tested": size, "mae": mae, "mape": mape, "low": low, "high": high}


def backtests(rows: DataFrame, cutoff, targets: tuple[str, ...] = TARGETS) -> dict[str, dict]:
    """For each target its errors and residual quantiles on the last fifth of the timeline."""
    return {target: {"target": target, "cutoff": cutoff, **band(cut(residuals(rows, target, cutoff), "backtest"))}
            for target in targets}


def top_features(nodes: DataFrame, model: str, count: int = 5) -> list[tuple[str, float]]:
    """The features with the largest share of a model's gains, from its node table."""
    rows = boosting.importances(nodes.filter(F.col("model") == model), count).orderBy(F.desc("share"), "feature").collect()
    return [(r["feature"], round(r["share"], 4)) for r in rows]


def series_state(observations: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Per product the last rows of both series, oldest first; shorter series than the long window are
    left to `short_series`."""
    newest = Window.partitionBy("product_id").orderBy(F.desc("observed_date"))
    tail = observations.select(
        "product_id", "observed_date", *TARGETS, "discount_percentage",
        F.row_number().over(newest).alias("_back")).filter(F.col("_back") <= windows.long)
    packed = tail.groupBy("product_id").agg(F.array_sort(F.collect_list(
        F.struct("observed_date", *TARGETS, "discount_percentage"))).alias("rows"))
    return packed.filter(F.size("rows") >= windows.long).select(
        "product_id",
        F.col("rows.price").alias("prices"),
        F.col("rows.sales_velocity").alias("velocities"),
        F.element_at("rows", -1)["observed_date"].alias("last_date"),
        F.element_at("rows", -1)["discount_percentage"].alias("discount_percentage"),
    )


def short_series(observations: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Products with too few observations to forecast."""
    return observations.groupBy("product_id").agg(F.count("*").alias("rows")).filter(
        F.col("rows") < windows.long)


Predictor = Callable[[list[np.ndarray]], np.ndarray]


def next_features(prices: np.ndarray, velocities: np.ndarray, discount: np.ndarray, day: np.ndarray,
                  windows: Windows) -> list[np.ndarray]:
    """The forecast features of one further day, from the last rows of both series (oldest first) and that day."""
    short, long = windows.short, windows.long
    recent = prices[:, -short:]
    known = {
        "price_lag_1": prices[:, -1],
        "price_lag_7": prices[:, -short],
        "price_ma_7": recent.mean(1),
        "price_ma_30": prices[:, -long:].mean(1),
        "price_std_7": recent.std(1, ddof=1),
        "velocity_lag_1": velocities[:, -1],
        "velocity_ma_7": velocities[:, -short:].mean(1),
        "discount_percentage": discount,
        "day_of_week": (day.astype(np.int64) + 3) % 7 + 1.0,     # day 0 was a Thursday
        "month_num": day.astype("datetime64[M]").astype(np.int64) % 12 + 1.0,
    }
    return [known[name] for name in fixed.FORECAST_FEATURES]


def rolled(state: DataFrame, predictors: dict[str, Predictor], horizon: int, windows: Windows) -> DataFrame:
    """product_id, last_date, step, price and velocity for each step; all steps of a batch of series in one pass, without a
    shuffle. A predictor takes the forecast features in their order."""
    kind = state.schema["product_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            prices, velocities = (batch[name].flatten().to_numpy(zero_copy_only=False).reshape(n, windows.long)
                                  for name in ("prices", "velocities"))
            discount = batch["discount_percentage"].to_numpy(zero_copy_only=False).astype(np.float64)
            last = batch["last_date"].to_numpy(zero_copy_only=False).astype("datetime64[D]")
            made = np.empty((2, n, horizon))
            for step in range(horizon):
                columns = next_features(prices, velocities, discount, last + np.timedelta64(step + 1), windows)
                for i, target in enumerate(TARGETS):
                    made[i, :, step] = np.maximum(predictors[target](columns), fixed.FORECAST_FLOOR)
                prices = np.column_stack([prices[:, 1:], made[0, :, step]])
                velocities = np.column_stack([velocities[:, 1:], made[1, :, step]])
            rows = pa.array(np.repeat(np.arange(n), horizon))
            yield pa.RecordBatch.from_pydict({
                "product_id": batch["product_id"].take(rows), "last_date": batch["last_date"].take(rows),
                "step": pa.array(np.tile(np.arange(1, horizon + 1, dtype=np.int32), n)),
                "price": pa.array(made[0].ravel()), "velocity": pa.array(made[1].ravel())})

    narrow = state.select("product_id", "last_date", "prices", "velocities", "discount_percentage")
    return narrow.mapInArrow(run, f"product_id {kind}, last_date date, step int, price double, velocity double")


def roll_forward(state: DataFrame, predictors: dict[str, Predictor], bands: dict[str, dict],
                 horizon: int = fixed.FORECAST_HORIZON_DAYS, windows: Windows = Windows(),
                 run_ids: dict[str, str] | None = None) -> DataFrame:
    """Forecasts of every product and target for the next `horizon` days, with bands around them."""
    run_ids = run_ids or {}
    points = rolled(state, predictors, horizon, windows)

    def shown(target: str) -> Column:
        yhat = F.col("price" if target == "price" else "velocity")
        low, high = min(bands[target]["low"], 0.0), max(bands[target]["high"], 0.0)
        return F.struct(
            F.lit(target).alias("target"),
            F.round(yhat, 2).alias("yhat"),
            F.round(F.greatest(yhat + low, F.lit(fixed.FORECAST_FLOOR)), 2).alias("yhat_lower"),
            F.round(yhat + high, 2).alias("yhat_upper"),
            F.lit(run_ids.get(target, "unlogged")).alias("model_run_id"))

    return points.select(
        "product_id",
        F.date_add("last_date", F.col("step")).alias("forecast_date"),
        F.explode(F.array(*[shown(t) for t in predictors])).alias("f"),
    ).select("product_id", "forecast_date", "f.*")


def train_and_forecast(observations: DataFrame, horizon: int = fixed.FORECAST_HORIZON_DAYS,
                       rounds: int = ROUNDS, windows: Windows = Windows(), leaky: bool = False,
                       lake=None) -> DataFrame:
    """Backtest, fit to everything, forecast both targets; runs are journalled where a lake is given."""
    frame = cut(training_frame(observations, windows, leaky), "training")
    forest, rows, cutoff = trained(frame, rounds=rounds)
    bands = backtests(rows, cutoff)
    run_ids = {t: uuid.uuid4().hex[:12] for t in TARGETS}
    if lake is not None:
        nodes = forest.nodes(frame.sparkSession)
    for target in TARGETS if lake is not None else ():
        leading = ",".join(f"{f}:{w}" for f, w in top_features(nodes, f"{target}:full"))
        lake.log_run(
            f"{target}_forecasting",
            {"model": "histogram_boosting", "horizon_days": horizon,
             "features": ",".join(fixed.FORECAST_FEATURES), "top_feature_importance": leading},
            {"backtest_mae": bands[target]["mae"], "backtest_mape": bands[target]["mape"],
             "interval_width": bands[target]["high"] - bands[target]["low"],
             "trees": len(forest.models[f"{target}:full"])},
            {"target": target}, run_ids[target])
    predictors = {t: Regressor(forest, f"{t}:full").predict for t in TARGETS}
    return roll_forward(series_state(observations, windows), predictors, bands, horizon, windows, run_ids)
