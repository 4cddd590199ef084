"""Registered queries of the model outputs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.ml import anomaly, boosting, forecast, iforest, neighbours, segments
from pricelake.ml.profile import standardise
from pricelake.operators import features
from pricelake.plans import serving, warehouse
from pricelake.registered.entries import register
from pricelake.session import cut, scratch_path
from pricelake.sources.lake import Lake
from pricelake.sources.trade_feed import TradeFeed

def _once(feed: TradeFeed, name: str, make):
    """Model outputs that several queries read are made once per feed."""
    made = feed.__dict__.setdefault("_made", {})
    if name not in made:
        made[name] = make()
    return made[name]


# ---- profiles, segments, neighbours ----
def profile(feed: TradeFeed) -> DataFrame:
    return features.product_profile(feed.observations)


@register("scaled_profile", "product_id:i avg_price:d price_volatility:d avg_discount:d avg_rating:d "
          "avg_velocity:d", "select product_id, " + ", ".join(
              f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}"
              for c in ("avg_price", "price_volatility", "avg_discount", "avg_rating", "avg_velocity"))
          + " from profile")
def scaled_profile(feed: TradeFeed) -> DataFrame:
    return standardise(profile(feed))


SEGMENT = ("product_id:i avg_price:d price_volatility:d avg_discount:d avg_rating:d avg_velocity:d "
           "segment_id:i segment_name:s product_name:s category:s brand:s")


def segmented(feed: TradeFeed) -> DataFrame:
    return _once(feed, "segments", lambda: cut(
        segments.product_segments(profile(feed), feed.products), "segments"))


@register("product_segments", SEGMENT)
def product_segments(feed: TradeFeed) -> DataFrame:
    return segments.product_segments(profile(feed), feed.products)


AXES = fixed.PROFILE_COLUMNS
STEP_SQL = """
near{n} as (
  select restart, product_id, arg_min(segment, distance) as segment, min(distance) as distance from (
    select c.restart, c.segment, p.product_id, DISTANCE as distance
    from points p, centres{m} c) group by 1, 2),
centres{n} as (
  select restart, segment, MEANS, count(*) as n, sum(distance) as cost
  from near{n} join points using (product_id) group by 1, 2)""".replace(
    "DISTANCE", " + ".join(f"pow(p.{c} - c.{c}, 2)" for c in AXES)).replace(
    "MEANS", ", ".join(f"avg({c}) as {c}" for c in AXES))
LLOYD_SQL = """
with points as materialized (select product_id, SCALED from profile),
centres0 as (
  select place // 4 as restart, place % 4 as segment, COLUMNS_OF from (
    select *, row_number() over (order by product_id) - 1 as place from points) where place < 12),
STEPS
select restart, segment, COLUMNS_OF from centres3""".replace(
    "SCALED", ", ".join(f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as {c}" for c in AXES)).replace(
    "STEPS", ",".join(STEP_SQL.format(n=n, m=n - 1) for n in (1, 2, 3))).replace("COLUMNS_OF", ", ".join(AXES))


@register("segment_lloyd_steps", "restart:i segment:i " + " ".join(f"{c}:d" for c in AXES), LLOYD_SQL)
def segment_lloyd_steps(feed: TradeFeed) -> DataFrame:
    """Three restarts from given centres, the twelve first products, after three steps."""
    points = cut(standardise(profile(feed)).select("product_id", *AXES), "points")
    given = [tuple(r)[1:] for r in points.orderBy("product_id").limit(12).collect()]
    found = segments.lloyd(points, AXES, {r: given[4 * r:4 * r + 4] for r in range(3)}, 3, moved=0.0)
    rows = [(r, i, *centre) for r, own in found.items() for i, centre in enumerate(own)]
    return feed.spark.createDataFrame(rows, "restart int, segment int, " + ", ".join(f"{c} double" for c in AXES))


def banded(feed: TradeFeed) -> DataFrame:
    """Profiles with a price band as segment, so that SQL has the same segments. Both sides have a row for every product,
    whatever their files' sizes say, so neither is broadcast."""
    return profile(feed).join(feed.products.hint("merge"), "product_id").withColumn(
        "segment_name", F.when(F.col("base_price") >= 950, "Premium").otherwise("Value"))


RECOMMEND_SQL = """
select a.product_id, b.product_id as recommended_product_id, b.rank, round(b.similarity, 4) as similarity,
       'Similar ' || b.category || ' profile'
       || case when b.segment_name = a.segment_name then ' in the ' || b.segment_name || ' segment'
               else '' end as reason
from (select * from units) a join (
  select q, product_id, category, segment_name, similarity,
         row_number() over (partition by q order by similarity desc, product_id) as rank
  from (select x.product_id as q, y.product_id, y.category, y.segment_name,
               round((x.a*y.a + x.b*y.b + x.c*y.c + x.d*y.d + x.e*y.e
                      + case when x.category = y.category then 4 else 0 end) / (x.length * y.length), 9)
                 as similarity
        from units x join units y on x.product_id <> y.product_id)) b
  on a.product_id = b.q
where b.rank <= 6"""
UNITS = """
select *, sqrt(a*a + b*b + c*c + d*d + e*e + 4) as length
from (select product_id, category, segment_name,
        round((avg_price - avg(avg_price) over ()) / stddev_pop(avg_price) over (), 12) as a,
        round((price_volatility - avg(price_volatility) over ())
              / stddev_pop(price_volatility) over (), 12) as b,
        round((avg_discount - avg(avg_discount) over ()) / stddev_pop(avg_discount) over (), 12) as c,
        round((avg_rating - avg(avg_rating) over ()) / stddev_pop(avg_rating) over (), 12) as d,
        round((avg_velocity - avg(avg_velocity) over ()) / stddev_pop(avg_velocity) over (), 12) as e
      from profile join products using (product_id) join segments using (product_id))"""


@register("recommend_topk", "product_id:i recommended_product_id:i rank:i similarity:d reason:s",
          f"with units as materialized ({UNITS}) {RECOMMEND_SQL}")
def recommend_topk(feed: TradeFeed) -> DataFrame:
    return neighbours.recommend(banded(feed))


@register("recommend_metrics", "products_covered:i avg_top1_similarity:d", f"""
with units as materialized ({UNITS})
select count(distinct product_id) as products_covered,
       avg(similarity) filter (where rank = 1) as avg_top1_similarity from ({RECOMMEND_SQL})""")
def recommend_metrics(feed: TradeFeed) -> DataFrame:
    return neighbours.metrics(neighbours.recommend(banded(feed)))


# ---- forecasts ----
# A part has few days, a supplier has hundreds: the forecasts are those of the suppliers' daily mean price and
# sold quantity, with the library's windows and rounds.
SERIES_SQL = """
select l_suppkey as product_id, cast(l_shipdate as date) as observed_date, avg(l_extendedprice) as price,
       sum(l_quantity) as sales_velocity, avg(l_discount) * 100 as discount_percentage
from lineitem group by 1, 2"""


def supplier_days(feed: TradeFeed) -> DataFrame:
    return _once(feed, "supplier_days", lambda: cut(
        feed.table("lineitem").groupBy(
            F.col("l_suppkey").alias("product_id"), F.col("l_shipdate").cast("date").alias("observed_date"))
        .agg(F.avg(F.col("l_extendedprice").cast("double")).alias("price"),
             F.sum(F.col("l_quantity").cast("double")).alias("sales_velocity"),
             (F.avg(F.col("l_discount").cast("double")) * 100).alias("discount_percentage")), "supplier_days"))


def training(feed: TradeFeed) -> DataFrame:
    return forecast.training_frame(supplier_days(feed))


TRAINING_SQL = f"""
select *, extract(isodow from observed_date) as day_of_week, month(observed_date) as month_num from (
  select *, lag(price, 1) over w as price_lag_1, lag(price, 7) over w as price_lag_7,
         avg(price) over w7 as price_ma_7, avg(price) over w30 as price_ma_30,
         stddev_samp(price) over w7 as price_std_7, lag(sales_velocity, 1) over w as velocity_lag_1,
         avg(sales_velocity) over w7 as velocity_ma_7, row_number() over w as place
  from ({SERIES_SQL})
  window w as (partition by product_id order by observed_date),
         w7 as (partition by product_id order by observed_date rows between 7 preceding and 1 preceding),
         w30 as (partition by product_id order by observed_date rows between 30 preceding and 1 preceding))
where place > 30"""


@register("forecast_training_frame", "product_id:i observed_date:t price:d sales_velocity:d price_lag_1:d "
          "price_lag_7:d price_ma_7:d price_ma_30:d price_std_7:d velocity_lag_1:d velocity_ma_7:d "
          "discount_percentage:d day_of_week:i month_num:i", TRAINING_SQL)
def forecast_training_frame(feed: TradeFeed) -> DataFrame:
    """What the trainers read: windows end the day before."""
    return training(feed)


@register("backtest_cutoff", "cutoff:t", f"""
select cutoff from (
  select observed_date as cutoff, row_number() over (order by observed_date) - 1 as place,
         round((count(*) over () - 1) * 0.8) as wanted from ({TRAINING_SQL}))
where place = wanted""")
def backtest_cutoff(feed: TradeFeed) -> DataFrame:
    """On the frame that the trainers use."""
    return forecast.backtest_cutoff(training(feed))


@register("forecast_backtest_metrics", "target:s cutoff:t rows_tested:i mae:d mape:d low:d high:d")
def forecast_backtest_metrics(feed: TradeFeed) -> DataFrame:
    table = cut(training(feed), "training")
    _, rows, cutoff = forecast.trained(table)
    order = ["target", "cutoff", "rows_tested", "mae", "mape", "low", "high"]
    return feed.spark.createDataFrame(
        [tuple(r[c] for c in order) for r in forecast.backtests(rows, cutoff).values()],
        "target string, cutoff date, rows_tested bigint, mae double, mape double, low double, "
        "high double")


# Given cuts, so that SQL can bin the features as the trainer does.
GIVEN_CUTS = {
    "price_lag_1": [15000, 25000, 35000, 45000], "price_lag_7": [15000, 25000, 35000, 45000],
    "price_ma_7": [20000, 25000, 30000, 35000], "price_ma_30": [24000, 27000, 30000], "price_std_7": [5000, 10000, 15000],
    "velocity_lag_1": [10, 20, 30, 40], "velocity_ma_7": [15, 20, 25, 30], "discount_percentage": [1.5, 3.5, 5.5, 7.5],
    "day_of_week": [1, 2, 3, 4, 5, 6], "month_num": list(range(1, 12)),
}
FEATURES_SQL = "values " + ", ".join(
    f"({i}, '{name}', {[float(c) for c in GIVEN_CUTS[name]]})" for i, name in enumerate(fixed.FORECAST_FEATURES))
HISTOGRAM_SQL = f"""
training as materialized ({TRAINING_SQL}),
named(place_of, feature, cuts) as ({FEATURES_SQL}),
long as (
  select 'price' as target, weekday, feature, v, price as y
  from (unpivot (select *, day_of_week as weekday, cast(day_of_week as double) as dow from (
    select * replace (cast(day_of_week as double) as day_of_week, cast(month_num as double) as month_num) from training))
    on {", ".join(fixed.FORECAST_FEATURES)} into name feature value v)
  union all
  select 'sales_velocity', weekday, feature, v, sales_velocity
  from (unpivot (select *, day_of_week as weekday from (
    select * replace (cast(day_of_week as double) as day_of_week, cast(month_num as double) as month_num) from training))
    on {", ".join(fixed.FORECAST_FEATURES)} into name feature value v)),
bins as (
  select target, weekday, place_of, feature, len(list_filter(cuts, lambda c: c < v)) as bin, any_value(cuts) as cuts,
         count(*) as n, sum(y) as g
  from long join named using (feature) group by target, weekday, place_of, feature, bin),
sums as (
  select *, sum(n) over upto as nl, sum(g) over upto as gl, sum(n) over whole as nt, sum(g) over whole as gt
  from bins window upto as (partition by target, weekday, feature order by bin), whole as (partition by target, weekday, feature)),
gains as (
  select target || ':' || cast(cast(weekday as int) as varchar) as model, place_of, feature, bin,
         list_extract(cuts, cast(bin as int) + 1) as cut, nt as rows, gl / nl as left_value,
         (gt - gl) / (nt - nl) as right_value, nl * (nt - nl) / nt * pow(gl / nl - (gt - gl) / (nt - nl), 2) as gain
  from sums where nl >= 5 and nt - nl >= 5),
stumps as (
  select * from gains qualify row_number() over (partition by model order by gain desc, place_of, bin) = 1)"""


def stumps(feed: TradeFeed):
    """One tree of one cut for each target and weekday: the first level of the trainer's histograms, all in one job."""
    def make():
        table = cut(training(feed), "training")
        days = range(1, 8)
        table = table.withColumns({f"on_{d}": F.col("day_of_week") == d for d in days})
        models = [boosting.Model(f"{t}:{d}", t, f"on_{d}") for t in forecast.TARGETS for d in days]
        edges = [np.array(GIVEN_CUTS[f], float) for f in fixed.FORECAST_FEATURES]
        forest, _ = boosting.grow(table, fixed.FORECAST_FEATURES, models, rounds=1, step=1.0, depth=1, edges=edges)
        return forest.nodes(feed.spark)
    return _once(feed, "stumps", make)


@register("boosting_first_splits", "model:s feature:s cut:d rows:i spread:d left_value:d right_value:d", f"""
select model, feature, cut, rows, sqrt(gain / rows) as spread, left_value, right_value
from (with {HISTOGRAM_SQL} select * from stumps)""")
def boosting_first_splits(feed: TradeFeed) -> DataFrame:
    nodes = stumps(feed)
    leaves = nodes.filter("node > 1").groupBy("model").pivot("node", [2, 3]).agg(F.first("value"))
    return nodes.filter("node = 1 and feature is not null").join(leaves, "model").select(
        "model", "feature", "cut", "rows", F.sqrt(F.col("gain") / F.col("rows")).alias("spread"),
        F.col("2").alias("left_value"), F.col("3").alias("right_value"))


@register("forecast_importances", "target:s feature:s share:d", f"""
select target, feature, share from (
  select target, feature, share, row_number() over (partition by target order by share desc, feature) as place from (
    select split_part(model, ':', 1) as target, feature, sum(gain) / sum(sum(gain)) over (partition by split_part(model, ':', 1)) as share
    from (with {HISTOGRAM_SQL} select * from stumps) group by 1, 2)) where place <= 5""")
def forecast_importances(feed: TradeFeed) -> DataFrame:
    """The leading features of the weekday trees of each target."""
    by_target = stumps(feed).withColumn("model", F.split_part("model", F.lit(":"), F.lit(1)))
    return boosting.importances(by_target).withColumnRenamed("model", "target")


@register("forecast_band_given", "rows_tested:i mae:d mape:d low:d high:d", f"""
with training as materialized ({TRAINING_SQL}),
days as (select observed_date as day, row_number() over (order by observed_date) - 1 as place,
                round((count(*) over () - 1) * 0.8) as wanted from training)
select count(*) as rows_tested, avg(abs(r)) as mae, avg(abs(r / greatest(price, 1e-6))) * 100 as mape,
       quantile_cont(r, 0.05) as low, quantile_cont(r, 0.95) as high
from (select price, price - price_ma_7 as r from training where observed_date > (select day from days where place = wanted))""")
def forecast_band_given(feed: TradeFeed) -> DataFrame:
    """Errors and residual quantiles of the last fifth of the timeline, with the week's mean as the forecast."""
    table = cut(training(feed), "training")
    cutoff = forecast.backtest_cutoff(table).first()["cutoff"]
    rows = table.select("observed_date", "price", F.create_map(F.lit("price:backtest"), F.col("price_ma_7")).alias("predictions"))
    found = forecast.band(cut(forecast.residuals(rows, "price", cutoff), "given-residuals"))
    return feed.spark.createDataFrame([tuple(found.values())], "rows_tested bigint, mae double, mape double, low double, high double")


FORECAST = ("product_id:i forecast_date:t target:s yhat:d yhat_lower:d yhat_upper:d model_run_id:s")


def forecasts(feed: TradeFeed) -> DataFrame:
    return _once(feed, "forecasts", lambda: cut(forecast.train_and_forecast(supplier_days(feed)), "forecasts"))


@register("forecast_price", FORECAST)
def forecast_price(feed: TradeFeed) -> DataFrame:
    return forecasts(feed).filter(F.col("target") == "price")


@register("forecast_velocity", FORECAST)
def forecast_velocity(feed: TradeFeed) -> DataFrame:
    return forecasts(feed).filter(F.col("target") == "sales_velocity")


@register("forecast_union", FORECAST)
def forecast_union(feed: TradeFeed) -> DataFrame:
    """One dataset per target, read back as one."""
    return _by_target(feed, forecasts(feed))


def _by_target(feed: TradeFeed, made: DataFrame) -> DataFrame:
    lake = Lake(feed.spark, scratch_path(feed.spark, "lake"))
    for target in forecast.TARGETS:
        warehouse.store_forecast(lake, made.filter(F.col("target") == target), target)
    return warehouse.stored_forecasts(lake)


@register("forecast_short_series", "product_id:i rows:i", """
select product_id, count(*) as rows from observations group by 1 having count(*) < 30""")
def forecast_short_series(feed: TradeFeed) -> DataFrame:
    return forecast.short_series(feed.observations)


GIVEN_FORECAST_SQL = f"""
select product_id, observed_date as forecast_date, t.target, price as yhat, price * 0.9 as yhat_lower,
       price * 1.1 as yhat_upper, 'given' as model_run_id
from ({SERIES_SQL}), (values ('price'), ('sales_velocity')) as t(target)"""


def given_forecasts(feed: TradeFeed) -> DataFrame:
    """Forecasts that SQL has too: of each day its own price."""
    price = F.col("price")
    return supplier_days(feed).select(
        "product_id", F.col("observed_date").alias("forecast_date"),
        F.explode(F.array(*map(F.lit, forecast.TARGETS))).alias("target"), price.alias("yhat"),
        (price * 0.9).alias("yhat_lower"), (price * 1.1).alias("yhat_upper"), F.lit("given").alias("model_run_id"),
        F.lit(1).alias("not_shown"))


@register("forecast_union_given", FORECAST, GIVEN_FORECAST_SQL)
def forecast_union_given(feed: TradeFeed) -> DataFrame:
    return _by_target(feed, given_forecasts(feed))


GIVEN_BANDS = {"price": {"low": -120.5, "high": 80.25}, "sales_velocity": {"low": -2.5, "high": 1.5}}
ROLL_SQL = f"""
with recursive series as (
  select product_id, max(observed_date) as last_date, list(price order by observed_date)[-30:] as prices,
         list(sales_velocity order by observed_date)[-30:] as velocities, count(*) as n
  from ({SERIES_SQL}) group by 1 having count(*) >= 30),
rolled as (
  select product_id, last_date, prices, velocities, 0 as step, cast(0 as double) as price, cast(0 as double) as velocity from series
  union all
  select product_id, last_date, list_append(prices[2:30], p), list_append(velocities[2:30], v), step + 1, p, v from (
    select product_id, last_date, prices, velocities, step,
      greatest(0.4 * prices[30] + 0.1 * prices[24] + 0.3 * list_avg(prices[24:30]) + 0.15 * list_avg(prices)
        + 0.05 * list_stddev_samp(prices[24:30]) + 3 * extract(isodow from last_date + cast(step + 1 as int)), 0.01) as p,
      greatest(0.6 * velocities[30] + 0.3 * list_avg(velocities[24:30])
        + 0.2 * extract(month from last_date + cast(step + 1 as int)), 0.01) as v
    from rolled where step < 14))
select product_id, last_date + cast(step as int) as forecast_date, target, round(y, 2) as yhat,
       round(greatest(y + low, 0.01), 2) as yhat_lower, round(y + high, 2) as yhat_upper, 'given' as model_run_id
from (select product_id, last_date, step, 'price' as target, price as y, -120.5 as low, 80.25 as high from rolled
      union all
      select product_id, last_date, step, 'sales_velocity', velocity, -2.5, 1.5 from rolled)
where step > 0"""


def _given_price(columns: list) -> np.ndarray:
    known = dict(zip(fixed.FORECAST_FEATURES, columns, strict=True))
    return (0.4 * known["price_lag_1"] + 0.1 * known["price_lag_7"] + 0.3 * known["price_ma_7"] + 0.15 * known["price_ma_30"]
            + 0.05 * known["price_std_7"] + 3 * known["day_of_week"])


def _given_velocity(columns: list) -> np.ndarray:
    known = dict(zip(fixed.FORECAST_FEATURES, columns, strict=True))
    return 0.6 * known["velocity_lag_1"] + 0.3 * known["velocity_ma_7"] + 0.2 * known["month_num"]


@register("forecast_rolled_given", FORECAST, ROLL_SQL)
def forecast_rolled_given(feed: TradeFeed) -> DataFrame:
    """The fourteen recursive steps with linear rules in place of trained models."""
    return forecast.roll_forward(
        forecast.series_state(supplier_days(feed)), {"price": _given_price, "sales_velocity": _given_velocity}, GIVEN_BANDS,
        run_ids={t: "given" for t in forecast.TARGETS})


@register("srv_forecast_given", "forecast_date:t yhat:d yhat_lower:d yhat_upper:d model_run_id:s", f"""
select * from ({GIVEN_FORECAST_SQL}) where product_id = 3 and target = 'price'""")
def srv_forecast_given(feed: TradeFeed) -> DataFrame:
    return serving.forecast(given_forecasts(feed), 3)


@register("srv_recommendations_given", "product_id:i rank:i similarity:d reason:s product_name:s category:s "
          "brand:s avg_price:d avg_rating:d image_url:s", f"""
with units as materialized ({UNITS})
select r.recommended_product_id as product_id, r.rank, r.similarity, r.reason, p.product_name, p.category,
       p.brand, p.avg_price, p.avg_rating, p.image_url
from ({RECOMMEND_SQL}) r join performance p on p.product_id = r.recommended_product_id
where r.product_id = 11""")
def srv_recommendations_given(feed: TradeFeed) -> DataFrame:
    return serving.recommendations(neighbours.recommend_to(banded(feed), 11), feed.performance, 11)


@register("segment_labels", "product_id:i segment_id:i segment_name:s", """
select product_id, bucket as segment_id,
       list_extract([LABELS], cast(dense_rank() over (order by level, bucket) as int)) as segment_name
from (select product_id, product_id % 4 as bucket from profile) join (
  select product_id % 4 as bucket, avg(avg_price) as level from profile group by 1) using (bucket)""".replace(
    "LABELS", ", ".join(f"'{name}'" for name in fixed.SEGMENT_LABELS)))
def segment_labels(feed: TradeFeed) -> DataFrame:
    """The names of given clusters, by the rank of their mean price."""
    return segments.label_by_price(profile(feed).withColumn("segment_id", F.col("product_id") % 4))


# ---- anomalies ----
KEY = "product_id:i observed_date:t "


@register("anomaly_robust_z", KEY + "price_pct_change:d robust_z:d", """
select * from scored where robust_z is not null""")
def anomaly_robust_z(feed: TradeFeed) -> DataFrame:
    return anomaly.robust_z(detector_features(feed))


def detector_features(feed: TradeFeed) -> DataFrame:
    """The columns that the detectors read, computed in the partitioning in which they are scored."""
    wanted = dict.fromkeys([*anomaly.KEY, "price", "price_pct_change", "price_std_7", *fixed.FOREST_COLUMNS])
    return feed.computed_features().select(*wanted)


def scored(feed: TradeFeed) -> DataFrame:
    return _once(feed, "scored", lambda: cut(anomaly.robust_z(detector_features(feed)), "robust_z"))


def zscore_flags(feed: TradeFeed) -> DataFrame:
    return anomaly.zscore_flags(scored(feed))


@register("anomaly_zscore_flags", KEY + "zscore_flag:b", "select * from flagged")
def anomaly_zscore_flags(feed: TradeFeed) -> DataFrame:
    return zscore_flags(feed)


@register("anomaly_iforest", KEY + "iforest_score:d iforest_flag:b")
def anomaly_iforest(feed: TradeFeed) -> DataFrame:
    return anomaly.forest_flags(scored(feed))


# A given forest of twelve small trees, each from the rows of every twelfth product: the root cuts one feature at its mean,
# the left child the next one.
GIVEN_TREES = 12
GIVEN_NODES_SQL = """
sampled as (select cast(product_id % 12 as int) as tree, FEATURES from scored),
means as (select tree, MEANS from sampled group by tree),
chosen as (
  select tree, list_extract([FEATURE_LIST], tree % 4 + 1) as x, list_extract([MEAN_LIST], tree % 4 + 1) as x_cut,
         list_extract([FEATURE_LIST], (tree + 1) % 4 + 1) as y, list_extract([MEAN_LIST], (tree + 1) % 4 + 1) as y_cut
  from sampled join means using (tree)),
sizes as (
  select tree, any_value(x_cut) as x_cut, any_value(y_cut) as y_cut, count(*) filter (where x > x_cut) as n2,
         count(*) filter (where x <= x_cut and y <= y_cut) as n3, count(*) filter (where x <= x_cut and y > y_cut) as n4
  from chosen group by tree),
given_trees as (
  select tree, x_cut, y_cut, 1 + PATH_n2 as path2, 2 + PATH_n3 as path3, 2 + PATH_n4 as path4 from sizes)"""
for _n in ("n2", "n3", "n4"):
    GIVEN_NODES_SQL = GIVEN_NODES_SQL.replace(
        f"PATH_{_n}", f"(case when {_n} <= 1 then 0.0 when {_n} = 2 then 1.0 else "
                      f"2.0 * (ln({_n} - 1) + 0.5772156649015329) - 2.0 * ({_n} - 1) / {_n} end)")
GIVEN_NODES_SQL = GIVEN_NODES_SQL.replace("FEATURE_LIST", ", ".join(fixed.FOREST_COLUMNS)).replace(
    "MEAN_LIST", ", ".join(f"m_{c}" for c in fixed.FOREST_COLUMNS)).replace(
    "MEANS", ", ".join(f"avg({c}) as m_{c}" for c in fixed.FOREST_COLUMNS)).replace(
    "FEATURES", ", ".join(fixed.FOREST_COLUMNS))


def given_nodes(feed: TradeFeed) -> DataFrame:
    sampled = scored(feed).select(F.pmod("product_id", F.lit(GIVEN_TREES)).cast("int").alias("tree"), *fixed.FOREST_COLUMNS)
    values = F.array(*fixed.FOREST_COLUMNS)
    means = sampled.groupBy("tree").agg(F.array(*[F.avg(c) for c in fixed.FOREST_COLUMNS]).alias("means"))
    one, two = F.col("tree") % 4, (F.col("tree") + 1) % 4
    chosen = sampled.withColumn("v", values).join(means, "tree")
    left, low = F.get("v", one) <= F.get("means", one), F.get("v", two) <= F.get("means", two)
    sizes = {r["tree"]: r for r in chosen.groupBy("tree").agg(
        F.first(F.get("means", one)).alias("x"), F.first(F.get("means", two)).alias("y"), F.count_if(~left).alias("n2"),
        F.count_if(left & low).alias("n3"), F.count_if(left & ~low).alias("n4")).collect()}
    rows = []
    for t, r in sizes.items():
        paths = [1 + iforest.average_path(r["n2"]), 2 + iforest.average_path(r["n3"]), 2 + iforest.average_path(r["n4"])]
        rows += [(t, 0, t % 4, r["x"], 1, 2, 0.0), (t, 1, (t + 1) % 4, r["y"], 3, 4, 0.0)]
        rows += [(t, node, 0, float("inf"), node, node, path) for node, path in zip((2, 3, 4), paths)]
    return feed.spark.createDataFrame(rows, iforest.NODE)


GIVEN_SCORE_SQL = f"""
with {GIVEN_NODES_SQL},
valued as (select product_id, observed_date, [{", ".join(fixed.FOREST_COLUMNS)}] as v from scored)
select product_id, observed_date, pow(2, -avg(
         case when list_extract(v, tree % 4 + 1) > x_cut then path2
              when list_extract(v, (tree + 1) % 4 + 1) <= y_cut then path3 else path4 end)
       / (2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0)) as score
from valued, given_trees group by 1, 2"""


@register("anomaly_forest_given", KEY + "score:d", GIVEN_SCORE_SQL)
def anomaly_forest_given(feed: TradeFeed) -> DataFrame:
    """Scores by a given forest, through the arrays that score the grown one."""
    rows = scored(feed)
    forest = iforest.arrays_of(given_nodes(feed), 256)
    return rows.select("product_id", "observed_date", iforest.score(rows, fixed.FOREST_COLUMNS, forest).alias("score"))


@register("anomaly_forest_boxes", "tree:i low:s high:s path:d", f"""
with {GIVEN_NODES_SQL}
select tree, list_transform(range(4), lambda i: if(leaf = 2 and i = tree % 4, printf('%.3f', x_cut),
           if(leaf = 4 and i = (tree + 1) % 4, printf('%.3f', y_cut), '-')))::varchar as low,
       list_transform(range(4), lambda i: if(leaf <> 2 and i = tree % 4, printf('%.3f', x_cut),
           if(leaf = 3 and i = (tree + 1) % 4, printf('%.3f', y_cut), '-')))::varchar as high,
       case leaf when 2 then path2 when 3 then path3 else path4 end as path
from given_trees, (values (2), (3), (4)) as t(leaf)""")
def anomaly_forest_boxes(feed: TradeFeed) -> DataFrame:
    """The given forest's leaves as boxes; an open side is a dash."""
    def shown(edges: str):
        return F.concat(F.lit("["), F.array_join(F.transform(
            edges, lambda x: F.when(F.abs(x) == float("inf"), "-").otherwise(F.format_string("%.3f", x))), ", "), F.lit("]"))

    return iforest.boxes(given_nodes(feed), 4, 2).select("tree", shown("low").alias("low"), shown("high").alias("high"), "path")


def detected(feed: TradeFeed) -> DataFrame:
    return _once(feed, "detected", lambda: anomaly.detect(detector_features(feed)))


@register("ml_anomaly", KEY + "price:d price_pct_change:d robust_z:d iforest_score:d anomaly_type:s "
          "model_run_id:s")
def ml_anomaly(feed: TradeFeed) -> DataFrame:
    return warehouse.publish("ml_anomaly", detected(feed))


GIVEN_ANOMALY_SQL = """
select product_id, observed_date, price, price_pct_change, round(robust_z, 3) as robust_z,
       round(abs(price_pct_change) / 1000, 4) as iforest_score,
       case when zscore_flag and price_pct_change > 40 then 'price_shock_multivariate'
            when zscore_flag then 'price_shock' else 'contextual' end as anomaly_type, 'given' as model_run_id
from flagged where zscore_flag or price_pct_change > 40"""


def given_anomalies(feed: TradeFeed) -> DataFrame:
    """The ensemble over z flags and flags that SQL has too in place of the forest's."""
    flagged = zscore_flags(feed).withColumns({
        "iforest_flag": F.col("price_pct_change") > 40,
        "iforest_score": F.round(F.abs("price_pct_change") / 1000, 4)})
    return anomaly.ensemble(flagged).withColumn("model_run_id", F.lit("given"))


@register("ml_anomaly_labels", KEY + "price:d price_pct_change:d robust_z:d iforest_score:d anomaly_type:s "
          "model_run_id:s", GIVEN_ANOMALY_SQL)
def ml_anomaly_labels(feed: TradeFeed) -> DataFrame:
    return warehouse.publish("ml_anomaly", given_anomalies(feed))


@register("srv_anomalies_given", "product_id:i product_name:s category:s observed_date:t price:d "
          "price_pct_change:d robust_z:d iforest_score:d anomaly_type:s", f"""
select a.*, p.product_name, p.category from ({GIVEN_ANOMALY_SQL}) a
join performance p using (product_id) order by abs(robust_z) desc, product_id, observed_date limit 50""")
def srv_anomalies_given(feed: TradeFeed) -> DataFrame:
    return serving.anomalies(given_anomalies(feed), feed.performance)


# ---- the read side of model outputs ----
@register("srv_forecast", "forecast_date:t yhat:d yhat_lower:d yhat_upper:d model_run_id:s")
def srv_forecast(feed: TradeFeed) -> DataFrame:
    """Of the first product that has a forecast."""
    made = forecasts(feed)
    first = made.agg(F.min("product_id")).first()[0]
    return serving.forecast(made, first)


@register("srv_recommendations", "product_id:i rank:i similarity:d reason:s product_name:s category:s "
          "brand:s avg_price:d avg_rating:d image_url:s")
def srv_recommendations(feed: TradeFeed) -> DataFrame:
    return serving.recommendations(neighbours.recommend_to(segmented(feed), 11), feed.performance, 11)


@register("srv_anomalies", "product_id:i product_name:s category:s observed_date:t price:d "
          "price_pct_change:d robust_z:d iforest_score:d anomaly_type:s")
def srv_anomalies(feed: TradeFeed) -> DataFrame:
    return serving.anomalies(detected(feed), feed.performance)
