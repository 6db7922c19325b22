"""Registered queries: models, evaluation, metrics tables and recursive forecasts
(M1-M11, A10-A12, A14, J6, K4, K5, L4, C22).

SQL-checked metrics use predictors SQL can state -- the training mean, the
mean of all twelve lags, the mean of the day and week lags -- over the time
split of the per-user features.  Boosted-tree results get row checks.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import models as MD
from ..operators import prep as PR
from ..operators import recursive as RC
from ..session import materialize, scratch_path
from ..sinks.writers import append_metrics_history, metrics_table, write_metrics, write_table
from . import oracle as O
from .q_core import type_series, user_series
from .q_prep import WINDOWED_CTES, SPLIT_CTE, examples
from .registry import register, round_doubles
from .q_trips import RUN_FEATURES_CTES
from .training import (SET_OF, best_model_name, keyed_predictions, load_model, load_scored, load_sets, preprocess_pair,
                       read_metrics, run_forecast, serving_spec, train_ten_lags, trained)

RUN_TS = "2024-02-01 00:00:00"
LAGS12 = feat.lag_names()
ROLES = {"baseline": None, "full": LAGS12, "reduced": ["rides_lag_24h", "rides_lag_168h"]}


def user_split(spark, sf):
    """The labelled per-user rows that the SQL-expressible predictors need, written once."""
    lab = PR.time_split(feat.lag_features(user_series(spark, sf)))
    return materialize(lab.select("pickup_hour", "start_station_id", "rides", "split", *LAGS12), "split")


def sql_scored(spark, sf):
    """Test rows with one prediction column per predictor."""
    lab = user_split(spark, sf)
    train, out = lab.where("split = 'train'"), lab.where("split = 'test'")
    for role, cols in ROLES.items():
        m = MD.BaselinePredictor(labelCol="rides", predictionCol=role, lagCols=cols or [],
                                 lagPrefix="no lags").fit(train)
        out = m.transform(out)
    return out.select("pickup_hour", "start_station_id", "rides", *ROLES)


def sql_metrics(spark, sf):
    return MD.mae_of_columns(sql_scored(spark, sf), list(ROLES))


_PRED = {"baseline": "(SELECT avg(rides) FROM tr)",
         "full": "(" + " + ".join(LAGS12) + ") / 12.0",
         "reduced": "(rides_lag_24h + rides_lag_168h) / 2.0"}
SPLIT_CTES = f"""WITH {O.series_ctes('user')},
{O.features_cte()},
{SPLIT_CTE.replace('FROM dense', 'FROM features')},
tr AS (SELECT f.* FROM features f, s WHERE pickup_hour < split_hour),
te AS (SELECT f.* FROM features f, s WHERE pickup_hour >= split_hour),
scored AS ({' UNION ALL '.join(f"SELECT pickup_hour, start_station_id, '{k}' AS model_name, CAST(rides AS DOUBLE) AS actual, CAST({v} AS DOUBLE) AS predicted FROM te" for k, v in _PRED.items())}),
metrics AS (SELECT model_name, avg(abs(actual - predicted)) AS mae FROM scored GROUP BY 1)"""


# --- M1 / A14 ------------------------------------------------------------------
_T = [f'"rides_t-{k}"' for k in range(12, 0, -1)]


@register("baseline_predict", f"""WITH {WINDOWED_CTES}
SELECT pickup_hour, start_station_id, target, {O.r6('(' + ' + '.join(_T) + ') / 12.0')} AS prediction FROM ex""")
def q_baseline_predict(spark, sf):
    ex = examples(spark, sf)
    m = MD.BaselinePredictor(labelCol="target").fit(ex)
    return round_doubles(m.transform(ex).select("pickup_hour", "start_station_id", "target", "prediction"))


@register("train_mean", SPLIT_CTES + f"\nSELECT {O.r6('avg(rides)')} AS train_mean FROM tr")
def q_train_mean(spark, sf):
    train = user_split(spark, sf).where("split = 'train'")
    m = MD.BaselinePredictor(labelCol="rides", lagPrefix="no lags").fit(train)
    return round_doubles(train.sparkSession.createDataFrame(
        [(float(m.getOrDefault(m.trainMean)),)], "train_mean double"))


# --- A10-A12 / J6 ----------------------------------------------------------------
@register("mae", SPLIT_CTES + f"\nSELECT model_name, {O.r6('mae')} AS mae FROM metrics")
def q_mae(spark, sf):
    return round_doubles(sql_metrics(spark, sf))


@register("model_improvement", SPLIT_CTES + """,
p AS (SELECT max(mae) FILTER (WHERE model_name = 'baseline') AS b,
             max(mae) FILTER (WHERE model_name = 'full') AS f,
             max(mae) FILTER (WHERE model_name = 'reduced') AS r FROM metrics)
SELECT """ + O.r6("(b - f) / b * 100") + " AS baseline_improvement, "
         + O.r6("CASE WHEN f > 0 THEN (f - r) / f * 100 ELSE 0.0 END") + " AS full_model_comparison FROM p")
def q_model_improvement(spark, sf):
    return round_doubles(MD.model_improvement(sql_metrics(spark, sf)))


@register("best_model", SPLIT_CTES + f"""
SELECT arg_min(model_name, (mae, model_name)) AS best_model, {O.r6('min(mae)')} AS mae FROM metrics""")
def q_best_model(spark, sf):
    return round_doubles(MD.best_model(sql_metrics(spark, sf)))


@register("compare_models", SPLIT_CTES + f"""
SELECT pickup_hour, start_station_id, CAST(rides AS DOUBLE) AS actual,
  {O.r6(_PRED['baseline'])} AS baseline, {O.r6(_PRED['full'])} AS "full",
  CASE WHEN rides > 0 THEN {O.r6(_PRED['reduced'])} END AS reduced
FROM te""")
def q_compare_models(spark, sf):
    """One frame per model, joined by the operator; the reduced model's frame lacks the hours without rides."""
    scored = materialize(sql_scored(spark, sf), "scored")
    preds = {m: scored.select("pickup_hour", "start_station_id", F.col(m).alias("prediction")) for m in ROLES}
    preds["reduced"] = scored.where("rides > 0").select("pickup_hour", "start_station_id", F.col("reduced").alias("prediction"))
    return round_doubles(MD.compare_models(scored, preds))


# --- K4 / K5 / L4 ----------------------------------------------------------------
METRIC_ROWS_SQL = SPLIT_CTES + f""",
p AS (SELECT max(mae) FILTER (WHERE model_name = 'baseline') AS b,
             max(mae) FILTER (WHERE model_name = 'full') AS f,
             max(mae) FILTER (WHERE model_name = 'reduced') AS r FROM metrics),
mrows AS (SELECT model_name, {O.r6('mae')} AS mae, '{RUN_TS}' AS timestamp,
    CASE model_name WHEN 'baseline' THEN 'baseline' WHEN 'full' THEN 'full_feature' ELSE 'reduced_feature' END
      AS model_type,
    CASE WHEN model_name = 'full' THEN {O.r6('(b - f) / b * 100')} END AS baseline_improvement,
    CASE WHEN model_name = 'reduced' THEN {O.r6('CASE WHEN f > 0 THEN (f - r) / f * 100 ELSE 0.0 END')} END
      AS full_model_comparison
  FROM metrics, p)"""


def _metric_rows(spark, sf):
    m = materialize(sql_metrics(spark, sf), "metrics")
    return round_doubles(MD.metrics_rows(m, RUN_TS, MD.model_improvement(m)))


@register("write_metrics", METRIC_ROWS_SQL + "\nSELECT * FROM mrows")
def q_write_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = materialize(_metric_rows(spark, sf), "metric-rows")
    base = rows.select("model_name", "mae", "timestamp", "model_type")
    extras = rows.where("baseline_improvement IS NOT NULL OR full_model_comparison IS NOT NULL")
    # per-model frames with different columns, unioned with missing -> null
    write_metrics([base.where("model_name = 'baseline'"),
                   extras.where("model_name = 'full'").drop("full_model_comparison"),
                   extras.where("model_name = 'reduced'").drop("baseline_improvement")], path)
    schema = ("model_name STRING, mae DOUBLE, timestamp STRING, model_type STRING, "
              "baseline_improvement DOUBLE, full_model_comparison DOUBLE")
    return spark.read.schema(schema).option("header", True).csv(path)


HISTORY_SQL = SPLIT_CTES + f""",
h AS (SELECT model_name, {O.r6('mae')} AS mae, '2024-02-01 00:00:00' AS run_timestamp, 'run-1' AS run_id FROM metrics
      UNION ALL
      SELECT model_name, {O.r6('mae')}, '2024-02-02 00:00:00', 'run-2' FROM metrics)"""


def _history(spark, sf, m=None):
    path = scratch_path(spark, "metrics-history")
    m = materialize(round_doubles(sql_metrics(spark, sf)), "metrics") if m is None else m
    append_metrics_history(m, path, dt.datetime(2024, 2, 1), "run-1")
    append_metrics_history(m, path, dt.datetime(2024, 2, 2), "run-2")
    return spark.read.schema("model_name STRING, mae DOUBLE, run_timestamp STRING, run_id STRING") \
        .option("header", True).csv(path)


@register("append_metrics_history", HISTORY_SQL + "\nSELECT * FROM h")
def q_append_metrics_history(spark, sf):
    return _history(spark, sf)


@register("union_history", HISTORY_SQL + f""",
m2 AS (SELECT model_name, {O.r6('mae')} AS mae, 'run-3' AS run_id, 'current' AS status FROM metrics)
SELECT model_name, mae, run_timestamp, run_id, NULL::VARCHAR AS status FROM h
UNION ALL SELECT model_name, mae, NULL, run_id, status FROM m2""")
def q_union_history(spark, sf):
    m = materialize(round_doubles(sql_metrics(spark, sf)), "metrics")
    cur = m.select("model_name", "mae", F.lit("run-3").alias("run_id"), F.lit("current").alias("status"))
    return MD.union_history(_history(spark, sf, m), cur)


# --- boosted trees over the feature pipeline's three sets (row checks) ----------------
# The test rows of the feature pipeline, as SQL: the keys and targets that every scored frame must have.
TEST_ROWS_SQL = RUN_FEATURES_CTES + """,
s AS (SELECT pickup_hour AS split_hour FROM (
    SELECT pickup_hour, row_number() OVER (ORDER BY pickup_hour) - 1 AS i, count(*) OVER () AS n
    FROM (SELECT DISTINCT pickup_hour FROM dense)) WHERE i = floor(n * 0.8)),
te AS (SELECT pickup_hour, start_station_id, rides FROM dense, s WHERE pickup_hour >= split_hour)
SELECT pickup_hour, start_station_id, rides, true AS predicted, true AS in_range, true AS beats_constant FROM te"""


def _checked(scored, fitted, lo, hi):
    """Scored rows with what SQL can state of a tree model: there is a prediction, it lies in the range that a sum of
    leaf means around the training targets allows, and on ``fitted``, the rows that the model learned from, its error is below
    that of the best constant (the median), so a constant predictor fails.  The given events have no structure that held-out rows
    could share, so nothing is asked of the error there.  The values are in the ``..._predictions`` queries."""
    median = fitted.agg(F.percentile("rides", F.lit(0.5)).alias("_m"))
    error = fitted.crossJoin(F.broadcast(median)).agg(
        (F.avg(F.abs(F.col("rides") - F.col("prediction"))) < F.avg(F.abs(F.col("rides") - F.col("_m")))).alias("beats_constant"))
    return scored.crossJoin(F.broadcast(error)).select(
        "pickup_hour", "start_station_id", "rides", F.col("prediction").isNotNull().alias("predicted"),
        F.col("prediction").between(lo, hi).alias("in_range"), "beats_constant")


def _checked_model(spark, sf, name):
    root = trained(spark, sf)
    fitted = load_model(root, name).transform(spark.read.parquet(f"{root}/prepared/{name}"))
    return _checked(load_scored(spark, root, name), fitted.select("rides", "prediction"), *_target_range(spark, sf))


def _target_range(spark, sf):
    r = load_sets(spark, trained(spark, sf))["full_features"].agg(F.min("rides"), F.max("rides")).first()
    span = r[1] - r[0]
    return r[0] - span, r[1] + span


def _all_rows_scored(spark, sf):
    """Every row of the full set by the stored full model."""
    root = trained(spark, sf)
    full = load_sets(spark, root)["full_features"]
    _, everything = preprocess_pair(PR.train_test(full)[0], full)
    return keyed_predictions(MD.score_batch(load_model(root, "full"), everything))


@register("train_full", TEST_ROWS_SQL)
def q_train_full(spark, sf):
    return _checked_model(spark, sf, "full")


@register("train_reduced", TEST_ROWS_SQL)
def q_train_reduced(spark, sf):
    return _checked_model(spark, sf, "reduced")


@register("train_full_predictions")
def q_train_full_predictions(spark, sf):
    return load_scored(spark, trained(spark, sf), "full")


@register("train_reduced_predictions")
def q_train_reduced_predictions(spark, sf):
    return load_scored(spark, trained(spark, sf), "reduced")


@register("evaluate_models")
def q_evaluate_models(spark, sf):
    return round_doubles(MD.rank_models(read_metrics(spark, trained(spark, sf))))


@register("evaluate_models_checked", TEST_ROWS_SQL.rsplit("SELECT", 1)[0] + """
SELECT model_name, n, true AS mae_of_scored_rows FROM (SELECT count(*) AS n FROM te),
  (SELECT unnest(['baseline', 'full', 'reduced']) AS model_name)""")
def q_evaluate_models_checked(spark, sf):
    """M4: each stored metric is the mean absolute error of the model's stored test rows."""
    root = trained(spark, sf)
    rows = MD.predictions_long({m: load_scored(spark, root, m) for m in SET_OF})
    again = rows.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("again"))
    return again.join(read_metrics(spark, root), "model_name").select(
        "model_name", "n", (F.abs(F.col("mae") - F.col("again")) < 1e-9).alias("mae_of_scored_rows"))


@register("score_batch", RUN_FEATURES_CTES + """
SELECT pickup_hour, start_station_id, rides, true AS predicted, true AS in_range, true AS beats_constant FROM dense""")
def q_score_batch(spark, sf):
    scored = _all_rows_scored(spark, sf)
    return _checked(scored, scored, *_target_range(spark, sf))


@register("score_batch_predictions")
def q_score_batch_predictions(spark, sf):
    return _all_rows_scored(spark, sf)


@register("save_load_model", TEST_ROWS_SQL.replace("true AS predicted, true AS in_range, true AS beats_constant", "true AS same_as_before_saving"))
def q_save_load_model(spark, sf):
    """The loaded model predicts the test rows as the fitted one did before it was saved."""
    root = trained(spark, sf)
    best = best_model_name(spark, root)
    _, test = preprocess_pair(*PR.train_test(load_sets(spark, root)[SET_OF[best]]))
    again = keyed_predictions(load_model(root, best).transform(test)).withColumnRenamed("prediction", "again")
    return (load_scored(spark, root, best).join(again.drop("rides"), ["pickup_hour", "start_station_id"])
            .select("pickup_hour", "start_station_id", "rides",
                    (F.abs(F.col("prediction") - F.col("again")) < 1e-9).alias("same_as_before_saving")))


# --- recursive forecasts ----------------------------------------------------------------
def _horizon(start=dt.datetime(2024, 1, 31, 0, 0), hours=168):
    return RC.hourly_range(start, start + dt.timedelta(hours=hours - 1))


def _grid_sql(hours, stations="dense"):
    """Every hour of the horizon for every station with enough history; the checks hold for all of them."""
    return f""",
st AS (SELECT DISTINCT start_station_id FROM {stations}),
h AS (SELECT unnest(generate_series(TIMESTAMP '{hours[0]}', TIMESTAMP '{hours[-1]}', INTERVAL 1 HOUR)) AS pickup_hour)
SELECT start_station_id, pickup_hour, true AS in_range FROM st, h"""


def _in_range(forecast, hi, column="predicted_rides"):
    return forecast.select("start_station_id", "pickup_hour", F.col(column).between(0.0, hi).alias("in_range"))


M6_HOURS = _horizon(hours=90 * 24)


def _full_forecast(spark, sf):
    root = trained(spark, sf)
    full = load_sets(spark, root)["full_features"]
    return RC.recursive_forecast(spark, full, M6_HOURS, serving_spec(spark, root, "full"), 672, RC.station_codes(full))


@register("recursive_forecast", RUN_FEATURES_CTES + _grid_sql(M6_HOURS))
def q_recursive_forecast(spark, sf):
    """M6: 90 days of the stored full model, fed back hour by hour."""
    return _in_range(_full_forecast(spark, sf), _target_range(spark, sf)[1])


@register("recursive_forecast_values")
def q_recursive_forecast_values(spark, sf):
    """M6's forecasts themselves."""
    return _full_forecast(spark, sf)


M7_BLOCKS, M7_W, M7_LAGS = 4, 24, 10
M7_SQL = f"""WITH RECURSIVE {O.series_ctes('user')},
r AS (SELECT *, row_number() OVER (PARTITION BY start_station_id ORDER BY pickup_hour DESC) AS rn FROM dense),
init AS (SELECT start_station_id, list(CAST(rides AS DOUBLE) ORDER BY pickup_hour DESC) AS hist
         FROM r WHERE rn <= {M7_W} GROUP BY 1 HAVING count(*) = {M7_W}),
blocks(start_station_id, b, hist, pred) AS (
  SELECT start_station_id, 0, hist, NULL::DOUBLE FROM init
  UNION ALL
  SELECT start_station_id, b + 1, list_concat(list_resize([list_avg(hist[1:{M7_LAGS}])], 168, list_avg(hist[1:{M7_LAGS}])), hist)[1:{M7_W}],
         list_avg(hist[1:{M7_LAGS}])
  FROM blocks WHERE b < {M7_BLOCKS}),
h AS (SELECT unnest(generate_series(0, {M7_BLOCKS * 168 - 1})) AS i)
SELECT start_station_id, TIMESTAMP '{_horizon()[0]}' + to_hours(CAST(i AS BIGINT)) AS pickup_hour, {O.r6('pred')} AS predicted_rides
FROM blocks JOIN h ON CAST(floor(i / 168) AS INTEGER) + 1 = b"""


@register("recursive_forecast_batched", M7_SQL)
def q_recursive_forecast_batched(spark, sf):
    """M7: lag-mean model over the last 10 of 24 rows, history refreshed weekly, four blocks."""
    names = [f"rides_t-{k}" for k in range(1, M7_LAGS + 1)]
    spec = RC.serve_spec({"kind": "lag_mean"}, names, refresh_every=168)
    hours = _horizon(hours=M7_BLOCKS * 168)
    return round_doubles(RC.recursive_forecast(spark, user_series(spark, sf), hours, spec, M7_W))


_M8_HOURS = RC.fixed_range_hours(4)


def _fixed_range(spark, sf):
    """(history, forecast) of M8."""
    series_ = type_series(spark, sf)
    trees = RC.export_trees(spark, train_ten_lags(spark, series_).stages[-1], scratch_path(spark, "gbt"))
    spec = RC.serve_spec(trees, RC.M8_FEATURES, model_features=RC.M8_FEATURES)
    return series_, RC.recursive_forecast(spark, series_, _M8_HOURS, spec, 24, RC.station_codes(series_))


@register("forecast_fixed_range", f"WITH {O.series_ctes('type')}" + _grid_sql(_M8_HOURS))
def q_forecast_fixed_range(spark, sf):
    """M8: four calendar months by boosted trees over the ten newest values, trained on rows with
    the same names; every value is the model's."""
    series_, fc = _fixed_range(spark, sf)
    return _in_range(fc, 2.0 * series_.agg(F.max("rides")).first()[0])


@register("forecast_fixed_range_values")
def q_forecast_fixed_range_values(spark, sf):
    """M8's forecasts themselves."""
    return _fixed_range(spark, sf)[1]


M9_W, M9_H = 672, 168
M9_SQL = f"""WITH RECURSIVE {O.series_ctes('user')},
r AS (SELECT *, row_number() OVER (PARTITION BY start_station_id ORDER BY pickup_hour DESC) AS rn,
             max(pickup_hour) OVER (PARTITION BY start_station_id) AS last_hour FROM dense),
init AS (SELECT start_station_id, any_value(last_hour) AS last_hour,
                list(CAST(rides AS DOUBLE) ORDER BY pickup_hour) AS hist
         FROM r WHERE rn <= {M9_W} GROUP BY 1 HAVING count(*) = {M9_W}),
steps(start_station_id, last_hour, step, hist, pred) AS (
  SELECT start_station_id, last_hour, 0, hist, NULL::DOUBLE FROM init
  UNION ALL
  SELECT start_station_id, last_hour, step + 1,
         list_append(hist[2:], list_sum(hist) / {M9_W}.0), list_sum(hist) / {M9_W}.0
  FROM steps WHERE step < {M9_H})
SELECT start_station_id, last_hour + to_hours(CAST(step AS BIGINT)) AS pickup_hour, {O.r6('pred')} AS predicted_rides
FROM steps WHERE step > 0"""


@register("recursive_lag_mean", M9_SQL)
def q_recursive_lag_mean(spark, sf):
    return round_doubles(RC.recursive_lag_mean(user_series(spark, sf), M9_W, M9_H))


M11_NOW = dt.datetime(2024, 1, 30, 23, 15)


@register("run_forecast", RUN_FEATURES_CTES + _grid_sql(_horizon(dt.datetime(2024, 1, 31), 90 * 24)))
def q_run_forecast(spark, sf):
    fc = run_forecast(spark, sf, M11_NOW)
    return _in_range(fc, _target_range(spark, sf)[1], "predicted_demand")


@register("run_forecast_values")
def q_run_forecast_values(spark, sf):
    """M11's forecasts as they were written and read back."""
    return run_forecast(spark, sf, M11_NOW)


C22_NAMES = [c for c in feat.full_feature_names() if c not in feat.KEY_COLUMNS]
C22_SQL = RUN_FEATURES_CTES + f""",
z AS (SELECT start_station_id, CAST(rides AS DOUBLE) AS rides,
             row_number() OVER (PARTITION BY start_station_id ORDER BY pickup_hour DESC) AS rn FROM dense),
k AS (SELECT start_station_id FROM z GROUP BY 1 HAVING count(*) >= 672),
v AS (SELECT start_station_id AS station, {', '.join(
    [f"max(rides) FILTER (WHERE rn = {lag}) AS rides_lag_{lag}h" for lag in feat.LAG_HOURS]
    + [f"{fn}(rides) FILTER (WHERE rn <= {w}) AS rolling_{s}_{w}h" for w in feat.ROLL_WINDOWS
       for s, fn in (("mean", "avg"), ("max", "max"), ("std", "stddev_pop"))])}
  FROM z WHERE start_station_id IN (SELECT * FROM k) GROUP BY 1)
SELECT station, {', '.join(O.r6(c) + f" AS {c}" for c in feat.lag_names() + feat.rolling_names())}, """ + ", ".join(
    f"{O.r6(e.rsplit(' AS ', 1)[0])} AS {e.rsplit(' AS ', 1)[1]}" for e in O.time_feature_exprs("t", "serve")) + f"""
FROM v, (SELECT TIMESTAMP '{_horizon()[0]}' AS t)"""


@register("time_feature_row_serving", C22_SQL)
def q_time_feature_row_serving(spark, sf):
    """The serving feature vector of each station for the first forecast hour."""
    full = load_sets(spark, trained(spark, sf))["full_features"]
    names, ts = C22_NAMES, _horizon()[0]
    arrays = RC.history_arrays(full, 672, RC.station_codes(full))
    schema = "station string, " + ", ".join(f"`{n}` double" for n in names)

    def rows(batches):
        for pdf in batches:
            R = np.vstack(pdf["hist"].to_numpy()).astype(np.float64)
            X = RC.feature_matrix(names, R, pdf["code"].to_numpy(), ts, "serve")
            out = pd.DataFrame(X, columns=names)
            out.insert(0, "station", pdf["start_station_id"].to_numpy())
            yield out
    return round_doubles(arrays.mapInPandas(rows, schema))
