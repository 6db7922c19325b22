import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.operators import models as MD
from stationcast.operators import recursive as RC

H = dt.datetime(2024, 1, 1)


def test_baseline_predictor_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0, 10.0), (3.0, 5.0, 7.0, 20.0)],
                               "`rides_t-1` double, `rides_t-2` double, other double, rides double")
    m = MD.BaselinePredictor().fit(df)
    assert [r.prediction for r in m.transform(df).collect()] == [1.5, 4.0]
    m2 = MD.BaselinePredictor().fit(df.select("other", "rides"))
    assert [r.prediction for r in m2.transform(df.select("other", "rides")).collect()] == [15.0, 15.0]


def test_tree_export_matches_transform(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    df = spark.range(3000).selectExpr("CAST(id % 17 AS DOUBLE) a", "CAST(id % 7 AS DOUBLE) b",
                                      "CAST((id % 17) * 2 + id % 7 + (id % 3) * 0.5 AS DOUBLE) y")
    va = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    m = GBTRegressor(labelCol="y", maxIter=8, maxDepth=4, seed=1).fit(va.transform(df))
    trees = RC.export_trees(spark, m, tempfile.mkdtemp() + "/gbt")
    pdf = m.transform(va.transform(df)).select("a", "b", "prediction").toPandas()
    ours = RC.predict_trees(trees, pdf[["a", "b"]].to_numpy())
    assert np.max(np.abs(ours - pdf.prediction.to_numpy())) < 1e-9


def test_recursion_matches_closed_form(spark):
    rnd = np.random.default_rng(3)
    data = [(H + dt.timedelta(hours=i), s, int(rnd.integers(0, 9))) for s in ("a", "b") for i in range(40)]
    hist = spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")
    hours = RC.hourly_range(H + dt.timedelta(hours=40), H + dt.timedelta(hours=51))
    names = [f"rides_t-{k}" for k in range(1, 7)]
    kern = RC.recursive_forecast(spark, hist, hours, RC.serve_spec({"kind": "lag_mean"}, names), 6)
    closed = RC.recursive_lag_mean(hist, 6, 12)
    a = kern.select("start_station_id", "pickup_hour", F.round("predicted_rides", 9).alias("p"))
    b = closed.select("start_station_id", "pickup_hour", F.round("predicted_rides", 9).alias("p"))
    assert a.count() == 24 and a.exceptAll(b).count() == 0


def test_refresh_every_freezes_lags_inside_block():
    R = np.array([[4.0, 2.0]])
    spec = RC.serve_spec({"kind": "lag_mean"}, ["rides_t-1", "rides_t-2"], refresh_every=3)
    out = RC.run_recursion(R, np.array([0]), RC.hourly_range(H, H + dt.timedelta(hours=3)), spec)
    assert list(out[0]) == [3.0, 3.0, 3.0, 3.0]  # block 2 sees [3, 3] -> 3


def test_mismatched_features_are_an_error_unless_the_fallback_is_asked_for():
    with pytest.raises(ValueError):
        RC.run_recursion(np.ones((2, 3)), np.array([0, 1]), [H],
                         RC.serve_spec({"kind": "lag_mean"}, ["rides_lag_1"], model_features=["other"]))
    with pytest.raises(KeyError):
        RC.run_recursion(np.ones((2, 3)), np.array([0, 1]), [H], RC.serve_spec({"kind": "lag_mean"}, ["unknown"]))
    spec = RC.serve_spec({"kind": "lag_mean"}, ["rides_lag_1"], model_features=["other"], fallback=True)
    ts = dt.datetime(2024, 1, 6, 6)  # Saturday 06:00
    out = RC.run_recursion(np.ones((2, 3)), np.array([0, 1]), [ts], spec)
    assert np.allclose(out[:, 0], 5.0 * (0.7 + 0.6 * 0.5 * 0.7))


def test_model_improvement_formula(spark):
    m = spark.createDataFrame([("baseline", 4.0), ("full", 2.0), ("reduced", 3.0)], "model_name string, mae double")
    r = MD.model_improvement(m).first()
    assert (r.baseline_improvement, r.full_model_comparison) == (50.0, -50.0)
    assert MD.best_model(m).first().best_model == "full"


def naive_windows(line, end, win, ddof):
    w = line[:, end - win:end]
    return w.mean(axis=1), w.max(axis=1), w.std(axis=1, ddof=ddof)


@pytest.mark.parametrize("win", [1, 2, 7, 24])
def test_sliding_windows_match_whole_windows(win):
    rnd = np.random.default_rng(win)
    line = np.vstack([rnd.normal(1e6, 3, 150), rnd.integers(0, 5, 150), np.full(150, 4.25), rnd.normal(0, 1e-3, 150)]).astype(float)
    window, end = RC.SlidingStats(line, 24, win), 24
    for hop in [1] * 40 + [3, 10, 2 * win + 1, 0, 1, 5]:
        end += hop
        window.move(end)
        mean, top, std = naive_windows(line, end, win, 0)
        assert np.array_equal(window.max(), top)
        assert np.allclose(window.mean(), mean, rtol=1e-12, atol=1e-9) and np.allclose(window.std(0), std, rtol=1e-9, atol=1e-9)
        if win > 1:
            assert np.allclose(window.std(1), naive_windows(line, end, win, 1)[2], rtol=1e-9, atol=1e-9)
    assert window.std(0)[2] == 0.0


def test_recursion_with_rolling_features_matches_windows_made_anew():
    rnd = np.random.default_rng(9)
    names = ["rolling_mean_24h", "rolling_max_24h", "rolling_std_24h", "rolling_mean_48h", "rides_lag_3h"]
    R = rnd.integers(0, 20, (5, 48)).astype(float)
    for every in (1, 5):
        hours = RC.hourly_range(H, H + dt.timedelta(hours=120))
        got = RC.run_recursion(R, np.zeros(5), hours, RC.serve_spec({"kind": "lag_mean"}, names, refresh_every=every))
        line, end = R[:, ::-1].copy(), 48
        for h in range(len(hours)):
            shown = line[:, :end]
            mean, top, std = naive_windows(shown, end, 24, 0)
            want = np.column_stack([mean, top, std, shown[:, end - 48:].mean(axis=1), shown[:, end - 3]]).mean(axis=1)
            assert np.allclose(got[:, h], want, rtol=1e-9, atol=1e-9)
            line = np.column_stack([line, want])
            if line.shape[1] - end == every:
                end = line.shape[1]


def test_lag_mean_over_horizons_around_the_window(spark):
    data = [(H + dt.timedelta(hours=i), "a", i * i % 7) for i in range(9)]
    hist = spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")
    for horizon in (1, 3, 4, 5, 13):
        line = [float(r) for _, _, r in data[-4:]]
        for _ in range(horizon):
            line.append(sum(line[-4:]) / 4)
        got = [r.predicted_rides for r in RC.recursive_lag_mean(hist, 4, horizon).orderBy("pickup_hour").collect()]
        assert len(got) == horizon and np.allclose(got, line[4:], atol=1e-9)


def test_compare_models_sends_no_frame_through_the_driver(spark):
    actual = spark.createDataFrame([(H, "a", 3), (H, "b", 0), (H, "b", 0)], "pickup_hour timestamp_ntz, start_station_id string, rides long")
    frames = {m: spark.createDataFrame(rows, "pickup_hour timestamp_ntz, start_station_id string, prediction double")
              for m, rows in (("full", [(H, "a", 1.0), (H, "b", 2.0)]), ("reduced", [(H, "a", 4.0)]))}
    got = MD.compare_models(actual, frames)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    assert sorted((r.start_station_id, r.actual, r.full, r.reduced) for r in got.collect()) \
        == [("a", 3.0, 1.0, 4.0), ("b", 0.0, 2.0, None), ("b", 0.0, 2.0, None)]
