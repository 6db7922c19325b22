import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationcast.operators import features as feat

H = dt.datetime(2024, 1, 1)


def series_df(spark, n=800, stations=("a", "b", "c"), signed=False, seed=7):
    rnd = random.Random(seed)
    data = []
    for s in stations:
        for i in range(n if s != "c" else 5):  # "c": shorter than every window
            v = rnd.randint(-5, 9) if signed else rnd.randint(0, 9)
            data.append((H + dt.timedelta(hours=i), s, v))
    return spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")


def test_fast_rolling_equals_sliding_frames(spark):
    df = series_df(spark)
    names = feat.rolling_names()
    fast = feat.rolling_features(df).select("pickup_hour", "start_station_id", *[F.round(c, 6).alias(c) for c in names])
    slow = feat.rolling_features_naive(df).select("pickup_hour", "start_station_id", *[F.round(c, 6).alias(c) for c in names])
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_doubling_max_handles_signed_values(spark):
    df = series_df(spark, n=300, signed=True)
    names = [f"rolling_max_{w}h" for w in feat.ROLL_WINDOWS]
    fast = feat.rolling_features(df).select("pickup_hour", "start_station_id", *names)
    slow = feat.rolling_features_naive(df).select("pickup_hour", "start_station_id", *names)
    assert fast.exceptAll(slow).count() == 0


def test_lag_k_is_value_k_rows_back(spark):
    df = series_df(spark, n=200)
    out = feat.lag_features(df).where("start_station_id = 'a'").orderBy("pickup_hour").collect()
    for i in (0, 5, 30, 199):
        for k in (1, 24, 168):
            want = float(out[i - k].rides) if i - k >= 0 else 0.0
            assert out[i][f"rides_lag_{k}h"] == want


def test_full_feature_columns_and_zero_fill(spark):
    df = series_df(spark, n=100)
    out = feat.full_features(df)
    assert out.columns == feat.full_feature_names()
    assert len(out.columns) == 39
    nulls = out.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in out.columns]).first()
    assert all(v == 0 for v in nulls)


def test_fill_null_zero_only_lag_and_rolling(spark):
    df = spark.createDataFrame([(None, None, None)], "rides_lag_1h double, rolling_std_24h double, other double")
    r = feat.fill_null_zero(df).first()
    assert r.rides_lag_1h == 0 and r.rolling_std_24h == 0 and r.other is None


def test_calendar_iso_week_and_rush_flags(spark):
    from stationcast.functions.calendar import time_features
    df = spark.createDataFrame([(dt.datetime(2024, 12, 30, 8),), (dt.datetime(2024, 1, 6, 8),)],
                               "pickup_hour timestamp_ntz")
    r = time_features(df).orderBy("pickup_hour").collect()
    assert (r[0].week_of_year, r[0].is_weekend, r[0].is_morning_rush) == (1, 1, 0)  # Saturday
    assert (r[1].week_of_year, r[1].year, r[1].is_morning_rush, r[1].day_of_week) == (1, 2024, 1, 0)


def doubles_df(spark):
    """Fractional values of very different sizes, with nulls, a NaN and an infinity in stations of their own."""
    rnd = random.Random(4)
    data = []
    for s in ("a", "b", "c", "n", "i"):
        for i in range(5 if s == "c" else 800):
            v = rnd.uniform(-1, 1) if s != "b" else 1e9 + rnd.uniform(-1, 1)
            if s == "a" and i % 7 == 0:
                v = None
            if s in "ni" and i == 30:
                v = float("nan") if s == "n" else float("inf")
            data.append((H + dt.timedelta(hours=i), s, v))
    return spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides double")


def test_rolling_of_any_number_type(spark):
    import math
    df = doubles_df(spark)
    out = feat.rolling_features(df)
    names = feat.rolling_names()
    fast = {(r.start_station_id, r.pickup_hour): [r[c] for c in names] for r in out.collect()}
    slow = {(r.start_station_id, r.pickup_hour): [r[c] for c in names] for r in feat.rolling_features_naive(df).collect()}
    same = lambda x, y: (math.isnan(x) and math.isnan(y)) or x == y or math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-9)
    assert fast.keys() == slow.keys()
    assert [(k, c, x, y) for k in fast for c, x, y in zip(names, fast[k], slow[k]) if not same(x, y)][:5] == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "avg(" not in plan and "stddev" not in plan      # lags only, no sliding frame


def test_decimal_and_float_values(spark):
    for kind in ("decimal(12,3)", "float"):
        df = series_df(spark, n=60).withColumn("rides", (F.col("rides") / 4).cast(kind))
        names = feat.rolling_names()
        cols = ["pickup_hour", "start_station_id", *[F.round(c, 6).alias(c) for c in names]]
        assert feat.rolling_features(df).select(*cols).exceptAll(feat.rolling_features_naive(df).select(*cols)).count() == 0
