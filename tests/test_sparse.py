"""Features from sparse counts against the dense grid's windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationcast.operators import features as feat
from stationcast.operators import series, sparse

H = dt.datetime(2024, 1, 1)
NAMES = ["rides", *feat.lag_names(), *feat.rolling_names()]


def hourly(spark, signed=False, seed=1):
    rnd = random.Random(seed)
    rows = [(H, "first", 1), (H + dt.timedelta(hours=1500), "last", 2), (H + dt.timedelta(hours=700), None, 3)]
    for s, share in (("busy", 0.97), ("a", 0.2), ("rare", 0.004)):
        rows += [(H + dt.timedelta(hours=i), s, rnd.randint(-4, 9) if signed else rnd.randint(1, 9))
                 for i in range(1501) if rnd.random() < share]
    return spark.createDataFrame(rows, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")


def keyed(df):
    return {(r.start_station_id, r.pickup_hour): [round(float(r[c]), 6) for c in NAMES] for r in df.collect()}


def dense(df):
    return keyed(feat.fill_null_zero(feat.lag_features(feat.rolling_features(series.dense_grid(df)))))


@pytest.mark.parametrize("signed", [False, True])
def test_every_hour_equals_the_dense_grid(spark, signed, monkeypatch):
    df = hourly(spark, signed)
    assert keyed(sparse.sparse_features(df)) == dense(df)


def test_small_slices_and_holds(spark, monkeypatch):
    """Stations that go on over several Arrow batches, and outputs cut anywhere."""
    df = hourly(spark)
    want = dense(df)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        monkeypatch.setattr(sparse, "HELD", 150)
        monkeypatch.setattr(sparse, "SLICE", 61)
        assert keyed(sparse.sparse_features(df, num_partitions=2)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_asked_hours_only(spark):
    df = hourly(spark)
    want = dense(df)
    asked = [k for i, k in enumerate(sorted(want, key=str)) if i % 37 == 0]
    asked = asked + asked[:5]                                    # asked twice, answered twice
    rows = spark.createDataFrame([(h, s) for s, h in asked], "pickup_hour timestamp_ntz, start_station_id string")
    got = sparse.sparse_features(df, rows)
    assert got.count() == len(asked) and keyed(got) == {k: want[k] for k in asked}


def test_hours_outside_and_unknown_stations(spark):
    df = hourly(spark)
    after = H + dt.timedelta(hours=1501)
    rows = spark.createDataFrame([(after, "busy"), (H - dt.timedelta(hours=3), "busy"), (H, "nobody")],
                                 "pickup_hour timestamp_ntz, start_station_id string")
    got = {(r.start_station_id, r.pickup_hour): r for r in sparse.sparse_features(df, rows).collect()}
    last = df.where("start_station_id = 'busy'").agg(F.max_by("rides", "pickup_hour")).first()[0]
    assert got["busy", after].rides == 0 and got["busy", after].rolling_max_24h >= last
    assert all(got["nobody", H][c] == 0 for c in NAMES) and all(got["busy", H - dt.timedelta(hours=3)][c] == 0 for c in NAMES)


def test_empty_input(spark):
    none = spark.createDataFrame([], "pickup_hour timestamp_ntz, start_station_id string, rides bigint")
    assert sparse.sparse_features(none).count() == 0


def test_rows_shuffled_are_the_events(spark):
    """No grid in the plan: one exchange of the counts, no window, no generator."""
    df = sparse.sparse_features(hourly(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan
