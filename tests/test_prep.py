import datetime as dt

from pyspark.sql import functions as F

from stationcast.operators import prep as PR

H = dt.datetime(2024, 1, 1)


def test_sliding_window_matches_manual(spark):
    data = [(H + dt.timedelta(hours=i), "a", i * 10, float(i)) for i in range(6)] + \
           [(H + dt.timedelta(hours=i), "short", i, 0.0) for i in range(3)]  # <= W rows: skipped
    df = spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint, f double")
    out = PR.sliding_window_features(df, "rides", window_size=3, step_size=2).orderBy("pickup_hour").collect()
    assert [r.start_station_id for r in out] == ["a", "a"]
    first = out[0]  # examples j = 3 and 5
    assert (first.target, first["rides_t-3"], first["rides_t-1"], first.f) == (30, 0, 20, 2.0)
    assert first.pickup_hour == H + dt.timedelta(hours=2)
    assert out[1].target == 50


def test_time_split_is_disjoint(spark):
    df = spark.createDataFrame([(H + dt.timedelta(hours=i), "a") for i in range(10)],
                               "pickup_hour timestamp_ntz, start_station_id string")
    lab = PR.time_split(df)
    tr = lab.where("split = 'train'").agg(F.max("pickup_hour")).first()[0]
    te = lab.where("split = 'test'").agg(F.min("pickup_hour")).first()[0]
    assert tr < te and te == H + dt.timedelta(hours=8)


def test_label_encode_unseen_is_minus_one(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    te = spark.createDataFrame([("a",), ("z",)], "c string")
    a, b = PR.label_encode(tr, te, ["c"])
    assert sorted(r.c for r in a.collect()) == [0, 1, 1]
    assert sorted(r.c for r in b.collect()) == [-1, 0]


def test_expand_datetime_and_numeric_guard(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3), 1.0)], "pickup_hour timestamp_ntz, x double")
    r = PR.expand_datetime(df).first()
    assert (r.pickup_hour_hour, r.pickup_hour_dayofweek, r.pickup_hour_timestamp) == (3, 1, 1704164400)
    PR.assert_numeric(PR.expand_datetime(df))


def test_recent_history_skips_short_stations(spark):
    data = [(H + dt.timedelta(hours=i), "a", i) for i in range(5)] + [(H, "b", 1)]
    df = spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")
    out = PR.recent_history(df, 3).orderBy("_age").collect()
    assert [(r.start_station_id, r.rides) for r in out] == [("a", 4), ("a", 3), ("a", 2)]
