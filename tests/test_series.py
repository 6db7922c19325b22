import datetime as dt

from pyspark.sql import functions as F

from stationcast.operators import series

H = dt.datetime(2024, 1, 1)


def hourly(spark, data):
    return spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")


def test_dense_grid_fills_every_hour_and_station(spark):
    df = hourly(spark, [(H, "a", 3), (H + dt.timedelta(hours=3), "a", 1), (H + dt.timedelta(hours=1), "b", 2)])
    out = series.dense_grid(df).collect()
    assert len(out) == 4 * 2  # 4 hours x 2 stations
    got = {(r.start_station_id, r.pickup_hour): r.rides for r in out}
    assert got[("a", H)] == 3 and got[("a", H + dt.timedelta(hours=1))] == 0
    assert got[("b", H)] == 0 and got[("b", H + dt.timedelta(hours=3))] == 0
    assert sum(got.values()) == 6


def test_dense_grid_one_row_station(spark):
    df = hourly(spark, [(H, "a", 1), (H + dt.timedelta(hours=2), "b", 5)])
    out = series.dense_grid(df)
    assert out.count() == 6
    assert out.where("start_station_id = 'b'").agg(F.sum("rides")).first()[0] == 5


def test_hourly_demand_and_grid_invariants(spark):
    from stationcast.sources.tables import trips_view
    t = trips_view(spark, "/root/testdata/sf0.001")
    dense = series.transform_to_series(t)
    n_st = t.select("start_station_id").distinct().count()
    b = dense.agg(F.min("pickup_hour"), F.max("pickup_hour")).first()
    hours = int((b[1] - b[0]).total_seconds() // 3600) + 1
    assert dense.count() == n_st * hours
    assert dense.agg(F.sum("rides")).first()[0] == t.count()
    assert dense.groupBy("start_station_id", "pickup_hour").count().where("count > 1").count() == 0


def test_top_stations_ties_by_id(spark):
    t = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "start_station_id string")
    top = [r.start_station_id for r in series.top_stations(t, 2).collect()]
    assert top == ["c", "a"]
