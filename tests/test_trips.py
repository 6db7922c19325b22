import pytest
from pyspark.sql import functions as F

from stationcast.functions import trip as TF
from stationcast.operators import trips as TR


def test_haversine_and_length_buckets(spark):
    df = spark.createDataFrame([(40.7, -74.0, 40.7, -74.0), (40.7, -74.0, 41.7, -74.0), (40.7, -74.0, 40.71, -74.0)],
                               "start_lat double, start_lng double, end_lat double, end_lng double")
    out = TR.geo_features(df).collect()
    assert out[0].distance_km == 0.0 and out[0].trip_length is None        # zero distance: no bucket
    assert out[1].distance_km > 100 and out[1].trip_length is None         # > 100 km: no bucket
    assert abs(out[2].distance_km - 1.111949) < 1e-5 and out[2].trip_length == "medium"


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([("classic_bike",), ("electric_bike",), (None,)], "rideable_type string")
    out = TR.one_hot(df, "rideable_type", "bike").collect()
    assert [(r.bike_classic_bike, r.bike_electric_bike) for r in out] == [(1, 0), (0, 1), (0, 0)]


def test_one_hot_of_many_values(spark):
    df = spark.range(3000).selectExpr("id", "concat('v', lpad(cast(id % 1500 as string), 4, '0')) AS kind")
    wide = TR.one_hot(df, "kind", "k")
    assert len(wide.columns) == 1502
    row = wide.where("id = 1499").first()
    assert row["k_v1499"] == 1 and sum(row[c] for c in wide.columns[2:]) == 1
    assert TR.one_hot_long(df, "id", "kind").where("value = 'v0007'").count() == 2


def test_popularity_quartiles_and_duplicate_edges(spark):
    # stations with 1..10 trips: row-level edges 1, 5, 7, 9, 10
    data = [(f"s{n:02d}",) for n in range(1, 11) for _ in range(n)]
    t = spark.createDataFrame(data, "start_station_id string")
    out = TR.popularity_bucket(TR.attach_popularity(t), TR.popularity_edges(t))
    labels = dict(out.select("start_station_id", "station_popularity_category").distinct().collect())
    assert [labels[f"s{n:02d}"] for n in (1, 5, 6, 7, 8, 9, 10)] == [
        "low", "low", "medium", "medium", "high", "high", "very_high"]
    same = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "start_station_id string")
    with pytest.raises(Exception):
        TR.popularity_bucket(TR.attach_popularity(same), TR.popularity_edges(same)).collect()


def test_round_trip_with_unknown_end(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None)], "s string, e string")
    assert [r[0] for r in df.select(TF.round_trip(F.col("s"), F.col("e"))).collect()] == [1, 0, 0]


def test_trip_view_of_some_columns(spark):
    from stationcast.plans.pipelines import CLEANED_BY
    from stationcast.sources.tables import trips_view
    sf = "/root/testdata/sf0.001"
    some = trips_view(spark, sf, ends=True, columns=CLEANED_BY)
    assert tuple(some.columns) == CLEANED_BY
    whole = trips_view(spark, sf, ends=True).select(*CLEANED_BY)
    assert some.exceptAll(whole).count() == whole.exceptAll(some).count() == 0
