"""Plan-shape guards: the properties the scale design depends on."""

import re

from stationcast.operators import features as feat
from stationcast.operators import series
from stationcast.sources.tables import trips_by_user

SF = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    """Shuffles of the plan that ran (the initial plan below it is left out)."""
    return re.findall(r"Exchange (?:hash|range)partitioning", plan.split("Initial Plan")[0])


def test_dense_series_scans_narrowly_and_features_add_no_shuffle(spark):
    grid = series.transform_to_series(trips_by_user(spark, SF))
    plan_grid = executed(grid)
    # the counts' scan, and the range's scan of the time column alone; nothing is cached
    assert "InMemoryRelation" not in plan_grid
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan_grid)) == {"ts:timestamp_ntz,user_id:bigint", "ts:timestamp_ntz"}
    assert len(exchanges(executed(feat.full_features(grid)))) == len(exchanges(plan_grid))


def test_store_reads_only_the_folders_asked_for(spark, tmp_path):
    import datetime as dt
    from stationcast.operators import store as S
    root = str(tmp_path / "store")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    days = [dt.datetime(2024, m, 2) for m in (1, 2, 3)]
    b = spark.createDataFrame([(d, "a", 1, 1) for d in days], "pickup_hour timestamp_ntz, start_station_id string, rides bigint, n int")
    S.upsert_into_store(spark, root, S.feature_json(b, "g", order_col="n"))
    touched = spark.createDataFrame([("g", "2024-02")], "feature_group string, ts_month string")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", executed(S.touched_rows(S.read_store(spark, root), touched)))[1]
    assert "ts_month#" in filters and "2024-02" in filters and "2024-01" not in filters
    got = executed(S.get_features(S.read_store(spark, root), "g", S.feature_schema(b.drop("n")), start_time="2024-03-01"))
    assert "ts_month" in re.search(r"PartitionFilters: \[([^\]]*)\]", got)[1]


def test_hourly_demand_is_partially_aggregated_before_the_shuffle(spark):
    plan = executed(series.hourly_demand(trips_by_user(spark, SF)))
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
