"""Run-time guards (the reference's stand-ins for tests)."""

import datetime as dt

import pytest

from stationcast.operators import prep as PR
from stationcast.operators import reports as R
from stationcast.sources import feature_files as FF
from stationcast.sources import trip_files as TFILES


def forecast(spark):
    return spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), float(h)) for h in range(24)],
                                 "start_station_id string, pickup_hour timestamp_ntz, predicted_rides double")


def test_forecast_summary_rejects_unknown_group(spark):
    with pytest.raises(ValueError):
        R.forecast_summary(forecast(spark), "week")


def test_last_n_hours_takes_any_window_inclusive(spark):
    with pytest.raises(ValueError):
        R.last_n_hours(forecast(spark), -1)
    assert R.last_n_hours(forecast(spark), 6).count() == 7
    assert R.last_n_hours(forecast(spark), 1000).count() == 24
    assert R.last_n_hours(forecast(spark), 12).count() == 13  # both ends inclusive


def test_station_series_requires_rows(spark):
    with pytest.raises(ValueError):
        R.station_series(forecast(spark), "zz", require=True)


def test_unsupported_feature_file_and_missing_sets(spark, tmp_path):
    with pytest.raises(ValueError):
        FF.scan_features(spark, str(tmp_path / "x.json"))
    with pytest.raises(ValueError):
        FF.scan_feature_sets(spark, {"full_features": [(str(tmp_path / "none.parquet"), "parquet")]})


def test_month_range_rejects_bad_month(spark, tmp_path):
    with pytest.raises(ValueError):
        TFILES.month_range_scan(spark, str(tmp_path), (2024, 0), (2024, 3))
    with pytest.raises(ValueError):
        TFILES.union_months([])
    with pytest.raises(ValueError):
        TFILES.scan_trips(spark, str(tmp_path), 2024, 1)


def trip_file(folder, header, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"f{len(list(folder.iterdir()))}.csv").write_text("\n".join([header, *rows]) + "\n")


def test_trip_files_are_read_by_header_name(spark, tmp_path):
    trip_file(tmp_path / "year=2024/month=1", "member_casual,ended_at,ride_id,started_at,end_station_id,start_station_id",
              "casual,2024-01-01 01:00:00,V,2024-01-01 00:30:00,e,s", "x,y")
    df = TFILES.scan_trips(spark, str(tmp_path), 2024, 1)
    row = df.where("ride_id = 'V'").first()
    assert (row.member_casual, row.start_station_id, row.end_station_id, row.start_lat) == ("casual", "s", "e", None)
    assert tuple(TFILES.malformed_rows(df).first()) == (1, 1)


def test_trip_files_with_missing_or_differing_headers_fail(spark, tmp_path):
    trip_file(tmp_path / "year=2024/month=1", "ride_id,started_at", "a,b")
    with pytest.raises(ValueError):
        TFILES.scan_trips(spark, str(tmp_path), 2024, 1)
    full = "ride_id,started_at,ended_at,start_station_id,end_station_id"
    trip_file(tmp_path / "year=2024/month=2", full, "a,b,c,d,e")
    trip_file(tmp_path / "year=2024/month=2", "started_at,ride_id,ended_at,start_station_id,end_station_id", "a,b,c,d,e")
    with pytest.raises(Exception):
        TFILES.scan_trips(spark, str(tmp_path), 2024, 2).collect()


def rewritten_events(spark, folder, rows):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(rows).toPandas()
    (folder / "events.parquet").unlink(missing_ok=True)
    ev.to_parquet(folder / "events.parquet", coerce_timestamps="us")


def test_changed_input_changes_the_answer_and_nothing_stays_persisted(spark, tmp_path):
    import __spark_entry__ as E
    queries, jsc = E.queries(), spark.sparkContext._jsc.sc()
    held = jsc.getPersistentRDDs().size()
    counts = []
    for n in (1000, 500):
        rewritten_events(spark, tmp_path, n)
        spark.catalog.refreshByPath(str(tmp_path))
        rides = queries["dense_grid"](spark, str(tmp_path)).groupBy().sum("rides").first()[0]
        split = queries["time_split"](spark, str(tmp_path)).groupBy().sum("rides").first()[0]
        counts.append((rides, split))
        for key in ("hourly_demand", "clean_trips", "mae", "upsert_features"):
            queries[key](spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
            assert jsc.getPersistentRDDs().size() == held
    assert counts == [(1000, 1000), (500, 500)]


def test_training_notices_changed_input(spark, tmp_path):
    from stationcast.plans.training import input_fingerprint
    rewritten_events(spark, tmp_path, 100)
    first = input_fingerprint(spark, str(tmp_path / "events.parquet"))
    assert input_fingerprint(spark, str(tmp_path / "events.parquet")) == first
    rewritten_events(spark, tmp_path, 50)
    assert input_fingerprint(spark, str(tmp_path / "events.parquet")) != first


def test_non_numeric_columns_are_rejected(spark):
    df = spark.createDataFrame([("a", 1.0)], "s string, x double")
    with pytest.raises(ValueError):
        PR.assert_numeric(df)


def test_trip_files_of_three_header_orders_take_one_scan_each(spark, tmp_path):
    columns = ["ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"]
    for month in range(1, 13):
        order = columns[month % 3:] + columns[:month % 3]
        values = {"ride_id": f"r{month}", "started_at": "a", "ended_at": "b", "start_station_id": "s", "end_station_id": "e"}
        trip_file(tmp_path / f"year=2024/month={month}", ",".join(order), ",".join(values[c] for c in order))
    root = str(tmp_path)
    assert sorted(map(len, TFILES.header_catalogue(spark, root, 2024 * 12 + 2, 2024 * 12 + 11).values())) == [3, 3, 4]
    df = TFILES.scan_trips(spark, root, 2024, 2, 11)
    got = sorted((r.month, r.ride_id, r.start_station_id, r.end_station_id) for r in df.collect())
    assert got == [(m, f"r{m}", "s", "e") for m in range(2, 12)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3


def test_archives_are_streamed_member_by_member(spark, tmp_path):
    import zipfile
    from stationcast.schemas import TRIP_COLUMNS
    from stationcast.sources.archives import scan_zipped_csv
    head = ",".join(TRIP_COLUMNS)
    with zipfile.ZipFile(tmp_path / "a b%20.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("__MACOSX/x.csv", "junk")
        for name in ("one.csv", "in/two.csv"):
            zf.writestr(name, "\n".join([head, *(f"{name}{i}" + "," * (len(TRIP_COLUMNS) - 1) for i in range(250_000))]))
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as zf:
        zf.writestr(".hidden.csv", "junk")
    first = scan_zipped_csv(spark, f"{tmp_path}/*.zip")
    assert first.count() == 250_000 and first.where("ride_id like 'in/%'").isEmpty()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan       # no archive's bytes are a value
    every = scan_zipped_csv(spark, f"{tmp_path}/*.zip", every_member=True)
    assert every.count() == 500_000 and every.select("ride_id").distinct().count() == 500_000
