import datetime as dt

import pytest

from stationcast.operators import clean


def trips(spark, data):
    return spark.createDataFrame(
        data, "ride_id string, started_at string, ended_at string, start_station_id string, end_station_id string")


EDGE = [
    ("zero", "2024-01-10 08:00:00", "2024-01-10 08:00:00", "a", "b"),       # duration 0 -> out
    ("day", "2024-01-10 08:00:00", "2024-01-11 08:00:00", "a", "b"),        # exactly 24 h -> in
    ("day+1s", "2024-01-10 08:00:00", "2024-01-11 08:00:01", "a", "b"),     # 24 h + 1 s -> out
    ("bad", "not a date", "2024-01-10 08:00:00", "a", "b"),                 # unparseable -> dropped
    ("us", "01-15-2024 08:30", "01-15-2024 08:45", "a", "b"),               # month-first text -> in
    ("nostation", "2024-01-10 08:00:00", "2024-01-10 08:10:00", "a", None),  # null end station -> out
    ("feb", "2024-02-01 00:00:00", "2024-02-01 00:10:00", "a", "b"),        # next month -> out
]


def test_edge_rows(spark):
    out = {r.ride_id: r for r in clean.clean_trips(trips(spark, EDGE), 2024, 1).collect()}
    assert set(out) == {"day", "us"}
    assert out["us"].started_at == dt.datetime(2024, 1, 15, 8, 30)


def test_december_rolls_to_january(spark):
    rows = [("dec", "2024-12-31 23:00:00", "2024-12-31 23:30:00", "a", "b"),
            ("jan", "2025-01-01 00:00:00", "2025-01-01 00:30:00", "a", "b")]
    got = [r.ride_id for r in clean.clean_trips(trips(spark, rows), 2024, 12).collect()]
    assert got == ["dec"]


def test_clean_stats_counts_after_parse(spark):
    r = clean.clean_stats(trips(spark, EDGE), 2024, 1).first()
    assert (r.total_records, r.valid_records, r.records_dropped) == (6, 2, 4)
    assert abs(r.percent_dropped - 66.666667) < 1e-6


def test_month_validation():
    with pytest.raises(ValueError):
        clean.month_bounds(2024, 13)
