"""Explicit schemas, column aliases and the column resolver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw trip record as published by the bike-share operator (13 columns).
TRIP_SCHEMA = T.StructType([
    T.StructField("ride_id", T.StringType()),
    T.StructField("rideable_type", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("ended_at", T.StringType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("end_station_id", T.StringType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("start_lng", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
    T.StructField("end_lng", T.DoubleType()),
    T.StructField("member_casual", T.StringType()),
])
TRIP_COLUMNS = [f.name for f in TRIP_SCHEMA.fields]

FORECAST_SCHEMA = T.StructType([
    T.StructField("start_station_id", T.StringType()),
    T.StructField("pickup_hour", T.TimestampNTZType()),
    T.StructField("predicted_rides", T.DoubleType()),
])

# Column-name aliases accepted at run time (first present wins).
STARTED_AT = ("started_at", "pickup_datetime")
STATION = ("start_station_id", "pickup_station_id", "pickup_location_id")
PREDICTION = ("predicted_demand", "predicted_rides")

# Store bookkeeping columns that are never features.
META_COLUMNS = ("entity_id", "event_time", "record_insertion_time", "write_time",
                "api_invocation_time", "is_deleted")

KEYS = ("pickup_hour", "start_station_id")
TARGET = "rides"


def resolve_column(df: DataFrame, *aliases: str, required: bool = True) -> str | None:
    """Return the first alias present in ``df``; fail when none is and required."""
    cols = set(df.columns)
    for name in aliases:
        if name in cols:
            return name
    if required:
        raise ValueError(f"none of the columns {list(aliases)} found in {df.columns}")
    return None


def require_columns(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
