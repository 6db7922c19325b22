"""Forecast scaffolding and the deterministic forecasts.

The recursive model-driven forecasts (M6-M8) live in ``recursive.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.forecast_exprs import (DEFAULT_BASE_DEMAND, daily_shape, hour_sequence,
                                        seasonal_shape)
from .clean import ntz_literal

STATION = "start_station_id"


def forecast_scaffold(stations: DataFrame, start: dt.datetime, end: dt.datetime,
                      station: str = STATION) -> DataFrame:
    """Stations x hours [start, end], ``predicted_rides`` null.

    Each station row is exploded into its hours in place: no join, and the
    output is partitioned like the station list.
    """
    return stations.select(F.col(station).alias(STATION),
                           F.explode(hour_sequence(ntz_literal(start), ntz_literal(end))).alias("pickup_hour"),
                           F.lit(None).cast("double").alias("predicted_rides"))


def horizon_bounds(history: DataFrame, hours: int, ts: str = "pickup_hour") -> DataFrame:
    """One row (_lo, _hi): the ``hours`` hours after the last history hour."""
    return history.agg(F.max(ts).alias("_mx")).select(
        (F.col("_mx") + F.expr("INTERVAL 1 HOUR")).alias("_lo"),
        (F.col("_mx") + F.expr(f"INTERVAL {hours} HOURS")).alias("_hi"))


def base_demand(history: DataFrame, stations: DataFrame | None = None,
                value: str = "rides", station: str = STATION) -> DataFrame:
    """Mean history value per station; stations without history get 5.0."""
    means = history.groupBy(station).agg(F.avg(value).alias("base_demand"))
    if stations is None:
        return means
    return (stations.select(station).distinct().join(means, station, "left")
            .withColumn("base_demand", F.coalesce("base_demand", F.lit(DEFAULT_BASE_DEMAND))))


def scaffold_after(history: DataFrame, hours: int = 168, station: str = STATION) -> DataFrame:
    """Stations of ``history`` x the next ``hours`` hours, with their base demand.

    The bounds are a one-row aggregate (bounded broadcast); the per-station
    table has one row per station.
    """
    base = base_demand(history, station=station)
    bounds = horizon_bounds(history, hours)
    return (base.crossJoin(F.broadcast(bounds))
            .select(station, F.explode(hour_sequence(F.col("_lo"), F.col("_hi"))).alias("pickup_hour"),
                    "base_demand"))


def synthetic_forecast(history: DataFrame, hours: int = 168, seasonal: bool = False,
                       noise: bool = False) -> DataFrame:
    """C16 (and C17 when ``seasonal``): start_station_id, pickup_hour, predicted_rides."""
    sc = scaffold_after(history, hours)
    ts, base = F.col("pickup_hour"), F.col("base_demand")
    if seasonal:
        key = F.concat_ws("|", F.col(STATION), ts.cast("string")) if noise else None
        pred = seasonal_shape(ts, base, key)
    else:
        pred = daily_shape(ts, base)
    return sc.select(STATION, "pickup_hour", pred.alias("predicted_rides"))
