"""Reporting operators over forecasts and history.

Every report is a DataFrame; nothing is rendered.  Scalars that bound a
filter (max hour, min forecast hour) stay in the plan as one-row aggregates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.forecast_exprs import day_name, month_name
from ..schemas import PREDICTION, STATION, resolve_column
from .clean import ntz_literal


def _pred(df: DataFrame) -> str:
    return resolve_column(df, *PREDICTION)


def filter_date_range(df: DataFrame, start_date: dt.date, end_date: dt.date,
                      ts: str = "pickup_hour") -> DataFrame:
    """Start 00:00 to end 23:59:59.999999, inclusive."""
    lo = dt.datetime.combine(start_date, dt.time.min)
    hi = dt.datetime.combine(end_date, dt.time.max)
    return df.where(F.col(ts).between(ntz_literal(lo), ntz_literal(hi)))


def last_n_hours(df: DataFrame, n: int = 48, ts: str = "pickup_hour") -> DataFrame:
    """Rows within n hours of the latest hour, both ends inclusive."""
    if n < 0:
        raise ValueError("n must not be negative")
    hi = df.agg(F.max(ts).alias("_hi"))  # one row: bounded broadcast
    return (df.crossJoin(F.broadcast(hi))
            .where(F.col(ts).between(F.col("_hi") - F.expr(f"INTERVAL {n} HOURS"), F.col("_hi")))
            .drop("_hi"))


def last_7_days(df: DataFrame, now: dt.datetime, ts: str = "pickup_hour") -> DataFrame:
    """History with hour >= now - 7 days (``now`` is a parameter)."""
    return df.where(F.col(ts) >= ntz_literal(now - dt.timedelta(days=7)))


def station_series(df: DataFrame, station_id: str, ts: str = "pickup_hour",
                   require: bool = False) -> DataFrame:
    """P10: one station's rows, by hour."""
    st = resolve_column(df, *STATION)
    out = df.where(F.col(st) == F.lit(station_id)).orderBy(ts)
    if require and out.limit(1).count() == 0:
        raise ValueError(f"no data found for station {station_id}")
    return out


def kpis(df: DataFrame) -> DataFrame:
    """A4: mean and max prediction, distinct stations."""
    p, st = _pred(df), resolve_column(df, *STATION)
    return df.agg(F.avg(p).alias("avg_predicted"), F.max(p).alias("max_predicted"),
                  F.count_distinct(st).alias("total_stations"))


def total_by_hour(df: DataFrame, ts: str = "pickup_hour") -> DataFrame:
    """A5: sum of predictions per hour."""
    p = _pred(df)
    return df.groupBy(ts).agg(F.sum(p).alias(p)).orderBy(ts)


def avg_by_hour_of_day(df: DataFrame, ts: str = "pickup_hour") -> DataFrame:
    """Mean prediction per hour of day 0-23."""
    p = _pred(df)
    return df.groupBy(F.hour(ts).alias("hour_of_day")).agg(F.avg(p).alias(p)).orderBy("hour_of_day")


def avg_by_weekday(df: DataFrame, ts: str = "pickup_hour") -> DataFrame:
    """Mean prediction per weekday (Monday=0) with its name, by weekday."""
    p = _pred(df)
    return (df.groupBy(F.weekday(ts).alias("day_of_week"), day_name(F.weekday(ts)).alias("day_name"))
            .agg(F.avg(p).alias(p)).orderBy("day_of_week"))


SUMMARY_GROUPS = ("month", "day", "hour", "day_of_week")


def forecast_summary(df: DataFrame, group_by: str = "month", ts: str = "pickup_hour") -> DataFrame:
    """Mean prediction by station x {month | day | hour | day_of_week}."""
    p, st = _pred(df), resolve_column(df, *STATION)
    parts = {"month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts),
             "day_of_week": F.weekday(ts)}
    if group_by not in parts:
        raise ValueError(f"invalid group_by {group_by!r}; use one of {SUMMARY_GROUPS}")
    out = df.groupBy(st, parts[group_by].alias(group_by)).agg(F.avg(p).alias(p))
    if group_by == "month":
        out = out.withColumn("month_name", month_name(F.col("month")))
    elif group_by == "day_of_week":
        out = out.withColumn("day_name", day_name(F.col("day_of_week")))
    return out


def top10_stations_by_mean(df: DataFrame, n: int = 10) -> DataFrame:
    """L2: stations by mean prediction, descending, n rows (TakeOrderedAndProject)."""
    p, st = _pred(df), resolve_column(df, *STATION)
    return (df.groupBy(st).agg(F.avg(p).alias(p))
            .orderBy(F.desc(p), F.asc(st)).limit(n))


def top_k_series(df: DataFrame, k: int = 5) -> DataFrame:
    """The rows of the k stations with the highest mean prediction.

    The station list is a limit(k): a bounded broadcast for the semi join.
    """
    st = resolve_column(df, *STATION)
    top = top10_stations_by_mean(df, k).select(F.col(st).alias("_top"))
    return df.join(F.broadcast(top), F.col(st) == F.col("_top"), "left_semi")


def history_forecast_union(history: DataFrame, forecast: DataFrame, station_id: str | None = None,
                           ts: str = "pickup_hour") -> DataFrame:
    """History (rides) and forecast (predicted) rows tagged by kind, with the
    forecast start (min forecast hour per station) as boundary."""
    st_h, st_f = resolve_column(history, *STATION), resolve_column(forecast, *STATION)
    p = _pred(forecast)
    h = history.select(F.col(st_h).alias("start_station_id"), ts,
                       F.col("rides").cast("double").alias("value"), F.lit("history").alias("kind"))
    f = forecast.select(F.col(st_f).alias("start_station_id"), ts,
                        F.col(p).cast("double").alias("value"), F.lit("forecast").alias("kind"))
    if station_id is not None:
        h = h.where(F.col("start_station_id") == station_id)
        f = f.where(F.col("start_station_id") == station_id)
    bounds = f.groupBy("start_station_id").agg(F.min(ts).alias("forecast_start"))
    return h.unionByName(f).join(bounds, "start_station_id", "inner")
