"""Hourly demand series: counting, top stations and the dense hour grid.

A1 hourly_demand, A2 top_stations, A3 top_stations_named, J1 dense_grid,
J3 filter_top_stations, L1 sort_series, A15 distinct_stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import STARTED_AT, STATION, resolve_column


def floor_hour(c):
    """Floor a timestamp to the hour, result ``timestamp_ntz`` (session is UTC)."""
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def hourly_demand(trips: DataFrame) -> DataFrame:
    """A1: rides per (pickup_hour, start_station_id).

    A plain grouped count: Spark runs a partial count in every scan task before
    the shuffle, so only (hour, station, partial count) rows cross the network
    and a station holding a third of all trips costs no more than any other.
    """
    ts = resolve_column(trips, *STARTED_AT)
    st = resolve_column(trips, *STATION)
    return (trips
            .groupBy(floor_hour(F.col(ts)).alias("pickup_hour"),
                     F.col(st).alias("start_station_id"))
            .agg(F.count(F.lit(1)).alias("rides")))


def series_partitions(spark) -> int:
    """Partition count for dense series: the session's shuffle partition setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dense_grid(hourly: DataFrame, hour_col: str = "pickup_hour",
               station_col: str = "start_station_id", rides_col: str = "rides",
               num_partitions: int | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """Every hour from the global min to max for every station, 0 when absent.

    Gap filling, no grid join: the sparse counts are hash-partitioned by
    station into an explicit number of partitions (a user-specified count,
    which AQE does not coalesce -- the dense output is far larger than the
    sparse input it would size by).  Within a station, ordered by hour, each
    count row expands to the hours up to the next row's hour; the station's
    first row also covers the hours from the global minimum, the last one the
    hours to the global maximum.  A station partition holds at most one row
    per hour, so a station with a third of all trips is no larger than any
    other.  The global range is one aggregate row (bounded broadcast);
    ``bounds`` (``_lo``, ``_hi``) passes it in, else it is taken from
    ``hourly``.  Nothing is persisted, so every run sees the input as it is.
    The output stays partitioned by station, which the feature windows
    downstream reuse without another exchange.
    """
    n = num_partitions or series_partitions(hourly.sparkSession)
    counts = hourly.select(hour_col, station_col, rides_col).repartition(n, station_col)
    if bounds is None:
        bounds = hourly.agg(F.min(hour_col).alias("_lo"), F.max(hour_col).alias("_hi"))
    w = Window.partitionBy(station_col).orderBy(hour_col)
    step = F.expr("INTERVAL 1 HOUR")
    spans = counts.crossJoin(F.broadcast(bounds)).select(
        station_col, F.col(hour_col).alias("_h"), F.col(rides_col).alias("_r"),
        F.when(F.row_number().over(w) == 1, F.col("_lo")).otherwise(F.col(hour_col)).alias("_from"),
        F.coalesce(F.lead(hour_col).over(w) - step, F.col("_hi")).alias("_to"))
    filled = spans.select(station_col, "_h", "_r",
                          F.explode(F.sequence("_from", "_to", step)).alias(hour_col))
    rides = F.when(F.col(hour_col) == F.col("_h"), F.coalesce(F.col("_r"), F.lit(0))).otherwise(F.lit(0))
    return filled.select(hour_col, station_col, rides.cast("bigint").alias(rides_col))


def hour_bounds(trips: DataFrame) -> DataFrame:
    """One row (_lo, _hi): first and last hour, from the start time column alone."""
    hour = floor_hour(F.col(resolve_column(trips, *STARTED_AT)))
    return trips.agg(F.min(hour).alias("_lo"), F.max(hour).alias("_hi"))


def transform_to_series(trips: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A1 + J1: the dense hourly demand series of the given trips.

    The hour range is a second, one-column scan of the trips (min and max come
    from partial aggregates), which costs less than keeping the counts for two uses.
    """
    return dense_grid(hourly_demand(trips), num_partitions=num_partitions, bounds=hour_bounds(trips))


def station_counts(trips: DataFrame) -> DataFrame:
    st = resolve_column(trips, *STATION)
    return trips.groupBy(F.col(st).alias("start_station_id")).agg(F.count(F.lit(1)).alias("trips"))


def top_stations(trips: DataFrame, n: int = 3) -> DataFrame:
    """A2: the n stations with most trips; ties broken by station id.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task keeps
    its own top n, so the result is bounded by n before it reaches one task.
    """
    return (station_counts(trips)
            .orderBy(F.desc("trips"), F.asc("start_station_id"))
            .limit(n))


def top_stations_named(trips: DataFrame, n: int = 3, name_col: str = "start_station_name") -> DataFrame:
    """A3: rank, representative station name (earliest trip), id and trips."""
    st = resolve_column(trips, *STATION)
    ts = resolve_column(trips, *STARTED_AT)
    agg = (trips.groupBy(F.col(st).alias("start_station_id"))
           .agg(F.count(F.lit(1)).alias("trips"),
                F.min_by(F.col(name_col), F.struct(F.col(ts), F.col("ride_id"))).alias("station_name")))
    top = agg.orderBy(F.desc("trips"), F.asc("start_station_id")).limit(n)
    # n rows only: the unpartitioned window runs on the already-limited top n.
    rank = F.row_number().over(Window.orderBy(F.desc("trips"), F.asc("start_station_id")))
    return (top.withColumn("rank", rank.cast("int"))
            .select("rank", "station_name", "start_station_id", "trips"))


def filter_top_stations(trips: DataFrame, top: DataFrame) -> DataFrame:
    """Keep trips of the listed stations.

    ``top`` comes from a ``limit(n)``, so its size is bounded by n and the
    broadcast semi join never shuffles the trips.
    """
    st = resolve_column(trips, *STATION)
    keys = F.broadcast(top.select(F.col("start_station_id").alias("_top_id")))
    return trips.join(keys, F.col(st) == F.col("_top_id"), "left_semi")


def sort_series(df: DataFrame) -> DataFrame:
    """L1: order by station, hour (a global range-partitioned sort)."""
    return df.orderBy("start_station_id", "pickup_hour")


def distinct_stations(df: DataFrame) -> DataFrame:
    """Unique station ids, sorted."""
    st = resolve_column(df, *STATION)
    return df.select(F.col(st).alias("start_station_id")).distinct().orderBy("start_station_id")
