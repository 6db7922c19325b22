"""Trip-level feature operators: one-hot (C8), station popularity (J4, C9),
round trips (C10) and the raw-trip feature composition (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import trip as TF
from ..functions.calendar import time_features
from ..session import materialize
from .quantiles import weighted_quantiles

# Popularity quartile labels.
POPULARITY_LABELS = ("low", "medium", "high", "very_high")
MOST_VALUES = 10_000      # columns that a one-hot encoding may add


def one_hot(df: DataFrame, col: str, prefix: str,
            values: list[str] | None = None) -> DataFrame:
    """One 0/1 column ``{prefix}_{value}`` per distinct value (sorted); null -> all 0.

    Without ``values`` the columns are the distinct values: the result's schema needs them, so they (and
    only they, ``MOST_VALUES`` at most) come to the driver.  ``one_hot_long`` gives the same content as rows, for
    columns with more values.
    """
    if values is None:
        values = distinct_values(df, [col])[col]
    hot = [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in values]
    return df.select("*", *hot)


def distinct_values(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values of several text columns, in one pass over the rows; more than
    ``MOST_VALUES`` are an error, as they cannot become columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    rows = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null").distinct().limit(MOST_VALUES + 1).collect()
    if len(rows) > MOST_VALUES:
        raise ValueError(f"more than {MOST_VALUES} distinct values in {cols}: use one_hot_long")
    return {c: sorted(r["v"] for r in rows if r["c"] == c) for c in cols}


def one_hot_long(df: DataFrame, key: str, col: str) -> DataFrame:
    """C8 as rows (key, value, 1): no list of values anywhere; null gives no row."""
    return df.where(F.col(col).isNotNull()).select(key, F.col(col).alias("value"), F.lit(1).alias("hot"))


def attach_popularity(trips: DataFrame, station: str = "start_station_id") -> DataFrame:
    """Trips of the station, attached to each trip.

    Counted with a grouped (partially aggregated) count and joined back on the
    station.  The per-station table has one row per station; AQE turns the
    join into a broadcast when its measured size is small and splits a hot
    station's partition otherwise -- no window over raw rows per station.
    """
    return trips.join(station_popularity(trips, station), station, "left")


def station_popularity(trips: DataFrame, station: str = "start_station_id") -> DataFrame:
    return trips.groupBy(station).agg(F.count(F.lit(1)).alias("station_popularity"))


def popularity_edges(trips: DataFrame, station: str = "start_station_id") -> DataFrame:
    """Quartile edges of the row-level popularity (each trip carries its station count).

    Computed from the per-station table with the count as frequency, which is
    the same distribution without touching the trips a second time.
    """
    return edges_of_counts(materialize(station_popularity(trips, station), "popularity"))


def edges_of_counts(counts: DataFrame) -> DataFrame:
    """One row of edges from a stored table of counts, by distributed selection (``weighted_quantiles``)."""
    found = weighted_quantiles(counts, "station_popularity", "station_popularity", [0.25, 0.5, 0.75])
    least, quartiles, largest = found or (None, [None] * 3, None)
    return counts.sparkSession.createDataFrame(
        [(least, *quartiles, largest)], "_e0 long, _e1 double, _e2 double, _e3 double, _e4 long")


def popularity_bucket(trips_with_pop: DataFrame, edges: DataFrame) -> DataFrame:
    """Quartile label, right-closed bins, first bin closed on both sides.

    ``edges`` is one row (a global aggregate), so the cross join is a bounded
    broadcast.  Repeated edges make the bins ill defined and raise.
    """
    x = F.col("station_popularity")
    e = [F.col(f"_e{i}") for i in range(5)]
    dup = (e[0] == e[1]) | (e[1] == e[2]) | (e[2] == e[3]) | (e[3] == e[4])
    label = (F.when(dup, F.raise_error(F.lit("popularity bin edges must be unique")))
             .when(x <= e[1], F.lit(POPULARITY_LABELS[0]))
             .when(x <= e[2], F.lit(POPULARITY_LABELS[1]))
             .when(x <= e[3], F.lit(POPULARITY_LABELS[2]))
             .when(x <= e[4], F.lit(POPULARITY_LABELS[3])))
    return (trips_with_pop.crossJoin(F.broadcast(edges))
            .withColumn("station_popularity_category", label)
            .drop(*[f"_e{i}" for i in range(5)]))


def station_features(trips: DataFrame) -> DataFrame:
    """J4 + C9 + C10.  The per-station counts are computed once and written to the shared folder."""
    counts = materialize(station_popularity(trips), "popularity")
    with_pop = trips.join(counts, "start_station_id", "left")
    out = popularity_bucket(with_pop, edges_of_counts(counts))
    return out.withColumn("round_trip", TF.round_trip(F.col("start_station_id"), F.col("end_station_id")))


def geo_features(trips: DataFrame) -> DataFrame:
    """C4 + C5."""
    d = TF.haversine_km(F.col("start_lat"), F.col("start_lng"), F.col("end_lat"), F.col("end_lng"))
    return trips.withColumn("distance_km", d).withColumn(
        "trip_length", TF.trip_length_bucket(F.col("distance_km")))


def trip_features(trips: DataFrame, bike_values=None, user_values=None) -> DataFrame:
    """C6 + C7 + C8."""
    out = trips.withColumn("duration_minutes",
                           TF.trip_duration_minutes(F.col("started_at"), F.col("ended_at")))
    out = out.withColumn("duration_category", TF.duration_bucket(F.col("duration_minutes")))
    if bike_values is None or user_values is None:
        found = distinct_values(trips, ["rideable_type", "member_casual"])
        bike_values = found["rideable_type"] if bike_values is None else bike_values
        user_values = found["member_casual"] if user_values is None else user_values
    out = one_hot(out, "rideable_type", "bike", bike_values)
    return one_hot(out, "member_casual", "user", user_values)


def raw_trip_features(trips: DataFrame) -> DataFrame:
    """C11: time (on started_at), station, trip and geographic features."""
    out = time_features(trips, "started_at")
    out = station_features(out)
    out = trip_features(out)
    return geo_features(out)
