"""The feature pipeline (M12): trips of a month range -> three feature sets -> files and offline store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feat
from ..operators import series
from ..operators.clean import assert_not_empty, clean_trip_range
from ..operators.selection import f_regression_scores, selected_features
from ..operators.store import append_offline
from ..session import materialize
from ..sinks.writers import write_feature_sets
from ..sources.feature_files import scan_feature_sets
from ..sources.tables import trips_view

MONTHS = ((2024, 1), (2024, 3))   # default range, both ends included
NOW = dt.datetime(2024, 4, 1, 0, 0, 0)
CLEANED_BY = ("started_at", "ended_at", "start_station_id", "end_station_id")     # the trip columns that cleaning reads


def process_for_modeling(trips: DataFrame, top_n: int = 3,
                         window_size: int = feat.DEFAULT_WINDOW_SIZE,
                         num_partitions: int | None = None) -> dict[str, DataFrame]:
    """M12 core: top-N stations -> semi join -> dense series -> features -> 3 sets.

    The full set feeds three outputs and the selection aggregate, so it is written
    once to the shared folder and read from there; nothing stays persisted.
    """
    top = series.top_stations(trips, top_n)
    ts = series.transform_to_series(series.filter_top_stations(trips, top), num_partitions)
    full = materialize(feat.full_features(ts, window_size), "full-features")
    scores = materialize(f_regression_scores(full), "scores")
    return {
        "baseline_features": feat.project_baseline(full),
        "full_features": full,
        "reduced_features": feat.project_reduced(full, selected_features(scores)),
        "selection_scores": scores,
    }


def feature_sets(spark: SparkSession, sf_dir: str, top_n: int = 3,
                 window_size: int = feat.DEFAULT_WINDOW_SIZE,
                 start: tuple[int, int] = MONTHS[0], end: tuple[int, int] = MONTHS[1]) -> dict[str, DataFrame]:
    """The sets over the trip view's months start..end; no valid trip in them is an error."""
    trips = clean_trip_range(trips_view(spark, sf_dir, ends=True, columns=CLEANED_BY), start, end)
    trips = materialize(trips.select("started_at", "start_station_id"), "clean-trips")     # all that the series reads
    assert_not_empty(trips, f"{start} to {end}")
    return process_for_modeling(trips, top_n, window_size)


def run_features(spark: SparkSession, sf_dir: str, root: str, top_n: int = 3,
                 start: tuple[int, int] = MONTHS[0], end: tuple[int, int] = MONTHS[1],
                 now: dt.datetime = NOW) -> dict:
    """M12 end to end: the sets are written as files (K1), read back (S5), and the full set is
    appended to the offline store (T5).  Returns paths and the sets as read from the files."""
    sets = feature_sets(spark, sf_dir, top_n, start=start, end=end)
    scores = sets.pop("selection_scores")
    write_feature_sets(sets, f"{root}/sets", now.strftime("%Y%m%d_%H%M%S"))
    append_offline(sets["full_features"], f"{root}/offline", "start_station_id", "pickup_hour", now)
    read = scan_feature_sets(spark, {n: [(f"{root}/sets/{n}/latest", "parquet")] for n in sets})
    return {"sets": read, "scores": scores, "root": root, "offline": f"{root}/offline"}
