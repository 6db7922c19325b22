"""Univariate F-test feature scores against the target, top-k selection.

F = r^2 / (1 - r^2) * (n - 2) with r the Pearson correlation of a feature with
the target.  Every task reduces its Arrow batches to one block of co-moments (counts, means, centred
second moments, extremes: a row per feature, merged batch by batch by the parallel formula), and one small
grouped sum merges the blocks, again about the overall means, so nothing cancels.  The rows themselves are not shuffled,
and the plan does not grow with the features.  A constant feature scores 0 and a
perfectly correlated one the largest double.  Ranking: F descending, ties to
the later column (the order a stable ascending argsort tail gives).

Rows in which the feature or the target is null or NaN do not count for that feature.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle as _cp
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

_cp.register_pickle_by_value(sys.modules[__name__])

MAX_DOUBLE = 1.7976931348623157e308
NON_FEATURES = ("pickup_hour", "start_station_id", "rides")
BLOCK = ("n", "mean_x", "mean_y", "sxx", "sxy", "syy", "min_x", "max_x", "min_y", "max_y")


def _block(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Co-moments [features, len(BLOCK)] of columns x [features, rows] with y [rows]."""
    known = ~(np.isnan(x) | np.isnan(y))
    n = known.sum(axis=1)
    some = np.maximum(n, 1)
    ys = np.broadcast_to(y, x.shape)
    x0, y0 = np.where(known, x, 0.0), np.where(known, ys, 0.0)
    mx, my = x0.sum(axis=1) / some, y0.sum(axis=1) / some
    dx, dy = np.where(known, x - mx[:, None], 0.0), np.where(known, ys - my[:, None], 0.0)
    return np.column_stack([
        n, mx, my, (dx * dx).sum(axis=1), (dx * dy).sum(axis=1), (dy * dy).sum(axis=1),
        np.where(known, x, np.inf).min(axis=1), np.where(known, x, -np.inf).max(axis=1),
        np.where(known, ys, np.inf).min(axis=1), np.where(known, ys, -np.inf).max(axis=1)])


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two blocks as one: the moments of each are moved to the common means."""
    n = a[:, 0] + b[:, 0]
    some = np.maximum(n, 1)
    dx, dy, share = b[:, 1] - a[:, 1], b[:, 2] - a[:, 2], a[:, 0] * b[:, 0] / some
    return np.column_stack([
        n, a[:, 1] + dx * b[:, 0] / some, a[:, 2] + dy * b[:, 0] / some,
        a[:, 3] + b[:, 3] + dx * dx * share, a[:, 4] + b[:, 4] + dx * dy * share, a[:, 5] + b[:, 5] + dy * dy * share,
        np.minimum(a[:, 6], b[:, 6]), np.maximum(a[:, 7], b[:, 7]), np.minimum(a[:, 8], b[:, 8]), np.maximum(a[:, 9], b[:, 9])])


def co_moments(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """(idx, BLOCK...) for every task and feature."""
    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                y, *x = (b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(b.num_columns))
                own = _block(np.vstack(x), y)
                total = own if total is None else _merge(total, own)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *map(pa.array, total.T.copy())],
                                             names=["idx", *BLOCK])

    columns = df.select(F.col(target).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(names)])
    return columns.mapInArrow(reduce_task, "idx int, " + ", ".join(f"{c} double" for c in BLOCK))


def f_regression_scores(features: DataFrame, target: str = "rides",
                        exclude=NON_FEATURES, k: int = 10) -> DataFrame:
    """(feature, idx, f_score, rank, selected) -- one row per feature column."""
    names = [c for c in features.columns if c not in exclude]
    blocks = materialize(co_moments(features, names, target).where("n > 0"), "co-moments")
    means = blocks.groupBy("idx").agg(F.sum("n").alias("_n"), (F.sum(F.expr("n * mean_x")) / F.sum("n")).alias("_mx"),
                                      (F.sum(F.expr("n * mean_y")) / F.sum("n")).alias("_my"))
    moved = blocks.join(F.broadcast(means), "idx")      # a row per feature
    long = moved.groupBy("idx").agg(
        F.first("_n").alias("n"),
        F.sum(F.expr("sxx + n * (mean_x - _mx) * (mean_x - _mx)")).alias("sxx"),
        F.sum(F.expr("sxy + n * (mean_x - _mx) * (mean_y - _my)")).alias("sxy"),
        F.sum(F.expr("syy + n * (mean_y - _my) * (mean_y - _my)")).alias("syy"),
        (F.min("min_x") == F.max("max_x")).alias("const"), (F.min("min_y") == F.max("max_y")).alias("level"))
    listed = features.sparkSession.createDataFrame(list(enumerate(names)), "idx int, feature string")
    r2 = F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy"))
    # constant columns are detected exactly (min = max): merged moments of a constant are not always exactly 0
    f = (F.when(F.col("n").isNull() | (F.col("n") < 2) | F.col("const") | F.col("level"), F.lit(0.0))
         .when(r2 >= 1.0, F.lit(MAX_DOUBLE))
         .otherwise(r2 / (F.lit(1.0) - r2) * (F.col("n") - 2)))
    scored = listed.join(long, "idx", "left").select("feature", "idx", f.alias("f_score"))
    # len(names) rows: the unpartitioned rank window is over a bounded input
    rank = F.row_number().over(Window.orderBy(F.desc("f_score"), F.desc("idx")))
    return (scored.withColumn("rank", rank.cast("int"))
            .withColumn("selected", (F.col("rank") <= k).cast("int")))


def selected_features(scores: DataFrame) -> list[str]:
    """Names of the selected features, in original column order (bounded collect)."""
    rows = scores.where("selected = 1").select("feature", "idx").collect()
    return [r.feature for r in sorted(rows, key=lambda r: r.idx)]
