"""Sinks (K1-K6).  Every write is one distributed job; no per-partition loops.

Writes go to fresh paths (a run stamp, or ``scratch_path``) and never
overwrite a path the same plan is reading.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _format_of(path: str, default: str = "csv") -> str:
    p = path.rstrip("/").lower()
    if p.endswith(".parquet"):
        return "parquet"
    if p.endswith(".csv"):
        return "csv"
    if "." in p.rsplit("/", 1)[-1]:
        raise ValueError(f"unsupported file type: {path}")
    return default


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> str:
    fmt = fmt or _format_of(path)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def run_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_feature_sets(sets: dict[str, DataFrame], root: str, stamp: str | None = None) -> dict[str, str]:
    """K1: each set as Parquet twice: ``<root>/<name>/latest`` and ``.../run=<stamp>``.

    Each set is evaluated once: the second copy is written from the first one's files.
    """
    stamp = stamp or run_stamp()
    out = {}
    for name, df in sets.items():
        out[name] = write_table(df, f"{root}/{name}/run={stamp}", "parquet")
        write_table(df.sparkSession.read.schema(df.schema).parquet(out[name]), f"{root}/{name}/latest", "parquet")
    return out


def write_forecast(df: DataFrame, path: str, stamp: str | None = None) -> str:
    """K2: CSV or Parquet by suffix (CSV by default); ``latest`` plus a stamped copy."""
    fmt = _format_of(path)
    stamp = stamp or run_stamp()
    # the forecast is evaluated once (it may be a recursion); the second copy reads the first one's files
    stamped = write_table(df, f"{path.rstrip('/')}/run={stamp}", fmt)
    reader = df.sparkSession.read.schema(df.schema)
    again = reader.parquet(stamped) if fmt == "parquet" else reader.option("header", True).csv(stamped)
    write_table(again, f"{path.rstrip('/')}/latest", fmt)
    return stamped


def export_partitions(df: DataFrame, target: str, partition_cols=("year", "month")) -> str:
    """K3: one CSV dataset partitioned by (year, month) -- one job for all partitions.

    Tables without the partition columns become one un-partitioned CSV dataset.
    """
    cols = tuple(c for c in partition_cols if c in df.columns)
    return write_table(df, target, "csv", partition_by=cols if len(cols) == len(partition_cols) else ())


def metrics_table(frames: list[DataFrame]) -> DataFrame:
    """Union of per-model metric rows; columns missing in a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_metrics(frames: list[DataFrame], path: str) -> str:
    """K4: metrics as CSV.  One row per model: a single output file is fine."""
    return write_table(metrics_table(frames).coalesce(1), path, "csv")


def append_metrics_history(df: DataFrame, path: str, run_ts: dt.datetime, run_id: str) -> str:
    """K5: append this run's rows to the history (created on first append)."""
    rows = df.select("model_name", "mae",
                     F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).alias("run_timestamp"),
                     F.lit(run_id).alias("run_id"))
    return write_table(rows.coalesce(1), path, "csv", mode="append")


def export_filtered_forecast(df: DataFrame, path: str) -> str:
    """K6: the filtered forecast as CSV."""
    return write_table(df, path, "csv")
