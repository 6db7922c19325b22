"""Supervised-learning preparation.

Per-station work is expressed with windows over (station ordered by hour):
the hourly series has one row per station and hour, so each window partition
is bounded by the length of the time range.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..schemas import META_COLUMNS, STATION, resolve_column
from .ordered import rank_distinct


def drop_metadata_columns(df: DataFrame, target: str | None = None) -> DataFrame:
    """Drop store bookkeeping columns (absent names are ignored) and the target."""
    return df.drop(*META_COLUMNS, *([target] if target else []))


def sliding_window_features(df: DataFrame, target: str = "rides", window_size: int = 12,
                            step_size: int = 1, hour: str = "pickup_hour") -> DataFrame:
    """Per station, the row at position j >= W (0-based, by hour) becomes one example:
    ``target`` = its value, every other feature taken from row j-1, and
    ``{target}_t-k`` = the value k rows back (k = W..1).  Rows with
    (j - W) % step != 0 are skipped; stations with <= W rows yield nothing.
    """
    st = resolve_column(df, *STATION)
    w = Window.partitionBy(st).orderBy(hour)
    feats = [c for c in df.columns if c != target and c not in META_COLUMNS]
    cols = [F.lag(c, 1).over(w).alias(c) if c != st else F.col(c) for c in feats]
    cols += [F.lag(target, k).over(w).alias(f"{target}_t-{k}") for k in range(window_size, 0, -1)]
    cols += [F.col(target).alias("target"), (F.row_number().over(w) - 1).alias("_j")]
    out = df.select(*cols)
    keep = (F.col("_j") >= window_size) & (((F.col("_j") - window_size) % step_size) == 0)
    return out.where(keep).drop("_j")


def split_time(df: DataFrame, ratio: float = 0.8, col: str = "pickup_hour") -> DataFrame:
    """One row (_split): the distinct value at index int(ratio * n) of the sorted distinct values.

    The distinct values are ranked in a distributed way (``rank_distinct``)
    and n is a one-row count; the pick is a filter, so no task holds all values.
    """
    ranked = rank_distinct(df, col)
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))  # one row: bounded broadcast
    return (ranked.crossJoin(F.broadcast(n))
            .where(F.col("_rank") == F.floor(F.col("_n") * F.lit(ratio)))
            .select(F.col(col).alias("_split")))


def time_split(df: DataFrame, ratio: float = 0.8, col: str = "pickup_hour") -> DataFrame:
    """Label rows 'train' (hour < split) or 'test' (hour >= split)."""
    s = split_time(df, ratio, col)
    return (df.crossJoin(F.broadcast(s))  # one row: bounded broadcast
            .withColumn("split", F.when(F.col(col) < F.col("_split"), F.lit("train")).otherwise(F.lit("test")))
            .drop("_split"))


def train_test(df: DataFrame, ratio: float = 0.8, col: str = "pickup_hour") -> tuple[DataFrame, DataFrame]:
    labelled = time_split(df, ratio, col)
    return (labelled.where("split = 'train'").drop("split"),
            labelled.where("split = 'test'").drop("split"))


def expand_datetime(df: DataFrame) -> DataFrame:
    """Each timestamp column c -> c_hour, c_day, c_month, c_year, c_dayofweek,
    c_timestamp (epoch seconds); c itself is dropped.  Strings left over are an error."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.col(f.name)
            out = out.withColumns({
                f"{f.name}_hour": F.hour(c), f"{f.name}_day": F.dayofmonth(c),
                f"{f.name}_month": F.month(c), f"{f.name}_year": F.year(c),
                f"{f.name}_dayofweek": F.weekday(c),
                f"{f.name}_timestamp": F.unix_seconds(c.cast("timestamp")),
            }).drop(f.name)
    return out


def category_codes(train: DataFrame, col: str) -> DataFrame:
    """C13 dictionary: (category, 0-based rank among sorted train categories).

    Ranked by ``rank_distinct`` (range partitions + per-partition offsets), so
    a column with very many categories is never ranked in one task.
    """
    return rank_distinct(train, col).select(F.col(col).alias("_cat"), F.col("_rank").cast("int").alias("_code"))


def encode_lookup(df: DataFrame, codes: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Replace ``col`` by its code; categories not in ``codes`` -> -1.

    A left join on the category; AQE broadcasts the dictionary when its
    measured size is small and keeps a shuffled join otherwise.
    """
    out_col = out_col or col
    joined = df.join(codes, F.col(col) == F.col("_cat"), "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_code"), F.lit(-1)).cast("int")).drop("_cat", "_code")


def label_encode(train: DataFrame, test: DataFrame, columns: list[str] | None = None):
    """Label-encode the string columns of train and test with train's categories."""
    if columns is None:
        columns = [f.name for f in train.schema.fields if isinstance(f.dataType, T.StringType)]
    for c in columns:
        codes = category_codes(train, c)
        train, test = encode_lookup(train, codes, c), encode_lookup(test, codes, c)
    return train, test


def assert_numeric(df: DataFrame) -> DataFrame:
    bad = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    if bad:
        raise ValueError(f"non-numeric columns remain after preprocessing: {bad}")
    return df


def preprocess_for_trees(train: DataFrame, test: DataFrame):
    """C12 + C13: numeric-only train/test frames."""
    train, test = expand_datetime(train), expand_datetime(test)
    train, test = label_encode(train, test)
    return assert_numeric(train), assert_numeric(test)


def recent_history(df: DataFrame, window_size: int, hour: str = "pickup_hour") -> DataFrame:
    """The newest ``window_size`` rows of each station with at least that many rows.

    ``_age`` = 0 for the newest row.  The rank filter stands alone, so Spark keeps the newest rows of each station
    in every task before any exchange (window group limit); the station's rows are counted among those.
    """
    st = resolve_column(df, *STATION)
    newest = (df.withColumn("_rank", F.row_number().over(Window.partitionBy(st).orderBy(F.desc(hour))))
              .where(F.col("_rank") <= window_size))
    return (newest.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(st))).where(F.col("_n") >= window_size)
            .withColumn("_age", F.col("_rank") - 1).drop("_n", "_rank"))


_LAG_COL = re.compile(r"^(?P<base>.+)_t-(?P<k>\d+)$")


def series_with_lags(examples: DataFrame, station_id: str, target: str = "target",
                     hour: str = "pickup_hour") -> DataFrame:
    """One station's series (time, actual) plus ``lag_{k}h`` from ``*_t-k``, largest lag first."""
    st = resolve_column(examples, *STATION)
    lags = sorted(((int(m.group("k")), c) for c in examples.columns if (m := _LAG_COL.match(c))),
                  reverse=True)
    return (examples.where(F.col(st) == F.lit(station_id))
            .select(F.col(hour).alias("time"), F.col(target).alias("actual"),
                    *[F.col(f"`{c}`").alias(f"lag_{k}h") for k, c in lags])
            .orderBy("time"))
