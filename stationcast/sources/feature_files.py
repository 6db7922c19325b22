"""Readers for feature sets and forecasts written by the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_runtime

FEATURE_SET_NAMES = ("baseline_features", "full_features", "reduced_features")
FORECAST_DDL = "start_station_id STRING, pickup_hour STRING, predicted_rides DOUBLE"


def _kind(path: str) -> str:
    p = path.rstrip("/").lower()
    for ext in ("csv", "parquet"):
        if p.endswith("." + ext) or f".{ext}/" in p + "/":
            return ext
    raise ValueError(f"unsupported file type: {path}")


def coerce_time_columns(df: DataFrame) -> DataFrame:
    """Parse ``pickup_hour``, ``event_time`` and every text column named like ``*time*``."""
    out = df
    for f in df.schema.fields:
        name = f.name.lower()
        if (name in ("pickup_hour", "event_time") or "time" in name) and isinstance(f.dataType, T.StringType):
            out = out.withColumn(f.name, F.try_to_timestamp(F.col(f.name)).cast("timestamp_ntz"))
        elif isinstance(f.dataType, T.TimestampType):
            out = out.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return out


def scan_features(spark: SparkSession, path: str, fmt: str | None = None,
                  schema: T.StructType | str | None = None) -> DataFrame:
    """One feature set from CSV or Parquet (by suffix), ``pickup_hour`` parsed.

    Parquet carries its schema.  CSV takes ``schema`` when given; without it
    the types are inferred, which costs one extra pass over the files.
    """
    ensure_runtime(spark)
    fmt = fmt or _kind(path)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file type: {fmt}")
    df = coerce_time_columns(df)
    if "start_station_id" in df.columns:
        df = df.withColumn("start_station_id", F.col("start_station_id").cast("string"))
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def scan_feature_sets(spark: SparkSession, candidates: dict[str, list[tuple[str, str]]]) -> dict[str, DataFrame]:
    """Each set from the first existing candidate (path, format); all three required."""
    out = {}
    for name in FEATURE_SET_NAMES:
        for path, fmt in candidates.get(name, []):
            if path_exists(spark, path):
                out[name] = scan_features(spark, path, fmt)
                break
    missing = [n for n in FEATURE_SET_NAMES if n not in out]
    if missing:
        raise ValueError(f"required feature sets not found: {missing}")
    return out


def scan_forecast(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The latest forecast, hour parsed, ``predicted_rides`` -> ``predicted_demand``."""
    df = scan_features(spark, path, fmt, FORECAST_DDL if fmt == "csv" else None)
    if "predicted_rides" in df.columns:
        df = df.withColumnRenamed("predicted_rides", "predicted_demand")
    return df
