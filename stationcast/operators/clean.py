"""Trip cleaning: lenient time parsing, validity filter and its counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Second accepted text format for trip times (month-first, minutes precision).
ALT_TIME_FORMAT = "MM-dd-yyyy HH:mm"


def lenient_timestamp(c: Column) -> Column:
    """ISO-ish text, else ``MM-dd-yyyy HH:mm``; anything else -> null."""
    return F.coalesce(
        F.try_to_timestamp(c),
        F.try_to_timestamp(c, F.lit(ALT_TIME_FORMAT)),
    ).cast("timestamp_ntz")


def parse_trip_times(df: DataFrame, cols=("started_at", "ended_at")) -> DataFrame:
    """Parse the trip time columns and drop rows where either is null."""
    out = df
    for c in cols:
        dtype = out.schema[c].dataType
        if isinstance(dtype, T.StringType):
            out = out.withColumn(c, lenient_timestamp(F.col(c)))
        elif isinstance(dtype, T.TimestampType):
            out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return out.where(cond)


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    if not isinstance(year, int) or not isinstance(month, int):
        raise ValueError("year and month must be integers")
    if not 1 <= month <= 12:
        raise ValueError("month must be between 1 and 12")
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + month // 12, month % 12 + 1, 1)
    return start, end


def ntz_literal(ts: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'")


def valid_trip(year: int, month: int) -> Column:
    """Duration in (0, 24 h], start inside the month, both stations known."""
    return valid_between(*month_bounds(year, month))


def valid_between(start: dt.datetime, end: dt.datetime) -> Column:
    """Duration in (0, 24 h], start in [start, end), both stations known."""
    s, e = F.col("started_at"), F.col("ended_at")
    return ((e > s) & (e <= s + F.expr("INTERVAL 24 HOURS"))
            & (s >= ntz_literal(start)) & (s < ntz_literal(end))
            & F.col("start_station_id").isNotNull()
            & F.col("end_station_id").isNotNull())


def clean_trip_range(df: DataFrame, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """P1 + P2 over the months start..end, both included: one filter, as for one month."""
    lo, hi = month_bounds(*start)[0], month_bounds(*end)[1]
    return parse_trip_times(df).where(valid_between(lo, hi))


def clean_trips(df: DataFrame, year: int, month: int) -> DataFrame:
    """P1 + P2: parsed, valid trips of one month (one pushed-down filter)."""
    return parse_trip_times(df).where(valid_trip(year, month))


def clean_stats(df: DataFrame, year: int, month: int) -> DataFrame:
    """Total / valid / dropped / percent dropped, after the date parse."""
    parsed = parse_trip_times(df)
    ok = valid_trip(year, month)
    return parsed.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(ok).alias("valid_records"),
    ).select(
        "total_records", "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("records_dropped"),
        F.round(F.try_divide((F.col("total_records") - F.col("valid_records")) * 100.0,
                             F.col("total_records")), 6).alias("percent_dropped"),
    )


def assert_not_empty(df: DataFrame, what: str) -> DataFrame:
    """Guard used by pipelines: fail when ``df`` has no rows (one-row probe)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no valid rows found for {what}")
    return df
