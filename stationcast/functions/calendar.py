"""Calendar, rush-hour and cyclic columns (C1-C3), all native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALENDAR_COLUMNS = ("hour", "day_of_week", "day_of_month", "week_of_year", "month", "year")
FLAG_COLUMNS = ("is_weekend", "is_morning_rush", "is_evening_rush")
CYCLIC_COLUMNS = ("hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos")
TIME_FEATURES = CALENDAR_COLUMNS + FLAG_COLUMNS + CYCLIC_COLUMNS

# Fixed values (rush windows, inclusive hours).  "train" is the definition the
# feature tables use; "serve" is the one applied while forecasting.
RUSH_HOURS = {
    "train": {"morning": (7, 9), "evening": (17, 19), "weekdays_only": True},
    "serve": {"morning": (7, 9), "evening": (16, 19), "weekdays_only": False},
}


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Hour, day_of_week (Monday=0), day_of_month, ISO week, month, year."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "week_of_year": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }


def rush_columns(hour: Column, dow: Column, mode: str = "train") -> dict[str, Column]:
    """Weekend flag and rush-hour flags as 0/1 ints."""
    spec = RUSH_HOURS[mode]
    weekend = dow.isin(5, 6)
    weekday_ok = ~weekend if spec["weekdays_only"] else F.lit(True)
    (m0, m1), (e0, e1) = spec["morning"], spec["evening"]
    return {
        "is_weekend": weekend.cast("int"),
        "is_morning_rush": (hour.between(m0, m1) & weekday_ok).cast("int"),
        "is_evening_rush": (hour.between(e0, e1) & weekday_ok).cast("int"),
    }


def cyclic_columns(hour: Column, dow: Column, month: Column) -> dict[str, Column]:
    """sin/cos encodings of hour (24), weekday (7) and month (12)."""
    two_pi = 2 * math.pi
    return {
        "hour_sin": F.sin(two_pi * hour / 24), "hour_cos": F.cos(two_pi * hour / 24),
        "day_sin": F.sin(two_pi * dow / 7), "day_cos": F.cos(two_pi * dow / 7),
        "month_sin": F.sin(two_pi * month / 12), "month_cos": F.cos(two_pi * month / 12),
    }


def time_features(df: DataFrame, ts_col: str = "pickup_hour", mode: str = "train") -> DataFrame:
    """C1 + C2 + C3 on ``ts_col``: 15 columns in a single projection."""
    cal = calendar_columns(F.col(ts_col))
    out = df.withColumns(cal)
    flags = rush_columns(F.col("hour"), F.col("day_of_week"), mode)
    cyc = cyclic_columns(F.col("hour"), F.col("day_of_week"), F.col("month"))
    return out.withColumns(flags).withColumns(cyc)
