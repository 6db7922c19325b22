"""Column expressions used by forecasting."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month and weekday display names.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DEFAULT_BASE_DEMAND = 5.0


def hour_sequence(start: Column, end: Column) -> Column:
    """C14: every hour from start to end inclusive (array, explode it)."""
    return F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def clamp_non_negative(c: Column) -> Column:
    """P11."""
    return F.greatest(F.lit(0.0), c)


def pattern_fallback(ts: Column, base: float = DEFAULT_BASE_DEMAND) -> Column:
    """Base * (0.7 + 0.6 * (hour % 12)/12 * (0.7 on weekends))."""
    hour_factor = (F.hour(ts) % 12) / F.lit(12.0)
    weekend_factor = F.when(is_weekend(ts), F.lit(0.7)).otherwise(F.lit(1.0))
    return F.lit(base) * (F.lit(0.7) + F.lit(0.6) * hour_factor * weekend_factor)


def daily_shape(ts: Column, base: Column) -> Column:
    """Base * (0.5 + 0.5 sin(pi (hour - 6) / 12)) * (0.7 on weekends), >= 0."""
    hour_factor = F.lit(0.5) + F.lit(0.5) * F.sin(F.lit(math.pi) * (F.hour(ts) - 6) / 12)
    day_factor = F.when(is_weekend(ts), F.lit(0.7)).otherwise(F.lit(1.0))
    return clamp_non_negative(base * hour_factor * day_factor)


def seasonal_shape(ts: Column, base: Column, noise_key: Column | None = None) -> Column:
    """C17: C16 * (0.8 + 0.4 sin(pi (month - 2) / 6)) * optional noise in [0.9, 1.1).

    The noise is a deterministic hash of ``noise_key`` (same value on every
    re-run and after task retries), not a per-partition random stream.
    """
    hour_factor = F.lit(0.5) + F.lit(0.5) * F.sin(F.lit(math.pi) * (F.hour(ts) - 6) / 12)
    day_factor = F.when(is_weekend(ts), F.lit(0.7)).otherwise(F.lit(1.0))
    month_factor = F.lit(0.8) + F.lit(0.4) * F.sin(F.lit(math.pi) * (F.month(ts) - 2) / 6)
    pred = base * hour_factor * day_factor * month_factor
    if noise_key is not None:
        u = (F.xxhash64(noise_key) & F.lit(0xFFFFFF)).cast("double") / F.lit(float(1 << 24))
        pred = pred * (F.lit(0.9) + F.lit(0.2) * u)
    return clamp_non_negative(pred)


def month_name(month: Column) -> Column:
    """1..12 -> short month name."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), month.cast("int"))


def day_name(dow: Column) -> Column:
    """Monday=0 .. Sunday=6 -> day name."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), dow.cast("int") + 1)
