"""DuckDB SQL building blocks for the oracle side of the query registry.

Each helper returns SQL text runnable by DuckDB over the pre-registered table
views.  They state the same semantics as the Spark operators independently
(windows over frames, plain joins), so a match is a real cross-check.
"""

from __future__ import annotations

from ..functions.calendar import TIME_FEATURES
from ..operators.features import LAG_HOURS, ROLL_WINDOWS
from ..sources.tables import trips_view_sql


def r6(expr: str) -> str:
    """Round a double to 6 places (binary value, half away from zero).

    The Spark side (``registry.round_doubles``) applies the same rule to the
    same IEEE product, so equal inputs always round alike.
    """
    return f"round(CAST({expr} AS DOUBLE), 6)"


def trips_cte(entity: str = "type") -> str:
    """``trips`` CTE; entity 'user' makes the user id the station."""
    base = trips_view_sql()
    if entity == "user":
        return (f"trips_raw AS ({base}),\n"
                "trips AS (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS start_station_id) FROM trips_raw)")
    return f"trips AS ({base})"


HOURLY_CTE = """hourly AS (
  SELECT date_trunc('hour', started_at) AS pickup_hour, start_station_id, count(*) AS rides
  FROM {src} GROUP BY ALL)"""

DENSE_CTE = """bounds AS (SELECT min(pickup_hour) AS lo, max(pickup_hour) AS hi FROM hourly),
grid AS (
  SELECT unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS pickup_hour, s.start_station_id
  FROM (SELECT DISTINCT start_station_id FROM hourly) s, bounds b),
dense AS (
  SELECT g.pickup_hour, g.start_station_id, coalesce(h.rides, 0) AS rides
  FROM grid g LEFT JOIN hourly h USING (pickup_hour, start_station_id))"""


def series_ctes(entity: str = "type", src_filter: str = "") -> str:
    """trips -> hourly -> dense CTE chain (no WITH keyword)."""
    src = "trips" if not src_filter else f"(SELECT * FROM trips WHERE {src_filter})"
    return ",\n".join([trips_cte(entity), HOURLY_CTE.format(src=src), DENSE_CTE])


def time_feature_exprs(ts: str = "pickup_hour", mode: str = "train") -> list[str]:
    dow = f"(isodow({ts}) - 1)"
    hr = f"hour({ts})"
    weekend = f"({dow} IN (5, 6))"
    if mode == "train":
        morning = f"({hr} BETWEEN 7 AND 9 AND NOT {weekend})"
        evening = f"({hr} BETWEEN 17 AND 19 AND NOT {weekend})"
    else:
        morning = f"({hr} BETWEEN 7 AND 9)"
        evening = f"({hr} BETWEEN 16 AND 19)"
    return [
        f"CAST({hr} AS INTEGER) AS hour",
        f"CAST({dow} AS INTEGER) AS day_of_week",
        f"CAST(day({ts}) AS INTEGER) AS day_of_month",
        f"CAST(week({ts}) AS INTEGER) AS week_of_year",
        f"CAST(month({ts}) AS INTEGER) AS month",
        f"CAST(year({ts}) AS INTEGER) AS year",
        f"CAST({weekend} AS INTEGER) AS is_weekend",
        f"CAST({morning} AS INTEGER) AS is_morning_rush",
        f"CAST({evening} AS INTEGER) AS is_evening_rush",
        f"sin(2 * pi() * {hr} / 24) AS hour_sin",
        f"cos(2 * pi() * {hr} / 24) AS hour_cos",
        f"sin(2 * pi() * {dow} / 7) AS day_sin",
        f"cos(2 * pi() * {dow} / 7) AS day_cos",
        f"sin(2 * pi() * month({ts}) / 12) AS month_sin",
        f"cos(2 * pi() * month({ts}) / 12) AS month_cos",
    ]


def lag_exprs(window_size: int = 672) -> list[str]:
    w = "(PARTITION BY start_station_id ORDER BY pickup_hour)"
    return [f"coalesce(CAST(lag(rides, {k}) OVER {w} AS DOUBLE), 0) AS rides_lag_{k}h"
            for k in LAG_HOURS if k <= window_size]


def rolling_exprs(window_size: int = 672, exclude_current: bool = False) -> list[str]:
    out = []
    for win in ROLL_WINDOWS:
        if win > window_size:
            continue
        frame = (f"ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING" if exclude_current
                 else f"ROWS BETWEEN {win - 1} PRECEDING AND CURRENT ROW")
        w = f"(PARTITION BY start_station_id ORDER BY pickup_hour {frame})"
        out += [f"coalesce(avg(rides) OVER {w}, 0) AS rolling_mean_{win}h",
                f"coalesce(CAST(max(rides) OVER {w} AS DOUBLE), 0) AS rolling_max_{win}h",
                f"coalesce(stddev_samp(rides) OVER {w}, 0) AS rolling_std_{win}h"]
    return out


def features_cte(window_size: int = 672, name: str = "features", src: str = "dense") -> str:
    cols = (["pickup_hour", "start_station_id", "rides"] + time_feature_exprs()
            + lag_exprs(window_size) + rolling_exprs(window_size))
    return f"{name} AS (SELECT {', '.join(cols)} FROM {src})"


def rounded_select(columns: list[str], double_columns: set[str], src: str) -> str:
    sel = [r6(c) + f" AS {c}" if c in double_columns else c for c in columns]
    return f"SELECT {', '.join(sel)} FROM {src}"


DOUBLE_TIME_FEATURES = set(TIME_FEATURES[9:])
