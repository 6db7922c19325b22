"""Registered queries: hourly series and time-series features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import TIME_FEATURES, time_features
from ..operators import features as feat
from ..operators import series, sparse
from ..sources.tables import trips_by_user, trips_view
from . import oracle as O
from .registry import register, round_doubles

WS = 672
LAGS = feat.lag_names(WS)
ROLLS = feat.rolling_names(WS)
KEYS = ["pickup_hour", "start_station_id", "rides"]


def user_series(spark, sf):
    return series.transform_to_series(trips_by_user(spark, sf))


def type_series(spark, sf):
    return series.transform_to_series(trips_view(spark, sf))


# --- A1 -------------------------------------------------------------------
@register("hourly_demand", f"""WITH {O.trips_cte('type')},
{O.HOURLY_CTE.format(src='trips')}
SELECT pickup_hour, start_station_id, rides FROM hourly""")
def q_hourly_demand(spark, sf):
    return series.hourly_demand(trips_view(spark, sf))


# --- J1 -------------------------------------------------------------------
@register("dense_grid", f"""WITH {O.series_ctes('user')}
SELECT pickup_hour, start_station_id, rides FROM dense""")
def q_dense_grid(spark, sf):
    return user_series(spark, sf)


# --- L1 -------------------------------------------------------------------
@register("sort_series", f"""WITH {O.series_ctes('type')}
SELECT pickup_hour, start_station_id, rides FROM dense ORDER BY start_station_id, pickup_hour""")
def q_sort_series(spark, sf):
    return series.sort_series(type_series(spark, sf))


# --- A15 ------------------------------------------------------------------
@register("distinct_stations", f"""WITH {O.trips_cte('user')}
SELECT DISTINCT start_station_id FROM trips ORDER BY start_station_id""")
def q_distinct_stations(spark, sf):
    return series.distinct_stations(trips_by_user(spark, sf))


# --- C1-C3 on raw trips (started_at) -------------------------------------
_CAL = list(TIME_FEATURES[:6])
_FLAGS = list(TIME_FEATURES[6:9])
_CYC = list(TIME_FEATURES[9:])


def _time_sql(cols):
    exprs = {e.rsplit(" AS ", 1)[1]: e.rsplit(" AS ", 1)[0] for e in O.time_feature_exprs("started_at")}
    sel = [(O.r6(exprs[c]) if c in _CYC else exprs[c]) + f" AS {c}" for c in cols]
    return f"WITH {O.trips_cte('type')}\nSELECT ride_id, started_at, {', '.join(sel)} FROM trips"


def _time_q(cols):
    def q(spark, sf):
        t = trips_view(spark, sf).select("ride_id", "started_at")
        return round_doubles(time_features(t, "started_at").select("ride_id", "started_at", *cols))
    return q


register("calendar_features", _time_sql(_CAL))(_time_q(_CAL))
register("rush_flags", _time_sql(_FLAGS))(_time_q(_FLAGS))
register("cyclic_features", _time_sql(_CYC))(_time_q(_CYC))


# --- W1 -------------------------------------------------------------------
@register("lag_features", f"""WITH {O.series_ctes('user')}
SELECT pickup_hour, start_station_id, rides, {', '.join(O.lag_exprs(WS))} FROM dense""")
def q_lag_features(spark, sf):
    return feat.lag_features(user_series(spark, sf), WS)


# --- P12 ------------------------------------------------------------------
@register("fill_null_zero", f"""WITH {O.series_ctes('user')}
SELECT pickup_hour, start_station_id, rides,
       coalesce(CAST(lag(rides, 24) OVER w AS DOUBLE), 0) AS rides_lag_24h,
       coalesce(CAST(lag(rides, 168) OVER w AS DOUBLE), 0) AS rides_lag_168h,
       {O.r6('coalesce(stddev_samp(rides) OVER (w ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), 0)')}
         AS rolling_std_2h
FROM dense WINDOW w AS (PARTITION BY start_station_id ORDER BY pickup_hour)""")
def q_fill_null_zero(spark, sf):
    from pyspark.sql.window import Window
    w = Window.partitionBy("start_station_id").orderBy("pickup_hour")
    raw = user_series(spark, sf).select(
        *KEYS,
        F.lag("rides", 24).over(w).cast("double").alias("rides_lag_24h"),
        F.lag("rides", 168).over(w).cast("double").alias("rides_lag_168h"),
        F.stddev_samp(F.col("rides").cast("double")).over(w.rowsBetween(-1, 0)).alias("rolling_std_2h"))
    return round_doubles(feat.fill_null_zero(raw))


# --- W2-W4 (fast form; oracle is the plain sliding frame) ------------------
def _roll_q(stat):
    names = [f"rolling_{stat}_{w}h" for w in feat.ROLL_WINDOWS]

    def q(spark, sf):
        s = user_series(spark, sf)
        return round_doubles(feat.rolling_features(s, WS).select(*KEYS, *names))

    exprs = [e for e in O.rolling_exprs(WS) if e.endswith(tuple(f" AS {n}" for n in names))]
    inner = f"SELECT {', '.join(KEYS + exprs)} FROM dense"
    sql = f"WITH {O.series_ctes('user')}, r AS ({inner})\n" + O.rounded_select(KEYS + names, set(names), "r")
    return q, sql


for _stat, _key in (("mean", "rolling_mean"), ("max", "rolling_max"), ("std", "rolling_std")):
    _q, _sql = _roll_q(_stat)
    register(_key, _sql)(_q)


# --- W5 -------------------------------------------------------------------
_FULL = feat.full_feature_names(WS)
_FULL_DOUBLES = set(_CYC) | set(LAGS) | set(ROLLS)
FULL_FEATURES_SQL = (f"WITH {O.series_ctes('user')},\n{O.features_cte(WS)}\n"
                     + O.rounded_select(_FULL, _FULL_DOUBLES, "features"))


@register("full_features", FULL_FEATURES_SQL)
def q_full_features(spark, sf):
    return round_doubles(sparse.full_features_from_trips(trips_by_user(spark, sf), window_size=WS))


# --- W5 at asked-for hours: the hour after each hour with trips -------------
@register("full_features_at_hours", f"""WITH {O.series_ctes('user')},
{O.features_cte(WS)},
asked AS (SELECT DISTINCT start_station_id, pickup_hour + INTERVAL 1 HOUR AS pickup_hour FROM hourly)
""" + O.rounded_select(_FULL, _FULL_DOUBLES, "features SEMI JOIN asked USING (start_station_id, pickup_hour)"))
def q_full_features_at_hours(spark, sf):
    trips = trips_by_user(spark, sf)
    hourly = series.hourly_demand(trips)
    last = series.hour_bounds(trips).select("_hi")
    asked = hourly.select("start_station_id", (F.col("pickup_hour") + F.expr("INTERVAL 1 HOUR")).alias("pickup_hour"))
    asked = asked.crossJoin(F.broadcast(last)).where(F.col("pickup_hour") <= F.col("_hi")).drop("_hi")
    return round_doubles(sparse.full_features_from_trips(trips, asked, WS))


# --- W2-W4 over fractional, signed values -----------------------------------
_FRACTION = "sqrt(rides + 0.5) - 1.3"


@register("rolling_fractional", f"""WITH {O.series_ctes('user')},
f AS (SELECT pickup_hour, start_station_id, CAST({_FRACTION} AS DOUBLE) AS rides FROM dense),
r AS (SELECT pickup_hour, start_station_id, {', '.join(O.rolling_exprs(WS))} FROM f)
""" + O.rounded_select(KEYS[:2] + ROLLS, set(ROLLS), "r"))
def q_rolling_fractional(spark, sf):
    s = user_series(spark, sf).withColumn("rides", F.expr(_FRACTION).cast("double"))
    return round_doubles(feat.rolling_features(s, WS).select(*KEYS[:2], *ROLLS))


# --- P4 -------------------------------------------------------------------
@register("project_baseline", f"""WITH {O.series_ctes('user')},
b AS (SELECT pickup_hour, start_station_id, rides,
        coalesce(CAST(lag(rides, 24) OVER w AS DOUBLE), 0) AS rides_lag_24h,
        coalesce(CAST(lag(rides, 168) OVER w AS DOUBLE), 0) AS rides_lag_168h
      FROM dense WINDOW w AS (PARTITION BY start_station_id ORDER BY pickup_hour))
SELECT * FROM b""")
def q_project_baseline(spark, sf):
    return feat.project_baseline(feat.full_features(user_series(spark, sf), WS))
