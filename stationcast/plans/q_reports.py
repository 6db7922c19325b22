"""Registered queries: forecast scaffolding, deterministic forecasts and the
reports on top of them (C14-C17, J2, A13, P7-P11, S6, K2, A4-A8, L2, J7, J8, C23).

The forecast behind the reports is C16 over the per-user dense series, for the
168 hours after the history ends, so it grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import forecast_exprs as FX
from ..operators import forecast as FC
from ..operators import reports as R
from ..session import scratch_path
from ..sinks.writers import write_forecast
from ..sources.feature_files import scan_forecast
from ..sources.tables import read_table
from . import oracle as O
from .q_core import user_series
from .registry import register, round_doubles

HORIZON = 168
FC_COLS = ["start_station_id", "pickup_hour", "predicted_rides"]
NOW = dt.datetime(2024, 1, 30, 12, 0, 0)
STATION_ID = "7"

SHAPE_SQL = ("greatest(0.0, base * (0.5 + 0.5 * sin(pi() * (hour(pickup_hour) - 6) / 12))"
             " * CASE WHEN isodow(pickup_hour) >= 6 THEN 0.7 ELSE 1.0 END)")
FORECAST_CTES = f"""{O.series_ctes('user')},
base AS (SELECT start_station_id, avg(rides) AS base FROM dense GROUP BY 1),
hb AS (SELECT max(pickup_hour) AS mx FROM dense),
fc AS (SELECT b.start_station_id, b.base,
         unnest(generate_series(mx + INTERVAL 1 HOUR, mx + INTERVAL {HORIZON} HOUR, INTERVAL 1 HOUR)) AS pickup_hour
       FROM base b, hb),
forecast AS (SELECT start_station_id, pickup_hour, {SHAPE_SQL} AS predicted_rides FROM fc),
fd AS (SELECT start_station_id, pickup_hour, predicted_rides AS predicted_demand FROM forecast)"""


def history(spark, sf):
    return user_series(spark, sf)


def forecast(spark, sf):
    return FC.synthetic_forecast(history(spark, sf), HORIZON)


def demand(spark, sf):
    return forecast(spark, sf).withColumnRenamed("predicted_rides", "predicted_demand")


def r(sql_expr):
    return O.r6(sql_expr)


# --- C14 / J2 / A13 --------------------------------------------------------
@register("future_hours", f"""WITH {FORECAST_CTES}
SELECT DISTINCT pickup_hour FROM fc""")
def q_future_hours(spark, sf):
    h = history(spark, sf)
    return FC.horizon_bounds(h, HORIZON).select(
        F.explode(FX.hour_sequence(F.col("_lo"), F.col("_hi"))).alias("pickup_hour"))


@register("forecast_scaffold", f"""WITH {O.trips_cte('user')},
st AS (SELECT DISTINCT start_station_id FROM trips)
SELECT start_station_id,
       unnest(generate_series(TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '2024-02-07 23:00:00', INTERVAL 1 HOUR))
         AS pickup_hour,
       CAST(NULL AS DOUBLE) AS predicted_rides
FROM st""")
def q_forecast_scaffold(spark, sf):
    from ..sources.tables import trips_by_user
    stations = trips_by_user(spark, sf).select("start_station_id").distinct()
    return FC.forecast_scaffold(stations, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 7, 23))


@register("base_demand", f"""WITH {O.series_ctes('user')},
st AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS start_station_id FROM customer)
SELECT st.start_station_id, {r('coalesce(avg(d.rides), 5.0)')} AS base_demand
FROM st LEFT JOIN dense d USING (start_station_id) GROUP BY 1""")
def q_base_demand(spark, sf):
    # customers act as the station list: ids with and without history
    stations = read_table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("start_station_id"))
    return round_doubles(FC.base_demand(history(spark, sf), stations))


# --- C15 / C16 / C17 / P11 -------------------------------------------------
@register("synthetic_forecast", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_rides')} AS predicted_rides FROM forecast""")
def q_synthetic_forecast(spark, sf):
    return round_doubles(forecast(spark, sf))


@register("synthetic_forecast_seasonal", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour,
  {r(SHAPE_SQL + ' * (0.8 + 0.4 * sin(pi() * (month(pickup_hour) - 2) / 6))')} AS predicted_rides FROM fc""")
def q_synthetic_forecast_seasonal(spark, sf):
    return round_doubles(FC.synthetic_forecast(history(spark, sf), HORIZON, seasonal=True))


@register("pattern_fallback", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour,
  {r("5.0 * (0.7 + 0.6 * ((hour(pickup_hour) % 12) / 12.0) * CASE WHEN isodow(pickup_hour) >= 6 THEN 0.7 ELSE 1.0 END)")}
    AS predicted_rides FROM fc""")
def q_pattern_fallback(spark, sf):
    sc = FC.scaffold_after(history(spark, sf), HORIZON)
    return round_doubles(sc.select("start_station_id", "pickup_hour",
                                   FX.pattern_fallback(F.col("pickup_hour")).alias("predicted_rides")))


@register("clamp_non_negative", f"""WITH {FORECAST_CTES}
SELECT f.start_station_id, f.pickup_hour, {r('greatest(0.0, f.predicted_rides - b.base)')} AS excess_demand
FROM forecast f JOIN base b USING (start_station_id)""")
def q_clamp_non_negative(spark, sf):
    h = history(spark, sf)
    base = FC.base_demand(h)
    f = FC.synthetic_forecast(h, HORIZON).join(base, "start_station_id")
    return round_doubles(f.select("start_station_id", "pickup_hour", FX.clamp_non_negative(
        F.col("predicted_rides") - F.col("base_demand")).alias("excess_demand")))


# --- K2 + S6 ---------------------------------------------------------------
@register("scan_forecast", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_rides')} AS predicted_demand FROM forecast""")
def q_scan_forecast(spark, sf):
    root = scratch_path(spark, "forecast")
    write_forecast(forecast(spark, sf), root)
    return round_doubles(scan_forecast(spark, f"{root}/latest", "csv"))


# --- P7-P10 ----------------------------------------------------------------
@register("filter_date_range", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_demand')} AS predicted_demand FROM fd
WHERE pickup_hour BETWEEN TIMESTAMP '2024-02-01 00:00:00' AND TIMESTAMP '2024-02-03 23:59:59.999999'""")
def q_filter_date_range(spark, sf):
    return round_doubles(R.filter_date_range(demand(spark, sf), dt.date(2024, 2, 1), dt.date(2024, 2, 3)))


@register("last_n_hours", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_demand')} AS predicted_demand FROM fd
WHERE pickup_hour BETWEEN (SELECT max(pickup_hour) FROM fd) - INTERVAL 48 HOUR AND (SELECT max(pickup_hour) FROM fd)""")
def q_last_n_hours(spark, sf):
    return round_doubles(R.last_n_hours(demand(spark, sf), 48))


@register("last_7_days", f"""WITH {O.series_ctes('user')}
SELECT pickup_hour, start_station_id, rides FROM dense
WHERE pickup_hour >= TIMESTAMP '2024-01-23 12:00:00'""")
def q_last_7_days(spark, sf):
    return R.last_7_days(history(spark, sf), NOW)


@register("station_series", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_demand')} AS predicted_demand FROM fd
WHERE start_station_id = '{STATION_ID}' ORDER BY pickup_hour""")
def q_station_series(spark, sf):
    return round_doubles(R.station_series(demand(spark, sf), STATION_ID))


# --- A4-A8, L2, J7, J8 -----------------------------------------------------
@register("kpis", f"""WITH {FORECAST_CTES}
SELECT {r('avg(predicted_demand)')} AS avg_predicted, {r('max(predicted_demand)')} AS max_predicted,
       count(DISTINCT start_station_id) AS total_stations FROM fd""")
def q_kpis(spark, sf):
    return round_doubles(R.kpis(demand(spark, sf)))


@register("total_by_hour", f"""WITH {FORECAST_CTES}
SELECT pickup_hour, {r('sum(predicted_demand)')} AS predicted_demand FROM fd GROUP BY 1 ORDER BY 1""")
def q_total_by_hour(spark, sf):
    return round_doubles(R.total_by_hour(demand(spark, sf)))


@register("avg_by_hour_of_day", f"""WITH {FORECAST_CTES}
SELECT CAST(hour(pickup_hour) AS INTEGER) AS hour_of_day, {r('avg(predicted_demand)')} AS predicted_demand
FROM fd GROUP BY 1 ORDER BY 1""")
def q_avg_by_hour_of_day(spark, sf):
    return round_doubles(R.avg_by_hour_of_day(demand(spark, sf)))


DAY_NAMES_SQL = "['" + "', '".join(FX.DAY_NAMES) + "']"
MONTH_NAMES_SQL = "['" + "', '".join(FX.MONTH_NAMES) + "']"


@register("avg_by_weekday", f"""WITH {FORECAST_CTES}
SELECT CAST(isodow(pickup_hour) - 1 AS INTEGER) AS day_of_week,
       {DAY_NAMES_SQL}[isodow(pickup_hour)] AS day_name,
       {r('avg(predicted_demand)')} AS predicted_demand
FROM fd GROUP BY 1, 2 ORDER BY 1""")
def q_avg_by_weekday(spark, sf):
    return round_doubles(R.avg_by_weekday(demand(spark, sf)))


_SUMMARY_SQL = {
    "month": ("CAST(month(pickup_hour) AS INTEGER) AS month", "month",
              f", {MONTH_NAMES_SQL}[month] AS month_name"),
    "day": ("CAST(day(pickup_hour) AS INTEGER) AS day", "day", ""),
    "hour": ("CAST(hour(pickup_hour) AS INTEGER) AS hour", "hour", ""),
    "day_of_week": ("CAST(isodow(pickup_hour) - 1 AS INTEGER) AS day_of_week", "day_of_week",
                    f", {DAY_NAMES_SQL}[day_of_week + 1] AS day_name"),
}


def _summary(group):
    part, name, label = _SUMMARY_SQL[group]
    sql = f"""WITH {FORECAST_CTES},
g AS (SELECT start_station_id, {part}, predicted_rides FROM forecast),
a AS (SELECT start_station_id, {name}, avg(predicted_rides) AS predicted_rides FROM g GROUP BY 1, 2)
SELECT start_station_id, {name}, {r('predicted_rides')} AS predicted_rides{label} FROM a"""

    def q(spark, sf):
        return round_doubles(R.forecast_summary(forecast(spark, sf), group))
    return q, sql


for _g in R.SUMMARY_GROUPS:
    _q, _sql = _summary(_g)
    register(f"forecast_summary_{_g}", _sql)(_q)


@register("top10_stations_by_mean", f"""WITH {FORECAST_CTES}
SELECT start_station_id, {r('avg(predicted_demand)')} AS predicted_demand FROM fd GROUP BY 1
ORDER BY avg(predicted_demand) DESC, start_station_id LIMIT 10""")
def q_top10(spark, sf):
    return round_doubles(R.top10_stations_by_mean(demand(spark, sf)))


@register("top_k_series", f"""WITH {FORECAST_CTES},
top AS (SELECT start_station_id FROM fd GROUP BY 1 ORDER BY avg(predicted_demand) DESC, start_station_id LIMIT 5)
SELECT start_station_id, pickup_hour, {r('predicted_demand')} AS predicted_demand FROM fd
WHERE start_station_id IN (SELECT * FROM top)""")
def q_top_k_series(spark, sf):
    return round_doubles(R.top_k_series(demand(spark, sf), 5))


@register("history_forecast_union", f"""WITH {FORECAST_CTES},
u AS (SELECT start_station_id, pickup_hour, CAST(rides AS DOUBLE) AS value, 'history' AS kind FROM dense
      UNION ALL
      SELECT start_station_id, pickup_hour, predicted_rides, 'forecast' FROM forecast),
b AS (SELECT start_station_id, min(pickup_hour) AS forecast_start FROM forecast GROUP BY 1)
SELECT u.start_station_id, pickup_hour, {r('value')} AS value, kind, forecast_start FROM u JOIN b USING (start_station_id)""")
def q_history_forecast_union(spark, sf):
    h = history(spark, sf)
    return round_doubles(R.history_forecast_union(h, FC.synthetic_forecast(h, HORIZON)))


# --- C23 -------------------------------------------------------------------
@register("classify_month_names", f"""SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
  {MONTH_NAMES_SQL}[month(o_orderdate)] AS month_name,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
  {DAY_NAMES_SQL}[isodow(o_orderdate)] AS day_name
FROM orders""")
def q_classify_month_names(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", F.month("o_orderdate").alias("month"),
                    FX.month_name(F.month("o_orderdate")).alias("month_name"),
                    F.weekday("o_orderdate").alias("day_of_week"),
                    FX.day_name(F.weekday("o_orderdate")).alias("day_name"))


# --- K2 / K6 ---------------------------------------------------------------
@register("write_forecast", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_rides')} AS predicted_rides, copy
FROM forecast, (VALUES ('latest'), ('stamped')) AS c(copy)""")
def q_write_forecast(spark, sf):
    """K2: both copies, read back."""
    root = scratch_path(spark, "forecast-parquet") + ".parquet"
    path = write_forecast(forecast(spark, sf), root, "20240131_000000")
    a, b = [spark.read.parquet(p).withColumn("copy", F.lit(c)) for c, p in
            (("latest", f"{root}/latest"), ("stamped", path))]
    return round_doubles(a.unionByName(b))


@register("export_filtered_forecast", f"""WITH {FORECAST_CTES}
SELECT start_station_id, pickup_hour, {r('predicted_demand')} AS predicted_demand FROM fd
WHERE pickup_hour BETWEEN TIMESTAMP '2024-02-02 00:00:00' AND TIMESTAMP '2024-02-04 23:59:59.999999'""")
def q_export_filtered_forecast(spark, sf):
    from ..sinks.writers import export_filtered_forecast
    path = scratch_path(spark, "forecast-export")
    export_filtered_forecast(R.filter_date_range(demand(spark, sf), dt.date(2024, 2, 2), dt.date(2024, 2, 4)), path)
    return round_doubles(scan_forecast(spark, path, "csv"))
