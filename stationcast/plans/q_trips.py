"""Registered queries: trip parsing/cleaning, top stations, trip features,
trip-file scans and the feature pipeline (P1-P3, A2, A3, J3, J4, C4-C11, S1, S3, L3, M12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import trip as TF
from ..operators import clean, series
from ..operators import features as feat
from ..operators import trips as TR
from ..session import scratch_path
from ..sources import trip_files as TFILES
from ..sources.tables import orders_trips, orders_trips_sql, trips_by_user, trips_view
from . import oracle as O
from .pipelines import run_features
from .registry import register, round_doubles

YEAR, MONTH = 2024, 1
CLEAN_WHERE = """started_at IS NOT NULL AND ended_at IS NOT NULL
  AND ended_at > started_at AND ended_at <= started_at + INTERVAL 24 HOUR
  AND started_at >= TIMESTAMP '2024-01-01 00:00:00' AND started_at < TIMESTAMP '2024-02-01 00:00:00'
  AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL"""
VIEW_COLS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_id",
             "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng",
             "member_casual", "user_id"]


# --- P1: times published as text, two formats plus junk ------------------
def _texted_trips(spark, sf):
    t = trips_view(spark, sf, ends=True)
    uid = F.col("user_id")
    start_text = (F.when(uid % 50 == 7, F.lit("not a time"))
                  .when(uid % 2 == 0, F.date_format("started_at", TFILES.MONTH_FIRST_TEXT))
                  .otherwise(F.date_format("started_at", TFILES.ISO_TEXT)))
    return t.withColumn("started_at", start_text).withColumn(
        "ended_at", F.date_format("ended_at", TFILES.ISO_TEXT))


PARSED_SQL = f"""WITH {O.trips_cte('type')},
p AS (SELECT ride_id, user_id,
        CASE WHEN user_id % 50 = 7 THEN NULL
             WHEN user_id % 2 = 0 THEN date_trunc('minute', started_at)
             ELSE started_at END AS started_at,
        ended_at
      FROM trips)"""


@register("parse_trip_times", PARSED_SQL + """
SELECT ride_id, started_at, ended_at FROM p WHERE started_at IS NOT NULL AND ended_at IS NOT NULL""")
def q_parse_trip_times(spark, sf):
    return clean.parse_trip_times(_texted_trips(spark, sf)).select("ride_id", "started_at", "ended_at")


# --- P2 / P3 -------------------------------------------------------------
@register("clean_trips", f"""WITH {O.trips_cte('type')}
SELECT * FROM trips WHERE {CLEAN_WHERE}""")
def q_clean_trips(spark, sf):
    return clean.clean_trips(trips_view(spark, sf, ends=True), YEAR, MONTH)


@register("clean_stats", f"""WITH {O.trips_cte('type')}
SELECT count(*) AS total_records,
       count(*) FILTER (WHERE {CLEAN_WHERE}) AS valid_records,
       count(*) - count(*) FILTER (WHERE {CLEAN_WHERE}) AS records_dropped,
       {O.r6(f"(count(*) - count(*) FILTER (WHERE {CLEAN_WHERE})) * 100.0 / count(*)")} AS percent_dropped
FROM trips WHERE started_at IS NOT NULL AND ended_at IS NOT NULL""")
def q_clean_stats(spark, sf):
    return clean.clean_stats(trips_view(spark, sf, ends=True), YEAR, MONTH)


# --- A2 / A3 / J3 --------------------------------------------------------
@register("top_stations", f"""WITH {O.trips_cte('user')}
SELECT start_station_id, count(*) AS trips FROM trips GROUP BY 1
ORDER BY trips DESC, start_station_id ASC LIMIT 10""")
def q_top_stations(spark, sf):
    return series.top_stations(trips_by_user(spark, sf), 10)


@register("top_stations_named", f"""WITH t AS ({orders_trips_sql('duckdb')}),
a AS (SELECT start_station_id, count(*) AS trips,
             arg_min(start_station_name, (started_at, ride_id)) AS station_name
      FROM t GROUP BY 1 ORDER BY trips DESC, start_station_id ASC LIMIT 5)
SELECT CAST(row_number() OVER (ORDER BY trips DESC, start_station_id) AS INTEGER) AS rank,
       station_name, start_station_id, trips FROM a""")
def q_top_stations_named(spark, sf):
    return series.top_stations_named(orders_trips(spark, sf), 5)


@register("filter_top_stations", f"""WITH {O.trips_cte('type')},
top AS (SELECT start_station_id FROM trips GROUP BY 1 ORDER BY count(*) DESC, start_station_id LIMIT 3)
SELECT ride_id, start_station_id, started_at FROM trips WHERE start_station_id IN (SELECT * FROM top)""")
def q_filter_top_stations(spark, sf):
    t = trips_view(spark, sf)
    return series.filter_top_stations(t, series.top_stations(t, 3)).select(
        "ride_id", "start_station_id", "started_at")


# --- J4 / C9 / C10 -------------------------------------------------------
POP_SQL = f"""WITH {O.trips_cte('user')},
pop AS (SELECT t.*, count(*) OVER (PARTITION BY start_station_id) AS station_popularity FROM trips t),
e AS (SELECT min(station_popularity) AS e0,
             quantile_cont(station_popularity, [0.25, 0.5, 0.75]) AS q,
             max(station_popularity) AS e4 FROM pop)"""


@register("attach_popularity", POP_SQL + """
SELECT ride_id, start_station_id, station_popularity FROM pop""")
def q_attach_popularity(spark, sf):
    return TR.attach_popularity(trips_by_user(spark, sf)).select(
        "ride_id", "start_station_id", "station_popularity")


@register("popularity_bucket", POP_SQL + """
SELECT ride_id, station_popularity,
       CASE WHEN station_popularity <= q[1] THEN 'low'
            WHEN station_popularity <= q[2] THEN 'medium'
            WHEN station_popularity <= q[3] THEN 'high'
            WHEN station_popularity <= e4 THEN 'very_high' END AS station_popularity_category
FROM pop, e""")
def q_popularity_bucket(spark, sf):
    t = trips_by_user(spark, sf)
    out = TR.popularity_bucket(TR.attach_popularity(t), TR.popularity_edges(t))
    return out.select("ride_id", "station_popularity", "station_popularity_category")


@register("round_trip", f"""WITH {O.trips_cte('type')}
SELECT ride_id, CAST(coalesce(start_station_id = end_station_id, false) AS INTEGER) AS round_trip
FROM trips""")
def q_round_trip(spark, sf):
    t = trips_view(spark, sf, ends=True)
    return t.select("ride_id", TF.round_trip(F.col("start_station_id"), F.col("end_station_id")).alias("round_trip"))


# --- C4-C8 ---------------------------------------------------------------
HAVERSINE_SQL = """2 * asin(sqrt(pow(sin((radians(end_lat) - radians(start_lat)) / 2), 2)
  + cos(radians(start_lat)) * cos(radians(end_lat))
  * pow(sin((radians(end_lng) - radians(start_lng)) / 2), 2))) * 6371.0"""
LENGTH_SQL = """CASE WHEN d > 0 AND d <= 1 THEN 'short' WHEN d > 1 AND d <= 3 THEN 'medium'
  WHEN d > 3 AND d <= 100 THEN 'long' END"""
DURATION_SQL = "date_diff('microsecond', started_at, ended_at) / 60000000.0"
DURATION_BUCKET_SQL = """CASE WHEN m > 0 AND m <= 5 THEN 'very_short' WHEN m > 5 AND m <= 15 THEN 'short'
  WHEN m > 15 AND m <= 30 THEN 'medium' WHEN m > 30 AND m <= 60 THEN 'long'
  WHEN m > 60 AND m <= 1440 THEN 'very_long' END"""


@register("haversine_km", f"""WITH {O.trips_cte('type')}
SELECT ride_id, {O.r6(HAVERSINE_SQL)} AS distance_km FROM trips""")
def q_haversine(spark, sf):
    return round_doubles(TR.geo_features(trips_view(spark, sf)).select("ride_id", "distance_km"))


@register("trip_length_bucket", f"""WITH {O.trips_cte('type')},
g AS (SELECT ride_id, {HAVERSINE_SQL} AS d FROM trips)
SELECT ride_id, {LENGTH_SQL} AS trip_length FROM g""")
def q_trip_length(spark, sf):
    return TR.geo_features(trips_view(spark, sf)).select("ride_id", "trip_length")


@register("trip_duration", f"""WITH {O.trips_cte('type')}
SELECT ride_id, {O.r6(DURATION_SQL)} AS duration_minutes FROM trips""")
def q_trip_duration(spark, sf):
    t = trips_view(spark, sf, ends=True)
    return round_doubles(t.select("ride_id", TF.trip_duration_minutes(
        F.col("started_at"), F.col("ended_at")).alias("duration_minutes")))


@register("duration_bucket", f"""WITH {O.trips_cte('type')},
d AS (SELECT ride_id, {DURATION_SQL} AS m FROM trips)
SELECT ride_id, {DURATION_BUCKET_SQL} AS duration_category FROM d""")
def q_duration_bucket(spark, sf):
    t = trips_view(spark, sf, ends=True)
    m = TF.trip_duration_minutes(F.col("started_at"), F.col("ended_at"))
    return t.select("ride_id", TF.duration_bucket(m).alias("duration_category"))


ONE_HOT_SQL = """CAST(coalesce(rideable_type = 'classic_bike', false) AS INTEGER) AS bike_classic_bike,
  CAST(coalesce(rideable_type = 'electric_bike', false) AS INTEGER) AS bike_electric_bike,
  CAST(coalesce(member_casual = 'casual', false) AS INTEGER) AS user_casual,
  CAST(coalesce(member_casual = 'member', false) AS INTEGER) AS user_member"""


@register("one_hot", f"""WITH {O.trips_cte('type')}
SELECT ride_id, {ONE_HOT_SQL} FROM trips""")
def q_one_hot(spark, sf):
    t = trips_view(spark, sf).select("ride_id", "rideable_type", "member_casual")
    out = TR.one_hot(TR.one_hot(t, "rideable_type", "bike"), "member_casual", "user")
    return out.drop("rideable_type", "member_casual")


@register("one_hot_long", f"""WITH {O.trips_cte('type')}
SELECT ride_id, 'bike' AS prefix, rideable_type AS value, 1 AS hot FROM trips WHERE rideable_type IS NOT NULL
UNION ALL SELECT ride_id, 'user', member_casual, 1 FROM trips WHERE member_casual IS NOT NULL""")
def q_one_hot_long(spark, sf):
    """C8 as rows, for values that should not become columns."""
    t = trips_view(spark, sf)
    bike, user = (TR.one_hot_long(t, "ride_id", c) for c in ("rideable_type", "member_casual"))
    return bike.withColumn("prefix", F.lit("bike")).unionByName(user.withColumn("prefix", F.lit("user")))


# --- C11 -----------------------------------------------------------------
def _c11_sql():
    time_exprs = O.time_feature_exprs("started_at")
    time_sel = []
    for e in time_exprs:
        expr, name = e.rsplit(" AS ", 1)
        time_sel.append((O.r6(expr) if name in O.DOUBLE_TIME_FEATURES else expr) + f" AS {name}")
    return f"""WITH {O.trips_cte('type')},
pop AS (SELECT t.*, count(*) OVER (PARTITION BY start_station_id) AS station_popularity FROM trips t),
e AS (SELECT quantile_cont(station_popularity, [0.25, 0.5, 0.75]) AS q, max(station_popularity) AS e4 FROM pop),
x AS (SELECT pop.*, {HAVERSINE_SQL} AS d, {DURATION_SQL} AS m, q, e4 FROM pop, e)
SELECT {', '.join(c for c in VIEW_COLS if c not in ('start_lat', 'start_lng', 'end_lat', 'end_lng'))},
  {O.r6('start_lat')} AS start_lat, {O.r6('start_lng')} AS start_lng,
  {O.r6('end_lat')} AS end_lat, {O.r6('end_lng')} AS end_lng,
  {', '.join(time_sel)},
  station_popularity,
  CASE WHEN station_popularity <= q[1] THEN 'low' WHEN station_popularity <= q[2] THEN 'medium'
       WHEN station_popularity <= q[3] THEN 'high' WHEN station_popularity <= e4 THEN 'very_high'
  END AS station_popularity_category,
  CAST(coalesce(start_station_id = end_station_id, false) AS INTEGER) AS round_trip,
  {O.r6('m')} AS duration_minutes, {DURATION_BUCKET_SQL} AS duration_category,
  {ONE_HOT_SQL},
  {O.r6('d')} AS distance_km, {LENGTH_SQL} AS trip_length
FROM x"""


@register("raw_trip_features", _c11_sql())
def q_raw_trip_features(spark, sf):
    return round_doubles(TR.raw_trip_features(trips_view(spark, sf, ends=True)))


# --- S1: trip CSVs (two time formats) read back and cleaned --------------
@register("scan_trips", f"""WITH {O.trips_cte('type')},
p AS (SELECT * REPLACE (
        CASE WHEN user_id % 2 = 0 THEN date_trunc('minute', started_at) ELSE started_at END AS started_at,
        CASE WHEN user_id % 2 = 0 THEN date_trunc('minute', ended_at) ELSE ended_at END AS ended_at)
      FROM trips)
SELECT ride_id, rideable_type, started_at, ended_at, start_station_id, end_station_id,
       start_lat, start_lng, end_lat, end_lng, member_casual
FROM p WHERE {CLEAN_WHERE}""")
def q_scan_trips(spark, sf):
    root = scratch_path(spark, "trip-csv")
    t = trips_view(spark, sf, ends=True).withColumn("start_station_name", F.lit(None).cast("string")) \
        .withColumn("end_station_name", F.lit(None).cast("string"))
    TFILES.write_trip_csv(t, root, alt_format_when=(F.col("user_id") % 2 == 0))
    raw = TFILES.scan_trips(spark, root, YEAR, MONTH)
    return clean.clean_trips(raw, YEAR, MONTH).select(
        "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id",
        "start_lat", "start_lng", "end_lat", "end_lng", "member_casual")


# --- S3 / L3: multi-year month ranges over orders-as-trips ----------------
def _orders_root(spark, sf):
    root = scratch_path(spark, "orders-trip-csv")
    TFILES.write_trip_csv(orders_trips(spark, sf), root)
    return root


_ORDERS_OUT = ["ride_id", "started_at", "ended_at", "start_station_id", "year", "month"]
_ORDERS_SQL = f"""WITH t AS ({orders_trips_sql('duckdb')}),
y AS (SELECT *, CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month FROM t)
SELECT {', '.join(_ORDERS_OUT)} FROM y WHERE year * 12 + month BETWEEN {{lo}} AND {{hi}}"""


@register("month_range_scan", _ORDERS_SQL.format(lo=1996 * 12 + 11, hi=1998 * 12 + 2))
def q_month_range_scan(spark, sf):
    root = _orders_root(spark, sf)
    out = TFILES.month_range_scan(spark, root, (1996, 11), (1998, 2))
    return clean.parse_trip_times(out).select(*_ORDERS_OUT)


@register("union_months", _ORDERS_SQL.format(lo=1997 * 12 + 1, hi=1997 * 12 + 3))
def q_union_months(spark, sf):
    root = _orders_root(spark, sf)
    months = [TFILES.scan_trips(spark, root, 1997, m) for m in (1, 2, 3)]
    return clean.parse_trip_times(TFILES.union_months(months)).select(*_ORDERS_OUT)


# --- M12: the feature pipeline's final frame ----------------------------
_M12_FULL = feat.full_feature_names(feat.DEFAULT_WINDOW_SIZE)
M12_WHERE = CLEAN_WHERE.replace("started_at < TIMESTAMP '2024-02-01 00:00:00'", "started_at < TIMESTAMP '2024-04-01 00:00:00'")
RUN_FEATURES_CTES = f"""WITH {O.trips_cte('type')},
clean AS (SELECT * FROM trips WHERE {M12_WHERE}),
top AS (SELECT start_station_id FROM clean GROUP BY 1 ORDER BY count(*) DESC, start_station_id LIMIT 3),
{O.HOURLY_CTE.format(src='(SELECT * FROM clean WHERE start_station_id IN (SELECT * FROM top))')},
{O.DENSE_CTE}"""
RUN_FEATURES_SQL = (f"""{RUN_FEATURES_CTES},
{O.features_cte()}
""" + O.rounded_select(_M12_FULL, O.DOUBLE_TIME_FEATURES | set(feat.lag_names()) | set(feat.rolling_names()),
                       "features"))


@register("run_features", RUN_FEATURES_SQL)
def q_run_features(spark, sf):
    """The three sets written as files and appended to the offline store; the full set read back."""
    written = run_features(spark, sf, scratch_path(spark, "run-features"))
    return round_doubles(written["sets"]["full_features"])


# --- S2: zipped monthly CSVs ------------------------------------------------
@register("scan_zipped_csv", f"""WITH {O.trips_cte('type')}
SELECT ride_id, started_at, ended_at, start_station_id, end_station_id, member_casual FROM trips""")
def q_scan_zipped_csv(spark, sf):
    from ..sources.archives import scan_zipped_csv, write_archives
    root = scratch_path(spark, "trip-archives")
    t = trips_view(spark, sf, ends=True).withColumn("start_station_name", F.lit(None).cast("string")) \
        .withColumn("end_station_name", F.lit(None).cast("string"))
    write_archives(t, root).write.format("noop").mode("overwrite").save()
    rows = scan_zipped_csv(spark, f"{root}/*.zip")
    return rows.select("ride_id", clean.lenient_timestamp(F.col("started_at")).alias("started_at"),
                       clean.lenient_timestamp(F.col("ended_at")).alias("ended_at"),
                       "start_station_id", "end_station_id", "member_casual")
