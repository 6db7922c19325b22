"""Registered queries: supervised prep, feature selection and feature files
(W6, W7, W8, W10, C12, C13, J5, A9, P5, S4, S5, K1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import prep as PR
from ..operators.selection import f_regression_scores
from ..session import scratch_path
from ..sinks.writers import write_feature_sets, write_table
from ..sources.feature_files import scan_feature_sets, scan_features
from ..sources.tables import read_table
from . import oracle as O
from .pipelines import feature_sets
from .q_core import user_series
from .q_trips import RUN_FEATURES_CTES, RUN_FEATURES_SQL
from .registry import register, round_doubles, round_half_away

W, STEP = 12, 3
BASELINE_DDL = ("pickup_hour STRING, start_station_id STRING, rides BIGINT, "
                "rides_lag_24h DOUBLE, rides_lag_168h DOUBLE")
BASELINE_CTE = """b AS (SELECT pickup_hour, start_station_id, rides,
    coalesce(CAST(lag(rides, 24) OVER w AS DOUBLE), 0) AS rides_lag_24h,
    coalesce(CAST(lag(rides, 168) OVER w AS DOUBLE), 0) AS rides_lag_168h
  FROM dense WINDOW w AS (PARTITION BY start_station_id ORDER BY pickup_hour))"""


def baseline(spark, sf):
    return feat.project_baseline(feat.full_features(user_series(spark, sf)))


# --- W6 / W10 --------------------------------------------------------------
_T_COLS = ", ".join(f'lag(rides, {k}) OVER w AS "rides_t-{k}"' for k in range(W, 0, -1))
WINDOWED_CTES = f"""{O.series_ctes('user')},
{BASELINE_CTE},
x AS (SELECT lag(pickup_hour, 1) OVER w AS pickup_hour, start_station_id,
        lag(rides_lag_24h, 1) OVER w AS rides_lag_24h, lag(rides_lag_168h, 1) OVER w AS rides_lag_168h,
        {_T_COLS}, rides AS target, row_number() OVER w - 1 AS j
      FROM b WINDOW w AS (PARTITION BY start_station_id ORDER BY pickup_hour)),
ex AS (SELECT * EXCLUDE (j) FROM x WHERE j >= {W} AND (j - {W}) % {STEP} = 0)"""


def examples(spark, sf):
    return PR.sliding_window_features(baseline(spark, sf), "rides", W, STEP)


@register("sliding_window_features", f"WITH {WINDOWED_CTES}\nSELECT * FROM ex")
def q_sliding_window_features(spark, sf):
    return examples(spark, sf)


_LAGS_SEL = ", ".join(f'"rides_t-{k}" AS lag_{k}h' for k in range(W, 0, -1))


@register("series_with_lags", f"""WITH {WINDOWED_CTES}
SELECT pickup_hour AS time, target AS actual, {_LAGS_SEL} FROM ex
WHERE start_station_id = '7' ORDER BY time""")
def q_series_with_lags(spark, sf):
    return PR.series_with_lags(examples(spark, sf), "7")


# --- W7 --------------------------------------------------------------------
SPLIT_CTE = """s AS (SELECT pickup_hour AS split_hour FROM (
    SELECT pickup_hour, row_number() OVER (ORDER BY pickup_hour) - 1 AS i, count(*) OVER () AS n
    FROM (SELECT DISTINCT pickup_hour FROM dense)) WHERE i = floor(n * 0.8))"""


@register("time_split", f"""WITH {O.series_ctes('user')}, {SPLIT_CTE}
SELECT pickup_hour, start_station_id, rides,
       CASE WHEN pickup_hour < split_hour THEN 'train' ELSE 'test' END AS split FROM dense, s""")
def q_time_split(spark, sf):
    return PR.time_split(user_series(spark, sf))


# --- C12 -------------------------------------------------------------------
@register("expand_datetime", f"""WITH {O.series_ctes('user')}, {BASELINE_CTE}
SELECT start_station_id, rides, rides_lag_24h, rides_lag_168h,
  CAST(hour(pickup_hour) AS INTEGER) AS pickup_hour_hour, CAST(day(pickup_hour) AS INTEGER) AS pickup_hour_day,
  CAST(month(pickup_hour) AS INTEGER) AS pickup_hour_month, CAST(year(pickup_hour) AS INTEGER) AS pickup_hour_year,
  CAST(isodow(pickup_hour) - 1 AS INTEGER) AS pickup_hour_dayofweek,
  CAST(epoch(pickup_hour) AS BIGINT) AS pickup_hour_timestamp
FROM b""")
def q_expand_datetime(spark, sf):
    return PR.expand_datetime(baseline(spark, sf))


# --- C13 / J5 (part brands and types by the train part of the table) -------
PART_SPLIT = """ps AS (SELECT p_partkey AS split_key FROM (
    SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, count(*) OVER () AS n
    FROM (SELECT DISTINCT p_partkey FROM part)) WHERE i = floor(n * 0.8)),
tr AS (SELECT p.* FROM part p, ps WHERE p_partkey < split_key),
te AS (SELECT p.* FROM part p, ps WHERE p_partkey >= split_key),
codes AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT p_brand FROM tr))"""


def _part_train_test(spark, sf):
    part = read_table(spark, sf, "part")
    lab = PR.time_split(part, 0.8, "p_partkey")
    return lab.where(F.col("split") == "train"), lab.where(F.col("split") == "test")


@register("label_encode", f"""WITH {PART_SPLIT}
SELECT p_partkey, 'train' AS split, coalesce(c.code, -1) AS p_brand FROM tr LEFT JOIN codes c USING (p_brand)
UNION ALL
SELECT p_partkey, 'test', coalesce(c.code, -1) FROM te LEFT JOIN codes c USING (p_brand)""")
def q_label_encode(spark, sf):
    train, test = _part_train_test(spark, sf)
    tr, te = PR.label_encode(train.select("p_partkey", "split", "p_brand"),
                             test.select("p_partkey", "split", "p_brand"), ["p_brand"])
    return tr.unionByName(te)


@register("encode_lookup", f"""WITH {PART_SPLIT},
names AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT p_name FROM tr WHERE p_name IS NOT NULL))
SELECT p_partkey, coalesce(c.code, -1) AS p_name_code FROM part LEFT JOIN names c USING (p_name)""")
def q_encode_lookup(spark, sf):
    """The train parts' names looked up for every part; names that only test parts have are -1."""
    train, _ = _part_train_test(spark, sf)
    part = read_table(spark, sf, "part")
    return PR.encode_lookup(part, PR.category_codes(train, "p_name"), "p_name", "p_name_code").select(
        "p_partkey", "p_name_code")


# --- W8 --------------------------------------------------------------------
@register("recent_history", f"""WITH {O.series_ctes('user')},
r AS (SELECT *, row_number() OVER (PARTITION BY start_station_id ORDER BY pickup_hour DESC) - 1 AS _age,
             count(*) OVER (PARTITION BY start_station_id) AS n FROM dense)
SELECT pickup_hour, start_station_id, rides, CAST(_age AS INTEGER) AS _age FROM r WHERE _age < 24 AND n >= 24""")
def q_recent_history(spark, sf):
    return PR.recent_history(user_series(spark, sf), 24)


# --- A9 / P5 ---------------------------------------------------------------
_SEL_FEATURES = [c for c in feat.full_feature_names() if c not in feat.KEY_COLUMNS]
_SCORE_UNION = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {i} AS idx, covar_samp(CAST({c} AS DOUBLE), CAST(rides AS DOUBLE)) AS cov, "
    f"var_samp(CAST({c} AS DOUBLE)) AS vx, min({c}) = max({c}) AS const FROM features"
    for i, c in enumerate(_SEL_FEATURES))
SCORE_CTES = f"""st AS (SELECT count(*) AS n, var_samp(CAST(rides AS DOUBLE)) AS vy, min(rides) = max(rides) AS ky FROM features),
sc AS ({_SCORE_UNION}),
f AS (SELECT feature, CAST(idx AS INTEGER) AS idx,
        CASE WHEN const OR ky OR vx IS NULL THEN 0.0
             WHEN cov * cov / (vx * vy) >= 1 THEN 1.7976931348623157e308
             ELSE (cov * cov / (vx * vy)) / (1 - cov * cov / (vx * vy)) * (n - 2) END AS f_score
      FROM sc, st)"""
F_REG_SQL = f"""WITH {O.series_ctes('user')},
{O.features_cte()},
{SCORE_CTES}
SELECT feature, idx, round(f_score, 3) AS f_score,
  CAST(row_number() OVER (ORDER BY f_score DESC, idx DESC) AS INTEGER) AS rank,
  CAST(row_number() OVER (ORDER BY f_score DESC, idx DESC) <= 10 AS INTEGER) AS selected
FROM f"""


@register("f_regression_scores", F_REG_SQL)
def q_f_regression_scores(spark, sf):
    s = f_regression_scores(feat.full_features(user_series(spark, sf)))
    return s.withColumn("f_score", round_half_away("f_score", 3))


@register("f_regression_scores_train", f"""WITH {O.series_ctes('user')},
{O.features_cte(name='every_hour')}, {SPLIT_CTE},
features AS (SELECT every_hour.* FROM every_hour, s WHERE pickup_hour < split_hour),
{SCORE_CTES}
SELECT feature, idx, round(f_score, 3) AS f_score,
  CAST(row_number() OVER (ORDER BY f_score DESC, idx DESC) AS INTEGER) AS rank,
  CAST(row_number() OVER (ORDER BY f_score DESC, idx DESC) <= 10 AS INTEGER) AS selected
FROM f""")
def q_f_regression_scores_train(spark, sf):
    """A9 on the hours before the time split only, so the choice of features sees no test row."""
    train, _ = PR.train_test(feat.full_features(user_series(spark, sf)))
    return f_regression_scores(train).withColumn("f_score", round_half_away("f_score", 3))


_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SEL_FEATURES)
REDUCED_SQL = f"""{RUN_FEATURES_CTES},
{O.features_cte()},
{SCORE_CTES},
chosen AS (SELECT feature FROM f ORDER BY f_score DESC, idx DESC LIMIT 10),
long AS (UNPIVOT (SELECT pickup_hour, start_station_id, rides, {_AS_DOUBLE} FROM features)
         ON {', '.join(_SEL_FEATURES)} INTO NAME feature VALUE value)
SELECT pickup_hour, start_station_id, rides, feature, {O.r6('value')} AS value
FROM long WHERE feature IN (SELECT feature FROM chosen)"""


@register("project_reduced", REDUCED_SQL)
def q_project_reduced(spark, sf):
    """P5 as (keys, target, feature, value) rows: which columns are kept depends on the scores."""
    reduced = feature_sets(spark, sf)["reduced_features"]
    names = [c for c in reduced.columns if c not in feat.KEY_COLUMNS]
    long = reduced.unpivot(list(feat.KEY_COLUMNS), [F.col(c).cast("double").alias(c) for c in names], "feature", "value")
    return round_doubles(long.select("pickup_hour", "start_station_id", "rides", "feature", "value"))


# --- S4 / S5 / K1 ----------------------------------------------------------
BASELINE_SQL = f"WITH {O.series_ctes('user')}, {BASELINE_CTE}\nSELECT * FROM b"


@register("scan_features", BASELINE_SQL)
def q_scan_features(spark, sf):
    root = scratch_path(spark, "features")
    write_table(baseline(spark, sf), f"{root}/baseline_features.csv", "csv")
    return scan_features(spark, f"{root}/baseline_features.csv", schema=BASELINE_DDL)


SETS_SQL = (f"{RUN_FEATURES_CTES},\n{O.features_cte()},\n" + """sets3 AS (
  SELECT *, rides_lag_24h AS baseline_lag_24h, rides_lag_168h AS baseline_lag_168h, rides AS reduced_rides FROM features)
""" + O.rounded_select(feat.full_feature_names() + ["baseline_lag_24h", "baseline_lag_168h", "reduced_rides"],
                       O.DOUBLE_TIME_FEATURES | set(feat.lag_names()) | set(feat.rolling_names())
                       | {"baseline_lag_24h", "baseline_lag_168h"}, "sets3"))


@register("scan_feature_sets", SETS_SQL)
def q_scan_feature_sets(spark, sf):
    """All three sets read back and put side by side on their keys."""
    root = scratch_path(spark, "feature-sets")
    sets = feature_sets(spark, sf)
    sets = {k: v for k, v in sets.items() if k != "selection_scores"}
    for name, df in sets.items():
        write_table(df, f"{root}/{name}.parquet", "parquet")
    candidates = {n: [(f"{root}/missing/{n}.csv", "csv"), (f"{root}/{n}.parquet", "parquet")]
                  for n in sets}
    read = scan_feature_sets(spark, candidates)
    keys = ["pickup_hour", "start_station_id"]
    base = read["baseline_features"].select(*keys, F.col("rides_lag_24h").alias("baseline_lag_24h"),
                                            F.col("rides_lag_168h").alias("baseline_lag_168h"))
    reduced = read["reduced_features"].select(*keys, F.col("rides").alias("reduced_rides"))
    return round_doubles(read["full_features"].join(base, keys).join(reduced, keys))


@register("write_feature_sets", f"SELECT * FROM ({RUN_FEATURES_SQL}), (VALUES ('latest'), ('stamped')) AS c(copy)")
def q_write_feature_sets(spark, sf):
    """K1: both copies of the full set, read back."""
    root = scratch_path(spark, "feature-store-files")
    sets = feature_sets(spark, sf)
    sets.pop("selection_scores")
    stamped = write_feature_sets(sets, root, "20240131_000000")["full_features"]
    copies = {"latest": f"{root}/full_features/latest", "stamped": stamped}
    a, b = [spark.read.parquet(p).withColumn("copy", F.lit(c)) for c, p in copies.items()]
    return round_doubles(a.unionByName(b))
