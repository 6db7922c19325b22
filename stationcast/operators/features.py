"""Time-series features on the dense hourly series.

All columns are window expressions over ``partitionBy(station).orderBy(hour)``.
The dense grid has exactly one row per (station, hour), so a station's window
partition is bounded by the length of the time range, never by how many trips
the station had: hot stations do not make hot window partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.calendar import TIME_FEATURES, time_features

# Lag offsets (hours) and rolling window lengths (hours).
LAG_HOURS = (1, 2, 3, 6, 12, 24, 48, 72, 168, 336, 504, 672)
ROLL_WINDOWS = (24, 168, 672)
DEFAULT_WINDOW_SIZE = 28 * 24

KEY_COLUMNS = ("pickup_hour", "start_station_id", "rides")
BASELINE_COLUMNS = ("pickup_hour", "start_station_id", "rides", "rides_lag_24h", "rides_lag_168h")


def lag_names(window_size: int = DEFAULT_WINDOW_SIZE) -> list[str]:
    return [f"rides_lag_{k}h" for k in LAG_HOURS if k <= window_size]


def rolling_names(window_size: int = DEFAULT_WINDOW_SIZE) -> list[str]:
    return [f"rolling_{s}_{w}h" for w in ROLL_WINDOWS if w <= window_size
            for s in ("mean", "max", "std")]


def full_feature_names(window_size: int = DEFAULT_WINDOW_SIZE) -> list[str]:
    return list(KEY_COLUMNS) + list(TIME_FEATURES) + lag_names(window_size) + rolling_names(window_size)


def _series_window(station: str, hour: str):
    return Window.partitionBy(station).orderBy(hour)


def lag_features(df: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE,
                 station: str = "start_station_id", hour: str = "pickup_hour",
                 value: str = "rides") -> DataFrame:
    """``rides_lag_{k}h`` = value k rows earlier in the station's series, 0 when absent."""
    w = _series_window(station, hour)
    return df.withColumns({
        f"rides_lag_{k}h": F.coalesce(F.lag(F.col(value), k).over(w).cast("double"), F.lit(0.0))
        for k in LAG_HOURS if k <= window_size})


def rolling_features_naive(df: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE,
                           station: str = "start_station_id", hour: str = "pickup_hour",
                           value: str = "rides", exclude_current: bool = False) -> DataFrame:
    """W2-W4 as sliding frames.  O(rows x window): the reference definition, kept for checks."""
    cols = {}
    base = _series_window(station, hour)
    for win in ROLL_WINDOWS:
        if win > window_size:
            continue
        frame = base.rowsBetween(-win, -1) if exclude_current else base.rowsBetween(-(win - 1), 0)
        x = F.col(value).cast("double")
        cols[f"rolling_mean_{win}h"] = F.coalesce(F.avg(x).over(frame), F.lit(0.0))
        cols[f"rolling_max_{win}h"] = F.coalesce(F.max(x).over(frame), F.lit(0.0))
        cols[f"rolling_std_{win}h"] = F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0))
    return df.withColumns(cols)


def rolling_features(df: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE,
                     station: str = "start_station_id", hour: str = "pickup_hour",
                     value: str = "rides") -> DataFrame:
    """W2-W4 without sliding frames (Spark re-aggregates a sliding frame for
    every row: O(rows x window)).  Every expression below is a running sum, a
    row number or a lag over the same (station ordered by hour) window, so the
    rows are sorted once and no frame is ever re-scanned.

    mean / sample std from running sums: with S1 = sum x and S2 = sum x^2 up to
    the current row (exact in bigint), the last m = min(rn, w) rows have
    a = S1 - S1[rn-w] and q = S2 - S2[rn-w]; mean = a/m and
    std = sqrt((m q - a^2) / (m (m-1))), 0 when m = 1.  Differences of such sums are
    only exact for integers; other number types take ``_rolling_moments``.

    max by doubling: M1 = x, M2k[i] = greatest(Mk[i], Mk[i-k]) covers the last
    2k rows; for a window w with 2^j <= w, max = greatest(M[i], M[i-(w-2^j)])
    with M = M_{2^j}.  log2(672) < 10 lag steps serve all three windows, and
    ``greatest`` skips the nulls before a series starts.
    """
    if not isinstance(df.schema[value].dataType, T.IntegralType):
        return _rolling_moments(df, window_size, station, hour, value)
    wins = [win for win in ROLL_WINDOWS if win <= window_size]
    if not wins:
        return df
    x = F.col(value).cast("bigint")
    w = _series_window(station, hour)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    tmp = df.withColumns({"_rn": F.row_number().over(w), "_s1": F.sum(x).over(upto),
                          "_s2": F.sum(x * x).over(upto), "_m1": x})
    levels, span = {1: "_m1"}, 1
    while span * 2 <= max(wins):
        prev, span = levels[span], span * 2
        levels[span] = f"_m{span}"
        tmp = tmp.withColumn(levels[span], F.greatest(F.col(prev), F.lag(prev, span // 2).over(w)))
    cols = {}
    for win in wins:
        m = F.least(F.col("_rn"), F.lit(win)).cast("double")
        a = (F.col("_s1") - F.coalesce(F.lag("_s1", win).over(w), F.lit(0))).cast("double")
        q = (F.col("_s2") - F.coalesce(F.lag("_s2", win).over(w), F.lit(0))).cast("double")
        top = 1 << (win.bit_length() - 1)
        mx = F.col(levels[top])
        if win > top:
            mx = F.greatest(mx, F.lag(levels[top], win - top).over(w))
        var = F.try_divide(m * q - a * a, m * (m - F.lit(1.0)))
        cols[f"rolling_mean_{win}h"] = a / m
        cols[f"rolling_max_{win}h"] = mx.cast("double")
        cols[f"rolling_std_{win}h"] = F.coalesce(F.sqrt(F.greatest(var, F.lit(0.0))), F.lit(0.0))
    return tmp.withColumns(cols).drop("_rn", "_s1", "_s2", *levels.values())


def _rolling_moments(df: DataFrame, window_size: int, station: str, hour: str, value: str) -> DataFrame:
    """W2-W4 for any number type, by one doubling table of mergeable moments.

    Level k holds (count, mean, sum of squared deviations, max) of the last k rows; level 2k merges it
    with the level k of the row k back.  A window is the merge of the levels of its binary digits (672 = 512
    + 128 + 32).  Nothing is ever subtracted from a running total, so values of very different sizes do not
    cancel, and a NaN or an infinity only reaches the windows that hold it.  Nulls are skipped.
    """
    wins = [win for win in ROLL_WINDOWS if win <= window_size]
    if not wins:
        return df
    w = _series_window(station, hour)
    x = F.col(value).cast("double")
    zero = F.lit(0.0)
    parts = ("n", "mean", "dev", "max")

    def merged(a: dict, b: dict) -> dict:
        """Moments of two runs of rows; b's are null before the series starts."""
        nb, mean_b = F.coalesce(b["n"], zero), F.coalesce(b["mean"], zero)
        n = a["n"] + nb
        apart = mean_b - a["mean"]
        both = (a["n"] > 0) & (nb > 0)
        return {"n": n, "max": F.greatest(a["max"], b["max"]),
                "mean": F.when(both, a["mean"] * (a["n"] / n) + mean_b * (nb / n)).when(nb > 0, mean_b).otherwise(a["mean"]),
                "dev": a["dev"] + F.coalesce(b["dev"], zero) + F.when(both, apart * apart * (a["n"] * nb / n)).otherwise(zero)}

    def level(k: int, back: int = 0) -> dict:
        return {p: F.lag(f"_{p}{k}", back).over(w) if back else F.col(f"_{p}{k}") for p in parts}

    here = x.isNotNull()
    out = df.withColumns({"_n1": F.when(here, F.lit(1.0)).otherwise(zero), "_mean1": F.coalesce(x, zero),
                          "_dev1": F.when(here, x - x).otherwise(zero), "_max1": x})
    spans = [1]
    while spans[-1] * 2 <= max(wins):
        k = spans[-1]
        out = out.withColumns({f"_{p}{2 * k}": c for p, c in merged(level(k), level(k, k)).items()})
        spans.append(2 * k)
    cols, spare = {}, []
    for win in wins:
        back, so_far = 0, None
        for k in reversed(spans):
            if win & k:
                part = level(k, back)
                if so_far is not None:                       # a column each, so that expressions stay short
                    step = merged(so_far, part)
                    out = out.withColumns({f"_{p}w{win}_{k}": c for p, c in step.items()})
                    part = {p: F.col(f"_{p}w{win}_{k}") for p in parts}
                    spare += [f"_{p}w{win}_{k}" for p in parts]
                so_far, back = part, back + k
        cols[f"rolling_mean_{win}h"] = F.when(so_far["n"] > 0, so_far["mean"]).otherwise(zero)
        cols[f"rolling_max_{win}h"] = F.coalesce(so_far["max"], zero)
        cols[f"rolling_std_{win}h"] = F.when(so_far["n"] > 1, F.sqrt(so_far["dev"] / (so_far["n"] - 1))).otherwise(zero)
    return out.withColumns(cols).drop(*[f"_{p}{k}" for p in parts for k in spans], *spare)


def full_features(series: DataFrame, window_size: int = DEFAULT_WINDOW_SIZE,
                  fast: bool = True) -> DataFrame:
    """3 keys/target + 15 calendar + 12 lags + 9 rolling = 39 columns.

    Every window below is partitioned by the station: a series built by
    ``dense_grid`` already is, so no exchange is added (an unpartitioned input
    gets exactly one), and the windows only add local sorts.
    The rolling and lag windows run first, on the narrow (hour, station,
    rides) rows; the calendar columns are plain projections added last.
    """
    out = (rolling_features(series, window_size) if fast
           else rolling_features_naive(series, window_size))
    out = lag_features(out, window_size)
    out = time_features(out, "pickup_hour")
    return fill_null_zero(out).select(*full_feature_names(window_size))


def fill_null_zero(df: DataFrame) -> DataFrame:
    """Nulls -> 0 in every column whose name contains ``lag`` or ``rolling``."""
    cols = [c for c in df.columns if "lag" in c or "rolling" in c]
    return df.fillna(0, subset=cols) if cols else df


def project_baseline(features: DataFrame) -> DataFrame:
    """The 5-column baseline set."""
    return features.select(*BASELINE_COLUMNS)


def project_reduced(features: DataFrame, selected: list[str]) -> DataFrame:
    """P5: keys + target + selected features, in their original column order."""
    keep = set(selected)
    return features.select(*KEY_COLUMNS, *[c for c in features.columns
                                           if c in keep and c not in KEY_COLUMNS])
