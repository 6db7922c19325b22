"""Recursive multi-step forecasts.

Layout of the Spark job:

1. each station's newest W values become one row holding an array (W8 +
   a ``collect_list`` bounded by W per station);
2. those rows are hash-partitioned by station over an explicit number of
   partitions (AQE would otherwise merge the small input into one task,
   although the output is H times larger);
3. ``mapInPandas`` advances every station of an Arrow batch together, hour by
   hour, with numpy: features for all stations, one vectorised tree walk, the
   predictions pushed into the history arrays.

A fitted boosted-tree model is exported once from its saved node table into
flat numpy arrays (a few MB for 100 trees of depth 8) and shipped to the
tasks as a broadcast variable.  The kernel functions of this module are
pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark import cloudpickle as _cp

_cp.register_pickle_by_value(sys.modules[__name__])

OUTPUT_SCHEMA = "start_station_id string, pickup_hour timestamp_ntz, predicted_rides double"
STATION_BATCH = 256


# --- model export -------------------------------------------------------------
def export_trees(spark: SparkSession, gbt_model, path: str) -> dict:
    """Flatten a fitted GBTRegressionModel into numpy arrays (global node ids).

    Reads the saved node table (treeID, nodeData{id, prediction, leftChild,
    rightChild, split{featureIndex, leftCategoriesOrThreshold}}); its size is
    bounded by the model, not by the data.
    """
    gbt_model.write().overwrite().save(path)
    rows = (spark.read.parquet(f"{path}/data")
            .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild",
                    "nodeData.rightChild", "nodeData.split.featureIndex",
                    F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("thr"))
            .toPandas())
    rows = rows.sort_values(["treeID", "id"]).reset_index(drop=True)
    n_trees = int(rows.treeID.max()) + 1
    sizes = rows.groupby("treeID").size().reindex(range(n_trees)).to_numpy()
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    off = offsets[rows.treeID.to_numpy()]
    leaf = rows.leftChild.to_numpy() < 0
    gid = np.arange(len(rows))
    left = np.where(leaf, gid, rows.leftChild.to_numpy() + off)
    right = np.where(leaf, gid, rows.rightChild.to_numpy() + off)
    return {
        "kind": "trees",
        "roots": offsets,
        "weights": np.asarray(gbt_model.treeWeights, dtype=np.float64),
        "feature": np.where(leaf, 0, rows.featureIndex.fillna(0).to_numpy()).astype(np.int64),
        "threshold": rows.thr.fillna(0.0).to_numpy(dtype=np.float64),
        "left": left.astype(np.int64), "right": right.astype(np.int64),
        "value": rows.prediction.to_numpy(dtype=np.float64),
        "depth": int(gbt_model.getMaxDepth()),
    }


def predict_trees(m: dict, X: np.ndarray) -> np.ndarray:
    """Sum of weighted tree outputs; go left when x[feature] <= threshold.  All trees step together."""
    rows = np.arange(X.shape[0])[:, None]
    idx = np.tile(m["roots"], (X.shape[0], 1))
    for _ in range(m["depth"]):
        go_left = X[rows, m["feature"][idx]] <= m["threshold"][idx]
        idx = np.where(go_left, m["left"][idx], m["right"][idx])
    return m["value"][idx] @ m["weights"]


def predict(m: dict | None, X: np.ndarray) -> np.ndarray:
    if m["kind"] == "trees":
        return predict_trees(m, X)
    if m["kind"] == "lag_mean":
        return X.mean(axis=1)
    if m["kind"] == "constant":
        return np.full(X.shape[0], m["value"])
    raise ValueError(f"unknown model kind {m['kind']}")


# --- serving features (C22) -------------------------------------------------------
def _calendar(ts: dt.datetime, mode: str) -> dict[str, float]:
    dow = ts.weekday()
    weekend = dow >= 5
    if mode == "serve":
        morning, evening = 7 <= ts.hour <= 9, 16 <= ts.hour <= 19
    else:
        morning = 7 <= ts.hour <= 9 and not weekend
        evening = 17 <= ts.hour <= 19 and not weekend
    epoch = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
    v = {
        "hour": ts.hour, "day_of_week": dow, "day_of_month": ts.day,
        "week_of_year": ts.isocalendar()[1], "month": ts.month, "year": ts.year,
        "is_weekend": int(weekend), "is_morning_rush": int(morning), "is_evening_rush": int(evening),
        "pickup_hour_hour": ts.hour, "pickup_hour_day": ts.day, "pickup_hour_month": ts.month,
        "pickup_hour_year": ts.year, "pickup_hour_dayofweek": dow, "pickup_hour_timestamp": epoch,
        "hour_sin": math.sin(2 * math.pi * ts.hour / 24), "hour_cos": math.cos(2 * math.pi * ts.hour / 24),
        "day_sin": math.sin(2 * math.pi * dow / 7), "day_cos": math.cos(2 * math.pi * dow / 7),
        "month_sin": math.sin(2 * math.pi * ts.month / 12), "month_cos": math.cos(2 * math.pi * ts.month / 12),
    }
    return {k: float(x) for k, x in v.items()}


class SlidingStats:
    """Mean, deviation and maximum of the newest ``win`` values of n lines, at a cost a step that does not depend on ``win``.

    The window is a suffix of a block of ``win`` old values and all values pushed since.  Suffix sums and suffix
    maxima of the block are made once in ``win`` pushes; the new values only add.  Nothing is subtracted, so sums do
    not drift, and squares are taken about the block's mean."""

    def __init__(self, line: np.ndarray, end: int, win: int):
        self.line, self.win = line, win
        self.rebuild(end)

    def rebuild(self, end: int) -> None:
        block = self.line[:, end - self.win:end]
        self.end, self.new = end, 0
        self.shift = block.mean(axis=1)
        d = (block - self.shift[:, None])[:, ::-1]
        zero = np.zeros((len(block), 1))
        self.sums = np.hstack([zero, np.cumsum(d, axis=1)])[:, ::-1]            # of the newest win - t values of the block
        self.squares = np.hstack([zero, np.cumsum(d * d, axis=1)])[:, ::-1]
        self.tops = np.hstack([zero - np.inf, np.maximum.accumulate(block[:, ::-1], axis=1)])[:, ::-1]
        self.added, self.added_squares, self.top = np.zeros(len(block)), np.zeros(len(block)), np.full(len(block), -np.inf)

    def move(self, end: int) -> None:
        """The window now ends before column ``end`` of the line."""
        for at in range(self.end, end):
            if self.new == self.win:
                self.rebuild(at)
            value = self.line[:, at]
            d = value - self.shift
            self.added, self.added_squares = self.added + d, self.added_squares + d * d
            self.top = np.maximum(self.top, value)
            self.new, self.end = self.new + 1, at + 1

    def mean(self) -> np.ndarray:
        return self.shift + (self.sums[:, self.new] + self.added) / self.win

    def max(self) -> np.ndarray:
        return np.maximum(self.tops[:, self.new], self.top)

    def std(self, ddof: int) -> np.ndarray:
        if self.win <= ddof:
            return np.zeros(len(self.shift))
        total, squares = self.sums[:, self.new] + self.added, self.squares[:, self.new] + self.added_squares
        return np.sqrt(np.maximum(0.0, squares - total * total / self.win) / (self.win - ddof))


def rolling_windows(names, line: np.ndarray, end: int, width: int) -> dict[int, SlidingStats]:
    """The windows that rolling columns ask for (by their hours), no wider than the history."""
    hours = {int(n.split("_")[2][:-1]) for n in names if n.startswith("rolling_")}
    return {h: SlidingStats(line, end, min(h, width)) for h in hours}


def _history_features(names, R: np.ndarray, mode: str, windows: dict[int, SlidingStats] | None = None) -> dict[str, np.ndarray]:
    """Lag / rolling / rides_t-k columns from newest-first history R [n, W]; ``windows`` holds the rolling state."""
    out = {}
    W = R.shape[1]
    if windows is None:
        windows = rolling_windows(names, R[:, ::-1], W, W)
    for name in names:
        if name.startswith("rides_lag_") and name.endswith("h"):
            k = int(name[len("rides_lag_"):-1])
            out[name] = R[:, min(k - 1, W - 1)]
        elif name.startswith("rides_lag_"):
            k = int(name[len("rides_lag_"):])
            out[name] = R[:, k - 1] if k - 1 < W else np.zeros(R.shape[0])
        elif name.startswith("rides_t-"):
            k = int(name[len("rides_t-"):])
            out[name] = R[:, k - 1] if k - 1 < W else np.zeros(R.shape[0])
        elif name.startswith("rolling_"):
            _, stat, win = name.split("_")
            window = windows[int(win[:-1])]
            out[name] = window.std(0 if mode == "serve" else 1) if stat == "std" else getattr(window, stat)()
    return out


def feature_matrix(names, R, codes, ts, mode, windows=None) -> np.ndarray:
    cal = _calendar(ts, mode)
    hist = _history_features(names, R, mode, windows)
    n = R.shape[0]
    cols = []
    for name in names:
        if name in hist:
            cols.append(hist[name])
        elif name in cal:
            cols.append(np.full(n, cal[name]))
        elif name == "start_station_id":
            cols.append(codes.astype(np.float64))
        else:
            raise KeyError(name)
    return np.column_stack(cols) if cols else np.zeros((n, 0))


def pattern_fallback_values(ts: dt.datetime, n: int, base: float = 5.0) -> np.ndarray:
    """C15 for one hour, all stations."""
    weekend = 0.7 if ts.weekday() >= 5 else 1.0
    return np.full(n, base * (0.7 + 0.6 * ((ts.hour % 12) / 12.0) * weekend))


def run_recursion(R: np.ndarray, codes: np.ndarray, hours, spec: dict) -> np.ndarray:
    """Predictions [n, H]: one step per hour, clamped at 0, pushed into the history.

    ``refresh_every`` > 1 freezes the history inside blocks of that many hours
    and appends the block's predictions at its end.  A model that cannot take the
    rows is an error, unless the spec allows the pattern fallback (C15).
    """
    model, names, mode, fallback = spec["model"], spec["features"], spec["mode"], spec.get("fallback", False)
    trained_on = spec.get("model_features")
    if trained_on is not None and list(trained_on) != list(names):
        if not fallback:
            raise ValueError(f"the model was trained on other features than {list(names)}")
        model = None
    every = max(1, int(spec.get("refresh_every", 1)))
    n, H = R.shape[0], len(hours)
    W = R.shape[1]
    line = np.empty((n, W + H))   # history and predictions, oldest first; R is a view of its newest W
    line[:, :W] = R[:, ::-1]
    preds, end = line[:, W:], W
    windows = rolling_windows(names, line, end, W)
    for h, ts in enumerate(hours):
        try:
            if model is None:
                raise KeyError("no model")
            y = predict(model, feature_matrix(names, R, codes, ts, mode, windows))
        except (KeyError, ValueError, IndexError):
            if not fallback:
                raise
            y = pattern_fallback_values(ts, n)
        preds[:, h] = np.maximum(0.0, y)
        if W + h + 1 - end == every:
            end = W + h + 1
            R = line[:, end - W:end][:, ::-1]
            for window in windows.values():
                window.move(end)
    return preds


def _kernel_factory(spec_bc, hours):
    def kernel(batches):
        spec = spec_bc.value
        idx = pd.DatetimeIndex(hours)
        for pdf in batches:
            for s in range(0, len(pdf), STATION_BATCH):
                part = pdf.iloc[s:s + STATION_BATCH]
                R = np.vstack(part["hist"].to_numpy()).astype(np.float64)
                codes = part["code"].to_numpy()
                preds = run_recursion(R, codes, hours, spec)
                yield pd.DataFrame({
                    "start_station_id": np.repeat(part["start_station_id"].to_numpy(), len(hours)),
                    "pickup_hour": np.tile(idx.values, len(part)),
                    "predicted_rides": preds.reshape(-1),
                })
    return kernel


# --- Spark side ------------------------------------------------------------------
def history_arrays(history: DataFrame, window_size: int, codes: DataFrame | None = None,
                   hour: str = "pickup_hour", value: str = "rides") -> DataFrame:
    """One row per station with >= W rows: (station, code, hist newest-first [W]).

    The newest W rows are picked with a window, then gathered by a grouped
    ``collect_list`` whose size is bounded by W.
    """
    from .prep import recent_history
    recent = recent_history(history.select("start_station_id", hour, value), window_size, hour)
    arr = (recent.groupBy("start_station_id")
           .agg(F.sort_array(F.collect_list(F.struct(F.col("_age"), F.col(value).cast("double").alias("v"))))
                .alias("_s"))
           .select("start_station_id", F.col("_s.v").alias("hist")))
    if codes is not None:
        arr = arr.join(codes, "start_station_id", "left")
    else:
        arr = arr.withColumn("code", F.lit(-1))
    return arr.withColumn("code", F.coalesce(F.col("code"), F.lit(-1)).cast("long"))


def recursive_forecast(spark: SparkSession, history: DataFrame, hours, spec: dict,
                       window_size: int, codes: DataFrame | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """M6/M7/M8: (start_station_id, pickup_hour, predicted_rides) for every hour in ``hours``."""
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrays = history_arrays(history, window_size, codes).repartition(n, "start_station_id")
    spec_bc = spark.sparkContext.broadcast(spec)
    hours = list(hours)
    return arrays.mapInPandas(_kernel_factory(spec_bc, hours), OUTPUT_SCHEMA)


def hourly_range(start: dt.datetime, end: dt.datetime) -> list[dt.datetime]:
    """C14 on the driver side (the horizon is a parameter, not data)."""
    out, t = [], start
    while t <= end:
        out.append(t)
        t += dt.timedelta(hours=1)
    return out


def station_codes(train: DataFrame, col: str = "start_station_id") -> DataFrame:
    """Station -> 0-based rank among the sorted training stations (C13 dictionary)."""
    from .prep import category_codes
    return category_codes(train, col).select(F.col("_cat").alias(col), F.col("_code").alias("code"))


def serve_spec(model: dict | None, feature_names: list[str], mode: str = "serve",
               refresh_every: int = 1, model_features: list[str] | None = None, fallback: bool = False) -> dict:
    """Kernel settings.  ``model_features``: the names the model was trained on; when they differ
    from ``feature_names``, or a row cannot be built, that is an error -- or, with ``fallback``, the
    cell takes the C15 pattern."""
    return {"model": model, "features": list(feature_names), "mode": mode,
            "refresh_every": refresh_every, "fallback": fallback,
            "model_features": None if model_features is None else list(model_features)}


def fixed_range_hours(months: int = 4, start: dt.datetime = dt.datetime(2025, 2, 1)) -> list[dt.datetime]:
    """M8 horizon: from Feb 1 2025 for ``months`` months, last day 23:00."""
    y, m = start.year, start.month + months - 1
    y, m = y + (m - 1) // 12, (m - 1) % 12 + 1
    nxt = dt.datetime(y + m // 12, m % 12 + 1, 1)
    return hourly_range(start, nxt - dt.timedelta(hours=1))


M8_FEATURES = (["start_station_id", "hour", "day_of_week", "day_of_month", "week_of_year", "month",
                "year", "is_weekend", "is_morning_rush", "is_evening_rush"]
               + [f"rides_lag_{i}" for i in range(1, 11)])


# --- M9: closed form for the mean-of-lags rule -------------------------------------
def recursive_lag_mean(history: DataFrame, window_size: int, horizon: int) -> DataFrame:
    """M9: each step predicts the mean of the previous W values (history, then predictions).

    One row per station; the recursion is JVM-side and goes in blocks of W steps: inside a block the value that
    leaves the window at step i is value i of the previous block, so the state is the running sum and two blocks of W
    values, never a line that grows with the horizon.  No Python, no re-summing.
    """
    arr = history_arrays(history, window_size).select(
        "start_station_id", F.reverse("hist").alias("h"))  # oldest first
    last = history.groupBy("start_station_id").agg(F.max("pickup_hour").alias("_last"))
    w = float(window_size)

    def step(state, leaving):
        mean = state["total"] / F.lit(w)
        return F.struct((state["total"] - leaving + mean).alias("total"),
                        F.concat(state["made"], F.array(mean)).alias("made"))

    def block(state, _):
        """The next W values; the ones before them join the finished blocks."""
        begin = F.struct(state["now"]["total"].alias("total"), F.array().cast("array<double>").alias("made"))
        return F.struct(F.aggregate(state["now"]["made"], begin, step).alias("now"),
                        F.concat(state["blocks"], F.array(state["now"]["made"])).alias("blocks"))

    first = F.struct(F.aggregate("h", F.lit(0.0), lambda s, x: s + x).alias("total"), F.col("h").alias("made"))
    start = F.struct(first.alias("now"), F.array().cast("array<array<double>>").alias("blocks"))
    rounds = -(-horizon // window_size)
    made = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, block,
                       lambda s: F.flatten(F.concat(s["blocks"], F.array(s["now"]["made"]))))
    steps = arr.select("start_station_id",      # the first block is the history itself
                       F.posexplode(F.slice(made, window_size + 1, horizon)).alias("step", "predicted_rides"))
    return (steps.join(last, "start_station_id")
            .select("start_station_id",
                    (F.col("_last") + F.make_dt_interval(hours=F.col("step") + 1)).alias("pickup_hour"),
                    "predicted_rides"))
