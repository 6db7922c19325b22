"""Training and inference pipelines (M4 run_training_pipeline, M11 run_forecast).

Training reads the stored feature sets, fits, and writes models, scored test rows and metrics
under one folder; everything downstream (scoring, serving, forecasts) loads from there.  The folder's
name holds a fingerprint of the input files, so changed input is trained anew and unchanged input is not.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import inspect

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import time_features
from ..operators import features, series, sparse
from ..operators import models as MD
from ..operators import prep as PR
from ..operators import recursive as RC
from ..session import materialize, scratch_path, shared_dir
from ..sinks.writers import append_metrics_history, write_forecast, write_metrics, write_table
from ..sources.feature_files import path_exists, scan_feature_sets, scan_forecast
from . import pipelines
from .pipelines import run_features

SET_OF = {"baseline": "baseline_features", "full": "full_features", "reduced": "reduced_features"}
SCORED_DDL = "pickup_hour TIMESTAMP_NTZ, start_station_id STRING, rides BIGINT, prediction DOUBLE"
METRICS_DDL = "model_name STRING, mae DOUBLE, timestamp STRING, model_type STRING"
RUN_AT = dt.datetime(2024, 4, 1)


def preprocess_pair(train: DataFrame, test: DataFrame):
    """C12 + C13 on a train/test pair.  The test side keeps text copies of its
    keys (``_h``, ``_station``) so predictions can be joined back; text
    columns outside the encoded list pass through untouched."""
    test = test.withColumns({"_h": F.col("pickup_hour").cast("string"),
                             "_station": F.col("start_station_id")})
    tr, te = PR.expand_datetime(train), PR.expand_datetime(test)
    return PR.label_encode(tr, te, ["start_station_id"])


def keyed_predictions(scored: DataFrame) -> DataFrame:
    return scored.select(F.col("_h").cast("timestamp_ntz").alias("pickup_hour"),
                         F.col("_station").alias("start_station_id"), "rides", "prediction")


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of names, lengths and modification times of a table's files, in folders of any depth, and of the
    code that prepares and fits: other data or other code is trained anew."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    states = []
    while files.hasNext():
        s = files.next()
        states.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    code = "".join(inspect.getsource(m) for m in (MD, PR, features, series, sparse, pipelines))
    return hashlib.md5("\n".join([*sorted(states), code, inspect.getsource(train_and_store)]).encode()).hexdigest()[:16]


def train_and_store(spark: SparkSession, sf_dir: str, root: str, top_n: int = 3) -> None:
    """M4: features (M12) -> stored sets -> time split -> three fits -> models (M5), scored test
    rows, metrics (K4) and their history (K5) under ``root``.  ``root/done`` is written last."""
    sets = run_features(spark, sf_dir, root, top_n)["sets"]
    trainers = {"baseline": MD.BaselinePredictor(labelCol="rides").fit, "full": MD.train_full, "reduced": MD.train_reduced}
    scored = {}
    for name, fit in trainers.items():
        train, test = preprocess_pair(*PR.train_test(sets[SET_OF[name]]))
        train.write.parquet(f"{root}/prepared/{name}")
        model = fit(spark.read.schema(train.schema).parquet(f"{root}/prepared/{name}"))
        model.write().overwrite().save(f"{root}/models/{name}")
        keyed_predictions(model.transform(test)).write.parquet(f"{root}/scored/{name}")
        scored[name] = spark.read.schema(SCORED_DDL).parquet(f"{root}/scored/{name}")
    metrics = MD.mae(MD.predictions_long(scored))
    write_metrics([MD.metrics_rows(metrics, f"{RUN_AT:%Y-%m-%d %H:%M:%S}")], f"{root}/metrics")
    append_metrics_history(read_metrics(spark, root), f"{root}/history", RUN_AT, root.rsplit("/", 1)[-1])
    write_table(read_metrics(spark, root), f"{root}/done", "parquet")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    return (spark.read.schema(METRICS_DDL).option("header", True).csv(f"{root}/metrics")
            .select("model_name", "mae"))


def trained(spark: SparkSession, sf_dir: str, top_n: int = 3) -> str:
    """Folder of the stored training of this input; trains only when there is none."""
    mark = input_fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    root = f"{shared_dir(spark).rstrip('/')}/training-{top_n}-{mark}"
    if not path_exists(spark, f"{root}/done/_SUCCESS"):
        if path_exists(spark, root):   # a run that did not end: its files are left alone
            root = scratch_path(spark, f"training-{top_n}-{mark}")
        train_and_store(spark, sf_dir, root, top_n)
    return root


def load_sets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return scan_feature_sets(spark, {n: [(f"{root}/sets/{n}/latest", "parquet")] for n in SET_OF.values()})


def load_scored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCORED_DDL).parquet(f"{root}/scored/{name}")


def load_model(root: str, name: str):
    path = f"{root}/models/{name}"
    return MD.BaselineModel.load(path) if name == "baseline" else PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def best_model_name(spark: SparkSession, root: str) -> str:
    return MD.best_model(read_metrics(spark, root)).first()["best_model"]  # one row


def serving_spec(spark: SparkSession, root: str, name: str, mode: str = "serve", refresh_every: int = 1) -> dict:
    """The recursion's settings for a stored model, with the feature names it was trained on."""
    model = load_model(root, name)
    if name == "baseline":
        return RC.serve_spec({"kind": "constant", "value": model.getOrDefault(model.trainMean)}, [], mode, refresh_every)
    trees = RC.export_trees(spark, model.stages[-1], scratch_path(spark, "gbt"))
    names = model_features(model)
    return RC.serve_spec(trees, names, mode, refresh_every, names)


def train_ten_lags(spark: SparkSession, history: DataFrame) -> PipelineModel:
    """A tree model over the M8 feature names: the ten values before each hour, its calendar and the station."""
    w = Window.partitionBy("start_station_id").orderBy("pickup_hour")
    lags = {f"rides_lag_{k}": F.lag("rides", k).over(w).cast("double") for k in range(1, 11)}
    rows = time_features(history, "pickup_hour").withColumns(lags).where(F.col("rides_lag_10").isNotNull())
    rows = (rows.withColumnRenamed("start_station_id", "_name")
            .join(RC.station_codes(history).withColumnRenamed("start_station_id", "_name"), "_name")
            .withColumn("start_station_id", F.col("code")).select("rides", *RC.M8_FEATURES))
    params = MD.REDUCED_PARAMS | {"maxIter": 30}
    return MD.tree_pipeline(list(RC.M8_FEATURES), params).fit(materialize(rows, "ten-lags"))


def run_forecast(spark: SparkSession, sf_dir: str, now: dt.datetime, days: int = 90,
                 out_path: str | None = None, model: str | None = None) -> DataFrame:
    """Loads the stored sets and the best stored model (or ``model``), forecasts every hour of
    [floor(now) + 1 h, + days), writes ``latest`` and a stamped copy and returns the forecast read back."""
    root = trained(spark, sf_dir)
    full = load_sets(spark, root)["full_features"]
    start = now.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    hours = RC.hourly_range(start, start + dt.timedelta(days=days) - dt.timedelta(hours=1))
    spec = serving_spec(spark, root, model or best_model_name(spark, root))
    fc = RC.recursive_forecast(spark, full, hours, spec, 672, RC.station_codes(full))
    path = out_path or scratch_path(spark, "forecast-run")
    write_forecast(fc, path, now.strftime("%Y%m%d_%H%M%S"))
    return scan_forecast(spark, f"{path}/latest", "csv")
