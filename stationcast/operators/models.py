"""Models, evaluation and metrics tables.

Training runs on Spark ML; the boosted-tree hyperparameters are the
reference's (100 trees, learning rate 0.1, depth 8 / 6, seed 42).  Leaf-count
caps have no Spark ML counterpart; depth bounds the trees instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAG_PREFIX = "rides_t-"

# Boosted-tree settings of the full and reduced models.
FULL_PARAMS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 8, "seed": 42}
REDUCED_PARAMS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "seed": 42}


class _BaselineParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "target column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    lagPrefix = Param(Params._dummy(), "lagPrefix", "prefix of lag columns to average",
                      TypeConverters.toString)
    lagCols = Param(Params._dummy(), "lagCols", "explicit lag columns (overrides the prefix)",
                    TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="rides", predictionCol="prediction", lagPrefix=LAG_PREFIX, lagCols=[])

    def _lag_columns(self, df: DataFrame) -> list[str]:
        explicit = self.getOrDefault(self.lagCols)
        if explicit:
            return list(explicit)
        prefix = self.getOrDefault(self.lagPrefix)
        return [c for c in df.columns if c.startswith(prefix)]


class BaselinePredictor(Estimator, _BaselineParams, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the mean of the lag columns; with none, the training mean."""

    def __init__(self, labelCol: str = "rides", predictionCol: str = "prediction",
                 lagPrefix: str = LAG_PREFIX, lagCols: list[str] | None = None):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol, lagPrefix=lagPrefix,
                  lagCols=list(lagCols or []))

    def _fit(self, df: DataFrame) -> "BaselineModel":
        if self._lag_columns(df):   # the training mean is used only where there are no lags
            return self._copyValues(BaselineModel())
        mean = df.agg(F.avg(self.getOrDefault(self.labelCol))).first()[0]  # one scalar
        m = BaselineModel(trainMean=float(mean) if mean is not None else 0.0)
        return self._copyValues(m)


class BaselineModel(Model, _BaselineParams, DefaultParamsReadable, DefaultParamsWritable):
    trainMean = Param(Params._dummy(), "trainMean", "training mean of the target", TypeConverters.toFloat)

    def __init__(self, trainMean: float = 0.0):
        super().__init__()
        self._set(trainMean=trainMean)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self._lag_columns(df)
        out = self.getOrDefault(self.predictionCol)
        if not cols:
            return df.withColumn(out, F.lit(self.getOrDefault(self.trainMean)))
        total = reduce(lambda a, b: a + b, [F.col(f"`{c}`").cast("double") for c in cols])
        return df.withColumn(out, total / F.lit(float(len(cols))))


def tree_pipeline(features: list[str], params: dict, label: str = "rides") -> Pipeline:
    """VectorAssembler + GBTRegressor (M2 / M3)."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", **params)
    return Pipeline(stages=[assembler, gbt])


def feature_columns(df: DataFrame, label: str = "rides") -> list[str]:
    return [c for c in df.columns if c != label]


def train_full(train: DataFrame, label: str = "rides") -> PipelineModel:
    """M2: boosted trees on every feature column."""
    return tree_pipeline(feature_columns(train, label), FULL_PARAMS, label).fit(train)


def train_reduced(train: DataFrame, label: str = "rides") -> PipelineModel:
    """M3: shallower boosted trees on the selected features."""
    return tree_pipeline(feature_columns(train, label), REDUCED_PARAMS, label).fit(train)


def score_batch(model, df: DataFrame) -> DataFrame:
    """Non-recursive scoring (``model.transform``)."""
    return model.transform(df)


def save_model(model: PipelineModel, path: str) -> str:
    """M5: persist (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- evaluation / metrics ----------------------------------------------------
def predictions_long(preds: dict[str, DataFrame], keys=("pickup_hour", "start_station_id"),
                     label: str = "rides", prediction: str = "prediction") -> DataFrame:
    """Union of per-model scored frames: keys, model_name, actual, predicted."""
    frames = [df.select(*keys, F.lit(name).alias("model_name"),
                        F.col(label).cast("double").alias("actual"),
                        F.col(prediction).cast("double").alias("predicted"))
              for name, df in preds.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def mae(scored: DataFrame) -> DataFrame:
    """A10: mean absolute error per model (one grouped aggregate)."""
    return scored.groupBy("model_name").agg(
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"))


def mae_of_columns(scored: DataFrame, models: list[str], label: str = "rides") -> DataFrame:
    """A10 where all predictions are columns of one frame: one pass, one aggregate per model."""
    y = F.col(label).cast("double")
    sums = scored.agg(*[F.avg(F.abs(y - F.col(m).cast("double"))).alias(m) for m in models])
    pairs = ", ".join(f"'{m}', `{m}`" for m in models)
    return sums.selectExpr(f"stack({len(models)}, {pairs}) AS (model_name, mae)")


def rank_models(metrics: DataFrame) -> DataFrame:
    """M4 tail: metrics ranked by MAE (one row per model)."""
    from pyspark.sql.window import Window
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy("mae", "model_name")).cast("int"))


def model_improvement(metrics: DataFrame, baseline: str = "baseline", full: str = "full",
                      reduced: str = "reduced") -> DataFrame:
    """(baseline - full)/baseline*100 and (full - reduced)/full*100 (0 unless full > 0)."""
    p = metrics.groupBy().pivot("model_name", [baseline, full, reduced]).agg(F.first("mae"))
    b, f, r = F.col(baseline), F.col(full), F.col(reduced)
    return p.select(
        ((b - f) / b * 100).alias("baseline_improvement"),
        F.when(f > 0, (f - r) / f * 100).otherwise(F.lit(0.0)).alias("full_model_comparison"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the lowest MAE (ties: first name)."""
    return metrics.agg(F.min_by("model_name", F.struct("mae", "model_name")).alias("best_model"),
                       F.min("mae").alias("mae"))


def metrics_rows(metrics: DataFrame, run_ts: str, improvement: DataFrame | None = None,
                 types: dict[str, str] | None = None) -> DataFrame:
    """K4 content: model_name, mae, timestamp, model_type and the model-specific extras."""
    types = types or {"baseline": "baseline", "full": "full_feature", "reduced": "reduced_feature"}
    mapping = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(v))])
    out = metrics.select("model_name", "mae", F.lit(run_ts).alias("timestamp"),
                         mapping[F.col("model_name")].alias("model_type"))
    if improvement is not None:
        out = out.crossJoin(F.broadcast(improvement)).select(  # one row: bounded broadcast
            "model_name", "mae", "timestamp", "model_type",
            F.when(F.col("model_name") == "full", F.col("baseline_improvement")).alias("baseline_improvement"),
            F.when(F.col("model_name") == "reduced", F.col("full_model_comparison")).alias("full_model_comparison"))
    return out


def union_history(history: DataFrame | None, run: DataFrame) -> DataFrame:
    """L4: metrics history concat (columns missing on either side -> null)."""
    return run if history is None else history.unionByName(run, allowMissingColumns=True)


def compare_models(actual: DataFrame, preds: dict[str, DataFrame], station_id: str | None = None,
                   keys=("pickup_hour", "start_station_id"), label: str = "rides") -> DataFrame:
    """Actual plus one prediction column per model, joined on (station, hour).

    The frames have a row for every station and hour, and their files compress so well that Spark's estimate
    would broadcast them through the driver; the hint makes each of them a sorted shuffle on the keys."""
    out = actual.select(*keys, F.col(label).cast("double").alias("actual"))
    for name, df in preds.items():
        scored = df.select(*keys, F.col("prediction").cast("double").alias(name))
        out = out.join(scored.hint("merge"), list(keys), "left")
    if station_id is not None:
        out = out.where(F.col(keys[1]) == station_id)
    return out
