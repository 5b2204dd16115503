"""Training and prediction with Spark ML pipelines."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SETTINGS
from .facts import r6
from .forecast import evaluate_model, interval

PREFIXES = ("lag_", "mean_", "std_", "max_", "pm25_", "temp", "humidity_", "wind_", "hour_", "day_", "month_", "season_", "is_")


class LeakError(ValueError):
    """The target is among the features."""


def select_features(df: DataFrame, target: str) -> list[str]:
    found = [c for c, kind in df.dtypes if c.startswith(PREFIXES) and kind in ("double", "int", "bigint", "float")]
    if target in found:
        raise LeakError(f"{target} is both target and feature")
    return found


def estimator(kind: str, target: str):
    """Depth and number of trees are the defaults of the engine; features are cut into 255 bins, as boosting of histograms does."""
    models = {
        "linear": lambda: LinearRegression(featuresCol="features", labelCol=target, solver="normal"),
        "rf": lambda: RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=100, maxDepth=15, seed=42),
        "hgb": lambda: GBTRegressor(featuresCol="features", labelCol=target, maxDepth=10, maxIter=100, maxBins=255, seed=42),
    }
    if kind not in models:
        raise ValueError(f"unknown model {kind}; known: {', '.join(models)}")
    return models[kind]()


def train(df: DataFrame, target: str, kind: str = "linear", features: list[str] | None = None, small: bool = False) -> PipelineModel:
    names = features or select_features(df, target)
    model = estimator(kind, target)
    if small and kind == "rf":
        model = model.setNumTrees(10).setMaxDepth(5)
    if small and kind == "hgb":
        model = model.setMaxIter(5).setMaxDepth(4)
    rows = df.dropna(subset=[target, *names])
    stages = [VectorAssembler(inputCols=names, outputCol="raw_features", handleInvalid="skip"), population_scaler(rows, names), model]
    return Pipeline(stages=stages).fit(rows)


def population_scaler(rows: DataFrame, names: list[str]) -> StandardScalerModel:
    """Scales by the deviation of the population, not that of a sample; a constant feature is only centred."""
    stats = rows.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(names)), *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names))).first()
    means, spreads = [stats[f"m{i}"] or 0.0 for i in range(len(names))], [stats[f"s{i}"] or 1.0 for i in range(len(names))]
    fitted = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    unit = rows.sparkSession.createDataFrame([(Vectors.dense([m - s / 2**0.5 for m, s in zip(means, spreads, strict=True)]),), (Vectors.dense([m + s / 2**0.5 for m, s in zip(means, spreads, strict=True)]),)], ["raw_features"])
    return fitted.fit(unit)  # two rows, whose sample deviation is the population's of the data


def save(model: PipelineModel, path: str, details: dict) -> None:
    """The fitted pipeline, and its name, target, features and metrics as one row of JSON beside it."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(details, sort_keys=True),)], "details string").coalesce(1).write.mode("overwrite").text(f"{path}/details")


def load(path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(SparkSession.active().read.text(f"{path}/details").first()[0])


def training_metrics(model: PipelineModel, df: DataFrame, target: str) -> DataFrame:
    return evaluate_model(model.transform(df).select(F.col(target).alias("actual"), "prediction"))


def importances(model: PipelineModel) -> dict[str, float]:
    last, names = model.stages[-1], model.stages[0].getInputCols()
    return dict(zip(names, last.featureImportances.toArray().tolist(), strict=True)) if hasattr(last, "featureImportances") else {}


def predictions(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with the model's prediction; null where a feature of the model is null, so that no row is lost."""
    names = model.stages[0].getInputCols()
    known = F.lit(True)
    for c in names:
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    kept = features.withColumns({"_known": known, **{f"_{c}": F.col(c) for c in names}})
    filled = kept.withColumns({c: F.when(F.col("_known"), F.col(c)).otherwise(0) for c in names})
    out = model.transform(filled).withColumn("prediction", F.when(F.col("_known"), F.col("prediction")))
    return out.select(*(F.col(f"_{c}").alias(c) if c in names else F.col(c) for c in features.columns), "prediction")


def predict_horizons(features: DataFrame, models: dict[int, PipelineModel], residuals: dict[int, DataFrame]) -> DataFrame:
    """A row for each target and horizon: its model's value, else the last hour's with a tenth either way, else an error.

    ``models`` and ``residuals`` (low, high, n) are by horizon in minutes; a horizon without a model takes the last hour's value.
    """
    out = None
    own = F.col("lag_1h")
    for minutes in SETTINGS.horizons:
        rows = predictions(models[minutes], features) if minutes in models else features.withColumn("prediction", F.lit(None).cast("double"))
        bounds = residuals[minutes].first() if minutes in residuals else None
        low, high, n = (F.lit(bounds[c] if bounds else None).cast("double") for c in ("low", "high", "n"))
        fitted = F.col("prediction").isNotNull()
        value = F.coalesce("prediction", own)
        method = F.when(fitted, "model").when(own.isNotNull(), "baseline").otherwise("error")
        enough: Column = F.when(fitted, F.coalesce(n, F.lit(0.0))).otherwise(0.0)
        rows = rows.select("location_id", "pollutant", "hour_start", r6(value).alias("prediction"), *(c.alias(name) for name, c in interval(value, low, high, enough).items()), method.alias("method"), F.lit(minutes).alias("horizon_minutes"))
        rows = rows.withColumn("interval_confidence", F.when(F.col("method") != "error", F.col("interval_confidence")))
        out = rows if out is None else out.unionByName(rows)
    return out
