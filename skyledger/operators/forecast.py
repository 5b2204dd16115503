"""Baseline forecasters, their evaluation, promotion of models, chronological splits."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .baselines import exact_percentiles
from .facts import r6

KEYS = ["location_id", "pollutant"]


def shifted(targets: DataFrame, series: DataFrame, minutes: int) -> DataFrame:
    """The series' value ``minutes`` before each target: an equi-join on the shifted hour."""
    past = series.select(*KEYS, (F.col("hour_start") + F.expr(f"interval {minutes} minutes")).alias("hour_start"), F.col("value").alias("prediction"))
    out = targets.join(past, [*KEYS, "hour_start"], "left")
    return out.withColumn("confidence", F.when(F.col("prediction").isNotNull(), "high").otherwise("low"))


def naive(targets: DataFrame, series: DataFrame, horizon_minutes: int = 60) -> DataFrame:
    return shifted(targets, series, horizon_minutes)


def same_hour_yesterday(targets: DataFrame, series: DataFrame) -> DataFrame:
    return shifted(targets, series, 24 * 60)


def rolling_mean(targets: DataFrame, series: DataFrame, days: int = 7) -> DataFrame:
    """Mean of the same hour over the last days; confidence by how many of them have a value."""
    asked = targets.select(*KEYS, "hour_start", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("back")).withColumn("past", F.col("hour_start") - F.make_dt_interval(F.col("back")))
    past = series.where("value is not null").select(*KEYS, F.col("hour_start").alias("past"), "value")
    share = F.count("value") / F.lit(float(days))
    level = F.when(share >= 0.9, "high").when(share >= 0.7, "medium").otherwise("low")
    return asked.join(past, [*KEYS, "past"], "left").groupBy(*KEYS, "hour_start").agg(r6(F.avg("value")).alias("prediction"), level.alias("confidence"), F.count("value").alias("days_used"))


def evaluate(pairs: DataFrame) -> DataFrame:
    """MAE, RMSE and count over pairs (actual, prediction) without nulls."""
    error = F.col("actual") - F.col("prediction")
    ok = pairs.where("actual is not null and prediction is not null")
    return ok.agg(r6(F.avg(F.abs(error))).alias("mae"), r6(F.sqrt(F.avg(error * error))).alias("rmse"), F.count(F.lit(1)).alias("valid_count"))


def evaluate_model(pairs: DataFrame) -> DataFrame:
    """Also the median absolute error and MAPE, in which actuals near zero count as no error."""
    ok = pairs.where("actual is not null and prediction is not null and not isnan(actual) and not isnan(prediction)")
    error = F.abs(F.col("actual") - F.col("prediction"))
    part = F.when(F.abs("actual") > 1e-10, error / F.abs("actual")).otherwise(0.0)
    some = F.max(F.abs("actual")) > 1e-10
    means = ok.agg(r6(F.avg(error)).alias("mae"), r6(F.sqrt(F.avg(error * error))).alias("rmse"), r6(F.when(some, F.avg(part) * 100)).alias("mape"), F.count(F.lit(1)).alias("n"), F.lit(0).alias("_one"))
    middle = exact_percentiles(ok.select(error.alias("_e")), [], "_e", (0.5,)).select(r6(F.col("p")[0]).alias("median_ae"), F.lit(0).alias("_one"))
    return means.join(middle, "_one", "left").select("mae", "rmse", "median_ae", "mape", "n")


def residual_interval(pairs: DataFrame) -> DataFrame:
    residual = F.col("actual") - F.col("prediction")
    known = pairs.where("actual is not null and prediction is not null").select(residual.alias("_r"), F.lit(0).alias("_one"))
    ends = exact_percentiles(known, ["_one"], "_r", (0.05, 0.95)).select("_one", r6(F.col("p")[0]).alias("low"), r6(F.col("p")[1]).alias("high"))
    return known.agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("_one")).join(ends, "_one", "left").select("low", "high", "n")


def interval(prediction: Column, low: Column, high: Column, n: Column) -> dict[str, Column]:
    """Bounds and confidence: residual percentiles with ten residuals or more, else a tenth either way."""
    enough = n >= 10
    width = high - low
    return {
        "lower": r6(F.when(enough, prediction + low).otherwise(prediction * 0.9)), "upper": r6(F.when(enough, prediction + high).otherwise(prediction * 1.1)),
        "interval_confidence": r6(F.when(enough, F.greatest(F.lit(0.1), F.least(F.lit(0.9), 1 - width / 100))).otherwise(0.5)),
    }


def best_model(scores: DataFrame) -> DataFrame:
    return scores.where("mae is not null").agg(F.min_by("model", F.struct("mae", "model")).alias("model"), F.coalesce(F.min("mae"), F.lit(float("inf"))).alias("mae"))


def threshold(mae: Column, pct: float) -> Column:
    return F.when(mae.isNull() | (mae <= 0), float("inf")).otherwise(mae * (1 - pct / 100))


def promotes(current: Column, candidate: Column, least_pct: float = 5.0) -> Column:
    """Whether a candidate's error is at least so much lower; no usable current model promotes."""
    none = current.isNull() | (current <= 0)
    return F.when(none, True).otherwise(F.coalesce((current - candidate) / F.when(none, 1.0).otherwise(current) * 100 >= least_pct, F.lit(False)))


def chronological_split(start: date, end: date) -> dict[str, tuple[date, date]]:
    """Closed ranges of 70, 15 and the remaining percent of the days, truncated in floating point."""
    if start >= end:
        raise ValueError("start must be before end")
    days = (end - start).days + 1
    train, validation = int(days * 0.7), int(days * 0.15)
    at = lambda n: start + timedelta(days=n)
    return {"train": (start, at(train - 1)), "validation": (at(train), at(train + validation - 1)), "test": (at(train + validation), end)}


def with_split(df: DataFrame, day: Column, split: dict[str, tuple[date, date]]) -> DataFrame:
    label = F.lit(None).cast("string")
    for name, (low, high) in split.items():
        label = F.when(day.between(F.lit(low), F.lit(high)), name).otherwise(label)
    return df.withColumn("split", label)


def walk_forward(bounds: DataFrame, window_days: int = 30, step_days: int = 7) -> DataFrame:
    """Folds with an expanding training range and a test range of ``step_days``, the last one clipped; ``bounds`` has start and end."""
    folds = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.datediff("end", "start") + 1 - window_days) / step_days).cast("int")))
    out = bounds.withColumn("fold", F.explode(folds)).withColumn("test_start", F.date_add("start", F.lit(window_days) + F.col("fold") * step_days)).where(F.col("test_start") <= F.col("end"))
    return out.select("fold", F.col("start").alias("train_start"), F.date_sub("test_start", 1).alias("train_end"), "test_start", F.least(F.date_add("test_start", step_days - 1), F.col("end")).alias("test_end"))
