"""Leak-free features from RANGE frames over the hourly grid: one partitioning and one sort for all of them.

Facts are left-joined to the target hours first, as a target may have no fact of its own. Frames end an hour before the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import season
from .facts import r6

LAGS = (1, 2, 3, 6, 12, 24)
MEANS = (3, 6, 12, 24)
STDS = (6, 24)
WEATHER = ("temperature", "humidity", "wind_speed", "pressure", "wind_direction")
WEATHER_MEANS = ("temperature", "humidity", "wind_speed", "pressure")
FILL_HOURS = 3
VERSION = "1.0.0"


def _frame(keys: list[str], low: int, high: int):
    return Window.partitionBy(*keys).orderBy("epoch").rangeBetween(low * 3600, high * 3600)


def _gridded(targets: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    grid = targets.select(*keys, "hour_start", F.lit(True).alias("is_target")).unionByName(facts.select(*keys, "hour_start").withColumn("is_target", F.lit(False))).groupBy(*keys, "hour_start").agg(F.max("is_target").alias("is_target"))
    return grid.join(facts, [*keys, "hour_start"], "left").withColumn("epoch", F.unix_seconds(F.col("hour_start").cast("timestamp")))


def lag(value: str, keys: list[str], k: int) -> Column:
    return F.max(value).over(_frame(keys, -k, -k))


def lag_filled(value: str, keys: list[str], k: int) -> Column:
    """The value k hours back, else the last one within three hours before that."""
    return F.last(value, ignorenulls=True).over(_frame(keys, -(k + FILL_HOURS), -k))


def pollutant_features(targets: DataFrame, facts: DataFrame, citywide: DataFrame) -> DataFrame:
    """Lags, rolling means, deviations and maximum of each target, with citywide fallbacks and the number imputed."""
    keys = ["location_id", "pollutant"]
    rows = _gridded(targets, facts, keys).join(citywide.select("pollutant", F.col("historical_median").alias("_median"), F.coalesce("p99", "historical_median").alias("_p99")), "pollutant", "left")
    columns: dict[str, Column] = {}
    imputed = F.lit(0)
    for k in LAGS:
        exact, filled = lag("value", keys, k), lag_filled("value", keys, k)
        columns[f"lag_{k}h"] = F.coalesce(filled, F.col("_median"))
        imputed = imputed + F.when(exact.isNull() & F.coalesce(filled, F.col("_median")).isNotNull(), 1).otherwise(0)
    for w in MEANS:
        mean = F.avg("value").over(_frame(keys, -w, -1))
        columns[f"mean_{w}h"] = r6(F.coalesce(mean, F.col("_median")))
        imputed = imputed + F.when(mean.isNull(), 1).otherwise(0)
    for w in STDS:
        frame = _frame(keys, -w, -1)
        columns[f"std_{w}h"] = r6(F.when(F.count("value").over(frame) < 2, 0.0).otherwise(F.stddev_pop("value").over(frame)))
    top = F.max("value").over(_frame(keys, -24, -1))
    columns["max_24h"] = F.coalesce(top, F.col("_p99"))
    imputed = imputed + F.when(top.isNull(), 1).otherwise(0)
    return rows.withColumns({**columns, "imputation_count": imputed}).where("is_target").select(*keys, "hour_start", *columns, "imputation_count")


def citywide_weather(weather: DataFrame) -> DataFrame:
    """One row: the mean of each variable over all places and hours, ``<variable>_mean``."""
    return weather.agg(*(r6(F.avg(v)).alias(f"{v}_mean") for v in WEATHER))


def weather_features(targets: DataFrame, weather: DataFrame, citywide: DataFrame | None = None) -> DataFrame:
    """Weather an hour before (filled up to three hours back) and rolling means over 6 and 24 hours.

    What is missing is the city's mean, if there is one; ``weather_imputation_count`` counts values that aren't the hour's own or the window's.
    """
    keys = ["location_id"]
    rows = _gridded(targets.select("location_id", "hour_start").distinct(), weather, keys)
    fallback = {v: F.lit(None).cast("double") for v in WEATHER}
    if citywide is not None:
        means = citywide.first() or {}
        fallback = {v: F.lit(means[f"{v}_mean"]).cast("double") for v in WEATHER}
    columns: dict[str, Column] = {}
    imputed = F.lit(0)
    for v in WEATHER:
        exact, filled = lag(v, keys, 1), F.coalesce(lag_filled(v, keys, 1), fallback[v])
        columns[f"{v}_lag_1h"] = filled
        imputed = imputed + F.when(exact.isNull() & filled.isNotNull(), 1).otherwise(0)
    for v in WEATHER_MEANS:
        for w in (6, 24):
            mean = r6(F.avg(v).over(_frame(keys, -w, -1)))
            columns[f"{v}_mean_{w}h"] = F.coalesce(mean, fallback[v])
            if citywide is not None:
                imputed = imputed + F.when(mean.isNull(), 1).otherwise(0)
    out = rows.withColumns({**columns, "weather_imputation_count": imputed}).where("is_target").select(*keys, "hour_start", *columns, "weather_imputation_count")
    angle = F.col("wind_direction_lag_1h") * F.pi() / 180
    return out.withColumns({"wind_x": r6(F.sin(angle)) + 0.0, "wind_y": r6(F.cos(angle)) + 0.0})


def calendar(hour: Column) -> dict[str, Column]:
    return {
        "hour_of_day": F.hour(hour), "day_of_week": F.weekday(hour), "month": F.month(hour), "day_of_year": F.dayofyear(hour),
        "is_weekend": F.when(F.weekday(hour) >= 5, 1).otherwise(0), "hour_since_midnight": F.hour(hour), "season": season(F.month(hour)),
    }


def feature_table(targets: DataFrame, facts: DataFrame, citywide: DataFrame, weather: DataFrame, horizon_minutes: int = 60, citywide_wx: DataFrame | None = None) -> DataFrame:
    if horizon_minutes < 0:
        raise ValueError("the horizon must not be negative")
    out = pollutant_features(targets, facts, citywide).join(weather_features(targets, weather, citywide_wx), ["location_id", "hour_start"], "left")
    out = out.withColumn("imputation_count", F.col("imputation_count") + F.coalesce("weather_imputation_count", F.lit(0))).drop("weather_imputation_count")
    return out.withColumns({**calendar(F.col("hour_start")), "horizon_minutes": F.lit(horizon_minutes), "feature_version": F.lit(VERSION)})
