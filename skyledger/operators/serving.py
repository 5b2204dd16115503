"""Answers of the serving layer as parameterised DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS
from .facts import r6
from .health import health_status


def locations(dim: DataFrame, stations: DataFrame, seen: DataFrame) -> DataFrame:
    last = seen.groupBy("location_id").agg(F.max("observed_at").alias("last_update"))
    active = stations.groupBy("location_id").agg(F.count(F.lit(1)).alias("active_stations"))
    return dim.join(active, "location_id", "left").join(last, "location_id", "left").select("location_id", "city", F.coalesce("active_stations", F.lit(0)).alias("active_stations"), "last_update")


def current(anomalies: DataFrame, baselines: DataFrame, weather: DataFrame, location: str, now: Column, expected_minutes: int = 60) -> DataFrame:
    """Latest fact of each pollutant with its baseline, score, flag and age, and the place's latest weather: aggregates, not sorts."""
    body = F.struct("hour_start", "observed_value", "historical_median", "robust_z", "severity")
    latest = anomalies.where(F.col("location_id") == location).groupBy("location_id", "pollutant").agg(F.max_by(body, "hour_start").alias("x")).select("location_id", "pollutant", "x.*")
    latest = latest.join(baselines.where(F.col("location_id") == location).select("location_id", "pollutant", "p95"), ["location_id", "pollutant"], "left")
    air = F.struct("observed_at", "temperature_c", "humidity_pct", "wind_speed_kmh", "wind_direction_deg")
    wx = weather.where(F.col("location_id") == location).groupBy("location_id").agg(F.max_by(air, "observed_at").alias("w")).select("location_id", F.col("w.observed_at").alias("weather_at"), "w.temperature_c", "w.humidity_pct", "w.wind_speed_kmh", "w.wind_direction_deg")
    age = minutes_between(F.col("hour_start"), now)
    fresh = F.when(age <= expected_minutes, "fresh").when(age <= 24 * 60, "stale").otherwise("missing")
    flag = F.when(F.col("severity").isin("SEVERE", "EXTREME"), "SUSPICIOUS").otherwise("VALID")
    return latest.join(wx, "location_id", "left").withColumns({"unit": F.lit("µg/m³"), "anomaly_score": F.abs("robust_z"), "quality_flag": flag, "data_age_minutes": age, "expected_interval_minutes": F.lit(expected_minutes), "freshness": fresh})


def minutes_between(earlier: Column, later: Column) -> Column:
    return F.floor((F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(60e6)).cast("bigint")


def history(mapped: DataFrame, location: str, pollutant: str, start: str, end: str, grain: str, baselines: DataFrame | None = None) -> DataFrame:
    """Closed range of days by hour or day; the daily median is that of the observations. Coverage is the share of the bucket's hours that have one."""
    if grain not in ("hourly", "daily"):
        raise ValueError("grain must be hourly or daily")
    if end < start:
        raise ValueError("the range ends before it starts")
    bucket = F.date_trunc("hour" if grain == "hourly" else "day", "observed_at").cast("timestamp_ntz").alias("bucket")
    v = F.col("value_ug")
    rows = mapped.where((F.col("location_id") == location) & (F.col("pollutant") == pollutant) & (F.col("observed_at") >= F.lit(start).cast("timestamp_ntz")) & (F.col("observed_at") < F.lit(end).cast("timestamp_ntz") + F.expr("interval 1 day")))
    hours = F.lit(1.0 if grain == "hourly" else 24.0)
    out = rows.groupBy("location_id", "pollutant", bucket).agg(r6(F.avg(v)).alias("mean_value"), r6(F.percentile(v, 0.5)).alias("median_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.count(F.lit(1)).alias("n"), r6(F.count_distinct(F.date_trunc("hour", "observed_at")) * 100.0 / hours).alias("coverage_pct"))
    if baselines is None:
        return out
    keys = ["location_id", "pollutant", "month"] + (["hour_of_day"] if grain == "hourly" else [])
    out = out.withColumns({"month": F.month("bucket"), "hour_of_day": F.hour("bucket")})
    return out.join(baselines.select(*keys, F.col("historical_median").alias("baseline_median")), keys, "left").drop("month", "hour_of_day")


def latest_forecasts(predictions: DataFrame, location: str, horizons: tuple[int, ...] = SETTINGS.horizons) -> DataFrame:
    order = Window.partitionBy("pollutant", "horizon_minutes").orderBy(F.desc("made_at"))
    rows = predictions.where((F.col("location_id") == location) & F.col("horizon_minutes").isin(*[h for h in horizons if h in SETTINGS.horizons]))
    out = rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    return out.withColumn("confidence_score", F.greatest(F.lit(0.65), 1 - F.col("horizon_minutes") / 1000.0))


def events_between(events: DataFrame, start: str, end: str) -> DataFrame:
    return events.where((F.col("start_time") <= F.lit(end).cast("timestamp_ntz")) & (F.col("end_time") >= F.lit(start).cast("timestamp_ntz")))


def baseline(baselines: DataFrame, location: str, pollutant: str, month: int, hour: int) -> DataFrame:
    """Midnight is an hour like any other."""
    return baselines.where((F.col("location_id") == location) & (F.col("pollutant") == pollutant) & (F.col("month") == month) & (F.col("hour_of_day") == hour))


def system_health(classified: DataFrame, weather: DataFrame, scores: DataFrame, now: Column, fresh_minutes: int = 10) -> DataFrame:
    """Ages of both sources, rejections of the last 24 hours, the best model, and a status of each component and of the whole.

    ``scores`` has model and mae, where a model's error is known. The whole is healthy if all its components are.
    """
    day = F.col("ingested_at") >= now - F.expr("interval 24 hours")
    quality = classified.agg(
        minutes_between(F.max("ingested_at"), now).alias("openaq_freshness_minutes"), F.count_if(day).alias("records_24h"), F.count_if(day & (F.col("class") == "INVALID")).alias("rejected_24h"),
        F.lit(0).alias("_one"),
    ).withColumn("rejection_rate_pct", F.coalesce(r6(F.try_divide(F.col("rejected_24h") * 100.0, F.col("records_24h"))), F.lit(0.0)))
    wx = weather.agg(minutes_between(F.max("ingested_at"), now).alias("weather_freshness_minutes"), F.lit(0).alias("_one"))
    best = scores.agg(F.min_by("model", F.struct("mae", "model")).alias("production_model"), F.min("mae").alias("model_mae"), F.lit(0).alias("_one"))
    out = quality.join(wx, "_one").join(best, "_one").drop("_one")
    ok = lambda c: F.when(F.coalesce(c, F.lit(False)), "healthy").otherwise("degraded")
    out = out.withColumns({
        "ingestion_status": ok((F.col("openaq_freshness_minutes") <= fresh_minutes) & (F.col("weather_freshness_minutes") <= fresh_minutes)),
        "quality_status": ok(F.col("rejection_rate_pct") < 10), "model_status": ok(F.col("model_mae").isNotNull()),
    })
    return out.withColumn("system_status", ok((F.col("ingestion_status") == "healthy") & (F.col("quality_status") == "healthy") & (F.col("model_status") == "healthy")))


def quality_report(classified: DataFrame, hours: int) -> DataFrame:
    """Whole, by source, by location and by station in one pass over grouping sets.

    Coverage is the share of ``hours`` in which a scope has a record. A station has a health score, the share of valid records less that of missing hours.
    """
    n = F.count(F.lit(1))
    grouped = classified.groupingSets([[], ["source"], ["location_id"], ["station_id"]], "source", "location_id", "station_id")
    aggs = [n.alias("records"), *(F.count_if(F.col("class") == c).alias(c.lower()) for c in ("VALID", "SUSPICIOUS", "INVALID")), r6(F.count_if(F.col("class") == "VALID") * 100.0 / n).alias("valid_pct"), r6(F.least(F.lit(100.0), F.count_distinct(F.date_trunc("hour", "observed_at")) * 100.0 / hours)).alias("coverage_pct"), F.grouping_id().alias("level")]
    scope = F.when(F.col("level") == 7, "all").when(F.col("level") == 3, "source").when(F.col("level") == 5, "location").otherwise("station")
    out = grouped.agg(*aggs).select(scope.alias("scope"), F.coalesce("source", "location_id", "station_id").alias("name"), "records", "valid", "suspicious", "invalid", "valid_pct", "coverage_pct")
    score = r6(F.greatest(F.lit(0.0), F.col("valid_pct") - (100 - F.col("coverage_pct"))))
    out = out.withColumn("health_score", F.when(F.col("scope") == "station", score))
    return out.withColumn("health", F.when(F.col("health_score").isNotNull(), health_status(F.col("health_score"))))
