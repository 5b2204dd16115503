"""Hourly facts of stations, locations and weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hour_floor, surrogate_key


def r6(c: Column) -> Column:
    """Doubles at six places: sums in another order differ beyond."""
    return F.round(c, 6)


def decimal2(c: Column, precision: int) -> Column:
    """Two places by way of six, so that ties are those of decimals and not of doubles."""
    return r6(c).cast("decimal(24,6)").cast(f"decimal({precision},2)")


def air_quality_hourly(clean: DataFrame) -> DataFrame:
    """By source, station, pollutant and hour; ``value_ug`` is in µg/m³. Median and deviation have two places."""
    v = F.col("value_ug")
    return clean.groupBy("source", "station_id", "pollutant", hour_floor(F.col("observed_at")).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.count_distinct("raw_payload_hash").alias("unique_records"),
        r6(F.avg(v)).alias("mean_value"),
        decimal2(F.percentile(v, 0.5), 10).alias("median_value"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        decimal2(F.stddev_pop(v), 10).alias("stddev_value"),
        F.count_if(v > 0).alias("positive_count"),
    )


def with_location(facts: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join with the station dimension; stations that it lacks are UNMAPPED."""
    return facts.join(stations, ["source", "station_id"], "left").withColumn("location_id", F.coalesce("location_id", F.lit("UNMAPPED")))


def location_hourly(mapped: DataFrame) -> DataFrame:
    """All stations of a location pooled, from cleaned observations with location_id."""
    v = F.col("value_ug")
    p = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        mapped.where("location_id <> 'UNMAPPED'")
        .groupBy("location_id", "pollutant", hour_floor(F.col("observed_at")).alias("hour_start"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("station_id").alias("active_stations"), p.alias("p"), r6(F.avg(v)).alias("mean_value"), F.max(v).alias("max_value"), F.min(v).alias("min_value"))
        .select("location_id", "pollutant", "hour_start", "n", "active_stations", *(r6(F.col("p")[i]).alias(name) for i, name in enumerate(("p25", "median_value", "p75"))), "mean_value", "max_value", "min_value")
    )


def aggregate_window(mapped: DataFrame, locations: DataFrame, pollutants: list[str], start: Column, end: Column, interval_minutes: int, hours: int) -> DataFrame:
    """Location statistics in [start, end); a location without data has a row of nulls and zeros."""
    v = F.col("value_ug")
    got = (
        mapped.where((F.col("observed_at") >= start) & (F.col("observed_at") < end) & (F.col("location_id") != "UNMAPPED"))
        .groupBy("location_id", "pollutant")
        .agg(F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("p"), r6(F.avg(v)).alias("mean_value"), F.max(v).alias("max_value"), F.min(v).alias("min_value"), F.count(F.lit(1)).alias("n"), F.count_distinct("station_id").alias("stations"))
    )
    wanted = locations.select("location_id", F.explode(F.array(*map(F.lit, pollutants))).alias("pollutant"))
    expected = F.lit(60 // interval_minutes * hours) * F.col("stations")
    return wanted.join(got, ["location_id", "pollutant"], "left").select(
        "location_id", "pollutant", *(r6(F.col("p")[i]).alias(name) for i, name in enumerate(("p25", "median_value", "p75"))), "mean_value", "max_value", "min_value",
        F.coalesce("n", F.lit(0)).alias("valid_count"), F.coalesce("stations", F.lit(0)).alias("active_stations"),
        F.coalesce(r6(F.when(expected > 0, F.col("n") / expected * 100)), F.lit(0.0)).alias("coverage_pct"),
    )


def weather_hourly(first: DataFrame) -> DataFrame:
    dec = lambda c, p: F.round(c, 2).cast(f"decimal({p},2)")
    return first.groupBy("source", "location_id", "hour_start").agg(
        F.count(F.lit(1)).alias("observation_count"),
        dec(F.avg("temperature_c"), 5).alias("temperature_mean"), dec(F.min("temperature_c"), 5).alias("temperature_min"), dec(F.max("temperature_c"), 5).alias("temperature_max"),
        dec(F.avg("humidity_pct"), 5).alias("humidity_mean"), dec(F.avg("wind_speed_kmh"), 7).alias("wind_speed_mean"), dec(F.max("wind_speed_kmh"), 7).alias("wind_speed_max"),
        dec(F.avg("wind_direction_deg"), 7).alias("wind_direction_mean"), dec(F.avg("pressure_hpa"), 8).alias("pressure_mean"), dec(F.sum("precipitation_mm"), 8).alias("precipitation_total"),
        dec(F.avg("cloud_cover_pct"), 5).alias("cloud_cover_mean"),
    )


def circular_wind(first: DataFrame) -> DataFrame:
    """An addition: the mean direction on the circle, by hour."""
    a = F.radians("wind_direction_deg")
    mean = F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a))))
    return first.groupBy("source", "location_id", "hour_start").agg(r6(F.pmod(mean + 360, F.lit(360.0))).alias("wind_direction_circular"))


def coverage(count: Column) -> Column:
    """Share of one expected observation an hour; more than one gives over 100, so there is room for more digits than a percentage has."""
    return decimal2(count / F.lit(1.0) * 100, 10)


def air_quality_score(n: Column, mean: Column, hist: Column, mad: Column) -> Column:
    near = 1 - F.least(F.lit(1.0), F.abs(mean - F.coalesce(hist, mean)) / (F.coalesce(mad, F.lit(1.0)) + 0.1))
    return decimal2(F.least(F.lit(100.0), F.greatest(F.lit(0.0), n * 100 * 0.7 + near * 30)), 5)


def with_baselines(hourly: DataFrame, stations: DataFrame, baselines: DataFrame) -> DataFrame:
    """Hourly facts of mapped stations with the baseline of their location, pollutant, month and hour of the day, or nulls."""
    keys = ["location_id", "pollutant", "month", "hour_of_day"]
    mapped = with_location(hourly, stations).where("location_id <> 'UNMAPPED'").withColumns({"month": F.month("hour_start"), "hour_of_day": F.hour("hour_start")})
    return mapped.join(baselines.select(*keys, "historical_median", "mad", "p90", "p95", "p99"), keys, "left").drop("month", "hour_of_day")


def air_quality_mart(rows: DataFrame) -> DataFrame:
    """The mart's columns of ``with_baselines``: what a missing baseline leaves open is the hour's own median and maximum."""
    own = lambda c: F.coalesce(c, F.col("max_value"))
    return rows.select(
        surrogate_key("location_id", "pollutant", "hour_start").alias("fact_key"), surrogate_key("source", "station_id", "location_id", "pollutant", "hour_start").alias("full_key"),
        "location_id", "source", "station_id", "pollutant", "hour_start", "observation_count", "unique_records", "mean_value", "median_value", "min_value", "max_value", "stddev_value",
        F.lit(1).alias("expected_observation_count"), coverage(F.col("observation_count")).alias("coverage_pct"),
        F.coalesce("historical_median", F.col("median_value").cast("double")).alias("baseline_median"), F.coalesce("mad", F.lit(0.0)).alias("baseline_mad"),
        *(own(p).alias(f"baseline_{p}") for p in ("p90", "p95", "p99")),
        mart_flag(F.col("median_value"), F.col("historical_median"), F.col("mad")).alias("anomaly_flag"),
        air_quality_score(F.col("observation_count"), F.col("mean_value"), F.col("historical_median"), F.col("mad")).alias("quality_score"),
    )


def mart_flag(median: Column, hist: Column, mad: Column) -> Column:
    """Whether the median is more than three deviations off, compared as decimals."""
    exact = lambda c: c.cast("decimal(24,6)")
    return F.when(F.abs(exact(median) - exact(hist)) > 3 * exact(mad), 1).otherwise(0)


def weather_score(n: Column) -> Column:
    return F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), n * 100.0)), 2)
