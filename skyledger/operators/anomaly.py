"""Robust z scores, severities, and the precedence of baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS
from .facts import r6


def zero_mad_z(x: Column, median: Column) -> Column:
    """Stand-in for z where the deviation is 0: by the ratio to the median."""
    ratio = F.try_divide(x, median)
    return F.when(median == 0, F.when(F.abs(x) > 100, 5.0).otherwise(0.0)).when(ratio >= 2, 3.0).when(ratio <= 0.5, -3.0).otherwise(0.0)


def robust_z(x: Column, median: Column, mad: Column) -> Column:
    return F.when(mad == 0, zero_mad_z(x, median)).otherwise(F.try_divide(x - median, 1.4826 * mad))


def severity(z: Column) -> Column:
    out = F.when(z.isNull(), "NORMAL")
    for level, name in SETTINGS.z_levels:
        out = out.when(F.abs(z) >= level, name)
    return out.otherwise("NORMAL")


def detect(facts: DataFrame, baselines: DataFrame, keys: list[str], value: str = "observed_value") -> DataFrame:
    """Every fact with its baseline's z and severity; without a baseline z is null and the severity NORMAL."""
    joined = facts.join(baselines.select(*keys, "historical_median", "mad"), keys, "left")
    z = r6(robust_z(F.col(value), F.col("historical_median"), F.col("mad")))
    return joined.withColumn("robust_z", z).withColumn("severity", severity(F.col("robust_z"))).withColumn("reason", F.when(F.col("historical_median").isNull(), "no_baseline_available"))


def detect_with_fallback(facts: DataFrame, own: DataFrame, citywide: DataFrame, recent: DataFrame, value: str = "observed_value") -> DataFrame:
    """Baseline of the location, else of the city, else of the last week; the winner is taken whole."""
    body = F.struct("historical_median", "mad")
    tag = lambda df, keys, name: df.select(*keys, body.alias(name))
    joined = facts.join(tag(own, ["location_id", "pollutant"], "own"), ["location_id", "pollutant"], "left").join(tag(citywide, ["pollutant"], "city"), "pollutant", "left").join(tag(recent, ["pollutant"], "recent"), "pollutant", "left")
    own_ok = F.col("own.historical_median").isNotNull()
    chosen = F.when(own_ok, F.col("own")).otherwise(F.coalesce("city", "recent"))
    reason = F.when(own_ok, None).when(F.col("city").isNotNull(), "citywide").when(F.col("recent").isNotNull(), "recent_7d").otherwise("no_baseline_available")
    out = joined.select(*facts.columns, chosen["historical_median"].alias("historical_median"), chosen["mad"].alias("mad"), reason.alias("reason"))
    out = out.withColumn("robust_z", r6(robust_z(F.col(value), F.col("historical_median"), F.col("mad")))).withColumn("severity", severity(F.col("robust_z")))
    return out.withColumn("fallback_used", F.coalesce(F.col("reason").isin("citywide", "recent_7d"), F.lit(False)))


def summary(anomalies: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("severity") == s)
    total = F.count(F.lit(1))
    return anomalies.agg(total.alias("total"), *(count(s).alias(s.lower()) for s in ("NORMAL", "ELEVATED", "HIGH", "SEVERE", "EXTREME")), F.count_if(F.col("severity") != "NORMAL").alias("total_anomalies"), r6(F.try_divide(F.count_if(F.col("severity") != "NORMAL"), total)).alias("anomaly_rate"))


def severity_distribution(anomalies: DataFrame) -> DataFrame:
    counts = anomalies.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(F.lit(0)))  # as many rows as severities
    return counts.select("severity", "n", r6(F.col("n") * 100.0 / whole).alias("share_pct"))
