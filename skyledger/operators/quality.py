"""Validation rules as column expressions, classification, and batch statistics.

A record is INVALID at its first hard failure in rule order and keeps the warnings of earlier rules only; otherwise it is
SUSPICIOUS with any warning and VALID without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AQ_REQUIRED, SETTINGS, WX_REQUIRED


def first_missing(columns: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in columns))


def aq_structural() -> Column:
    return first_missing(AQ_REQUIRED)


def aq_semantic() -> Column:
    return F.when(F.col("value") < 0, "negative value")


def aq_unit_warning() -> Column:
    return F.when(~F.coalesce(F.col("unit").isin(*SETTINGS.units), F.lit(False)), "unknown unit")


def in_future(now: Column) -> Column:
    return F.when(F.col("observed_at") > now + F.expr(f"interval {SETTINGS.future_hours} hours"), "observed in the future")


def aq_outlier_warning() -> Column:
    limit = F.lit(None).cast("double")
    for name, bound in SETTINGS.upper_bounds.items():
        limit = F.when(F.lower("pollutant") == name, bound).otherwise(limit)
    return F.when(F.col("value") > limit, "above the pollutant's bound")


def aq_round_warning() -> Column:
    v = F.col("value")
    return F.when((v > 0) & (v == F.floor(v)) & (v % 10 == 0), "suspiciously round")


def wx_structural() -> Column:
    return first_missing(WX_REQUIRED)


def wx_semantic() -> Column:
    ranges = [("humidity_pct", 0, 100), ("temperature_c", -60, 60), ("wind_direction_deg", 0, 360), ("wind_speed_kmh", 0, None), ("pressure_hpa", 900, 1100), ("precipitation_mm", 0, None)]
    return F.coalesce(*(F.when((F.col(c) < low) | (F.lit(False) if high is None else F.col(c) > high), f"{c} out of range") for c, low, high in ranges))


def _classified(df: DataFrame, hard: list[Column], soft: list[tuple[int, Column]]) -> DataFrame:
    """``soft`` holds (number of hard rules that come before, warning)."""
    failed = F.coalesce(*hard)
    kept = [F.when(F.coalesce(*hard[:n], F.lit(None)).isNull() if n else F.lit(True), w) for n, w in soft]
    warnings = F.filter(F.array(*kept), lambda w: w.isNotNull())
    out = df.withColumns({"failure": failed, "warnings": warnings})
    return out.withColumn("class", F.when(F.col("failure").isNotNull(), "INVALID").when(F.size("warnings") > 0, "SUSPICIOUS").otherwise("VALID"))


def classify_air_quality(df: DataFrame, now: Column) -> DataFrame:
    return _classified(df, [aq_structural(), aq_semantic(), in_future(now)], [(2, aq_unit_warning()), (3, aq_outlier_warning()), (3, aq_round_warning())])


def classify_weather(df: DataFrame, now: Column) -> DataFrame:
    hard = [wx_structural(), wx_semantic(), in_future(now)]
    return df.withColumn("failure", F.coalesce(*hard)).withColumn("class", F.when(F.col("failure").isNotNull(), "INVALID").otherwise("VALID"))


def batch_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("class").agg(F.count(F.lit(1)).alias("records"))
