"""Station health: six metrics in percent, penalties, score and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PENALTIES
from ..functions.scalars import hour_floor
from .facts import r6


def penalty(metric: str, low_is_bad: bool, threshold: float, points: float) -> Column:
    bad = F.col(metric) < threshold if low_is_bad else F.col(metric) > threshold
    return F.when(bad, points).otherwise(0.0)


def health_score() -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - sum((penalty(*p) for p in PENALTIES), F.lit(0.0))))


def health_status(score: Column) -> Column:
    return F.when(score >= 80, "healthy").when(score >= 50, "degraded").otherwise("offline")


def penalties_applied() -> Column:
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(t).alias("threshold"), F.lit(p).alias("penalty"), F.lit(f"{m} {'below' if low else 'above'} {t:g}").alias("description")) for m, low, t, p in PENALTIES]
    return F.filter(F.array(*(F.when(penalty(*p) > 0, i) for p, i in zip(PENALTIES, items, strict=True))), lambda x: x.isNotNull())


def scored(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("health_score", health_score()).withColumn("status", health_status(F.col("health_score"))).withColumn("penalties_applied", penalties_applied())


def station_metrics(raw: DataFrame, hours: int) -> DataFrame:
    """Availability, missing, duplicate, stale, flatline and outlier rates of each station from its raw observations."""
    order = Window.partitionBy("station_id", "sensor_id", "pollutant").orderBy("observed_at", "ingested_at", "value")
    rows = raw.withColumns({"v1": F.lag("value", 1).over(order), "v2": F.lag("value", 2).over(order)})
    spread = raw.groupBy("station_id", "pollutant").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"))
    rows = rows.join(spread, ["station_id", "pollutant"])
    n = F.count(F.lit(1))
    share = lambda c: r6(F.count_if(c) * 100.0 / n)
    out = rows.groupBy("station_id").agg(
        F.least(F.lit(100.0), r6(F.count_distinct(hour_floor(F.col("observed_at"))) * 100.0 / hours)).alias("availability_pct"),
        r6((n - F.count_distinct("sensor_id", "pollutant", "observed_at")) * 100.0 / n).alias("duplicate_rate"),
        share(F.col("ingested_at") - F.col("observed_at") > F.expr("interval 6 hours")).alias("stale_rate"),
        share((F.col("value") == F.col("v1")) & (F.col("value") == F.col("v2"))).alias("flatline_rate"),
        share(F.abs(F.try_divide(F.col("value") - F.col("m"), F.col("sd"))) > 3).alias("outlier_rate"),
    )
    return out.withColumn("missing_rate", r6(100.0 - F.col("availability_pct")))


def health_summary(scores: DataFrame) -> DataFrame:
    """The median is the upper one of an even number, not interpolated; scores are few numbers, so it is found among their counts."""
    counts = scores.groupBy("health_score", "status").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    of = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0))
    ranked = F.array_sort(F.collect_list(F.struct("health_score", "n")))
    upper = F.aggregate("ranked", F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("double").alias("found")), lambda a, x: F.struct((a["upto"] + x["n"]).alias("upto"), F.when(a["found"].isNull() & (a["upto"] + x["n"] > F.floor(F.col("stations") / 2)), x["health_score"]).otherwise(a["found"]).alias("found")))["found"]
    out = counts.agg(F.coalesce(total, F.lit(0)).alias("stations"), *(of(s).alias(s) for s in ("healthy", "degraded", "offline")), r6(of("healthy") * 100.0 / total).alias("healthy_pct"), r6(F.sum(F.col("health_score") * F.col("n")) / total).alias("mean_score"), ranked.alias("ranked"))
    return out.withColumn("median_score", upper).drop("ranked")
