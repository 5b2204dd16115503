"""Structured Streaming: deduplicated ingest and hourly facts with a watermark of late data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import factor_sql_units, measurement_key


def deduplicated(stream: DataFrame, delay: str = "6 hours") -> DataFrame:
    """The first arrival of each measurement; state is kept for the delay only."""
    timed = stream.withColumn("event_time", F.col("observed_at").cast("timestamp")).withWatermark("event_time", delay)
    return timed.withColumn("measurement_key", measurement_key()).dropDuplicatesWithinWatermark(["measurement_key"])


def hourly_facts(stream: DataFrame, delay: str = "6 hours") -> DataFrame:
    """Tumbling hours of cleaned values. Exact percentiles aren't kept in state: the batch mart has them."""
    value = F.col("value") * factor_sql_units(F.col("unit"))
    hour = F.window("event_time", "1 hour")
    out = deduplicated(stream, delay).where("value is not null").groupBy("source", "station_id", "pollutant", hour).agg(F.count(F.lit(1)).alias("observation_count"), F.avg(value).alias("mean_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))
    return out.select("source", "station_id", "pollutant", F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "observation_count", "mean_value", "min_value", "max_value")


def rewrite_affected_hours(root: str):
    """A foreachBatch function that recomputes the whole hours a batch touches: twice the same batch, once the result.

    A batch has few days, which are collected so that they prune the partitions of the stored history: nothing else of it is listed or read.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        raw = f"{root}/raw"
        days = [F.date_format("observed_at", "yyyy-MM-dd").alias("day")]
        keyed = batch.withColumn("measurement_key", measurement_key()).dropDuplicates(["measurement_key"]).select("*", *days)
        touched = [r.day for r in keyed.select("day").where("day is not null").distinct().collect()]
        if not touched:
            return
        of_days = lambda: spark.read.schema(keyed.schema).parquet(raw).where(F.col("day").isin(touched))
        try:
            keyed = keyed.join(of_days().select("measurement_key"), "measurement_key", "left_anti")
        except AnalysisException as e:  # nothing has been stored yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        keyed.where("day is not null").write.mode("append").partitionBy("day").parquet(raw)
        all_rows = of_days()
        value = F.col("value") * factor_sql_units(F.col("unit"))
        facts = all_rows.groupBy("day", "source", "station_id", "pollutant", F.date_trunc("hour", "observed_at").alias("hour_start")).agg(F.count(F.lit(1)).alias("observation_count"), F.avg(value).alias("mean_value"))
        facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/hourly_facts")

    return run
