"""Watermarks and late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_watermark(runs: DataFrame) -> DataFrame:
    """The last successful run of each source; failed runs never advance it."""
    return runs.where("status = 'success'").groupBy("source_id").agg(F.max_by(F.struct("requested_end", "finished_at"), F.struct("finished_at", "requested_end")).alias("x")).select("source_id", "x.*")


def query_start(last_event: Column, now: Column, lookback_hours: int) -> Column:
    return F.coalesce(last_event, now - F.expr(f"interval {int(lookback_hours)} hours"))


def late_class(observed_at: Column, now: Column) -> Column:
    age = now - observed_at
    return F.when(age <= F.expr("interval 1 hour"), "IMMEDIATE").when(age <= F.expr("interval 6 hours"), "RECENT").when(observed_at.isNotNull(), "BACKFILL")


def needs_recompute(observed_at: Column, now: Column, lookback_hours: int) -> Column:
    return observed_at >= now - F.expr(f"interval {lookback_hours} hours")


def split_by_lookback(rows: DataFrame, now: Column, lookback_hours: int) -> tuple[DataFrame, DataFrame]:
    """Rows to compute anew, and the rest for a backfill, rows without a time among them."""
    recent = F.coalesce(needs_recompute(F.col("observed_at"), now, lookback_hours), F.lit(False))
    return rows.where(recent), rows.where(~recent)


def lookback_range(now: Column, lookback_hours: int) -> tuple[Column, Column]:
    return now - F.expr(f"interval {lookback_hours} hours"), now


def affected_hours(rows: DataFrame, now: Column, lookback_hours: int) -> DataFrame:
    """Distinct (date, hour) partitions to compute anew."""
    return rows.where(needs_recompute(F.col("observed_at"), now, lookback_hours)).select(F.to_date("observed_at").alias("date"), F.hour("observed_at").alias("hour")).distinct()
