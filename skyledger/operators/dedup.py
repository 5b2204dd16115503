"""Duplicates: window winners, last in batch, keys already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_ingested(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key with the latest ``ingested_at`` (then the largest hash). Spark turns rank 1 into a group limit."""
    order = Window.partitionBy(*keys).orderBy(F.desc("ingested_at"), F.desc("raw_payload_hash"))
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def first_in_hour(df: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys, "hour_start").orderBy("observed_at", "raw_payload_hash")
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def last_in_batch(df: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key by batch position: one aggregate, with partial results before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("x")).select(key, "x.*")


def not_stored(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return batch.join(stored.select(key), key, "left_anti")


def already_stored(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return batch.join(stored.select(key), key, "left_semi")


def dedup_statistics(df: DataFrame, key: str) -> DataFrame:
    total, unique = F.count(F.lit(1)), F.count_distinct(key)
    return df.agg(total.alias("total"), unique.alias("unique_records"), (total - unique).alias("duplicates"), F.round((total - unique) / F.greatest(total, F.lit(1)), 6).alias("duplicate_ratio"))
