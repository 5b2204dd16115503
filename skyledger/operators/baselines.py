"""Robust baselines: exact percentiles and the median absolute deviation by group, with fallbacks.

A place's values of a month or of an hour of the day are few, so one aggregation gathers them and arrays do the rest. Groups of many values, such as all
of a city's, take ``exact_percentiles``, which holds no group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS
from .facts import r6

LEVELS = (0.5, 0.75, 0.9, 0.95, 0.99)


def _at(sorted_values: str, q: float) -> Column:
    """Percentile of a sorted array, between neighbours in proportion."""
    place = q * (F.size(sorted_values) - 1)
    low, part = F.floor(place).cast("int"), place - F.floor(place)
    return F.element_at(sorted_values, low + 1) * (1 - part) + F.element_at(sorted_values, F.ceil(place).cast("int") + 1) * part


def robust_baselines(facts: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """n, historical_median, mad and p50 to p99 of each group of keys; null and NaN values are left out. For groups that time bounds: one place's hours."""
    rows = facts.where(F.col(value).isNotNull() & ~F.isnan(value))
    groups = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias("_x")).withColumn("_m", _at("_x", 0.5))
    groups = groups.withColumn("_off", F.sort_array(F.transform("_x", lambda x: F.abs(x - F.col("_m")))))
    return groups.select(*keys, F.size("_x").cast("bigint").alias("n"), r6(F.col("_m")).alias("historical_median"), r6(_at("_off", 0.5)).alias("mad"), *(r6(_at("_x", q)).alias(f"p{round(q * 100)}") for q in LEVELS))


def _bucket(v: Column) -> Column:
    """A whole number that never falls as v grows: 256 of them for each power of two."""
    size = F.floor(F.log2(F.abs(v)) * 256) + 300_000
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)


def exact_percentiles(rows: DataFrame, keys: list[str], value: str, levels: tuple[float, ...]) -> DataFrame:
    """(keys, n, p): interpolated percentiles of groups that may hold a large part of all rows; nulls and NaN are left out.

    Rows are counted by bucket, then the buckets that hold the wanted ranks by distinct value: both sums have partial results, and
    what is ranked is a group's buckets, or the distinct values of one.
    """
    counted = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.col(value).alias("_v"), _bucket(F.col(value)).alias("_b")).groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_n"))
    by_bucket = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sums = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"))
    sums = sums.withColumns({"_upto": F.sum("_n").over(by_bucket.orderBy("_b")), "n": F.sum("_n").over(by_bucket)})
    ranks = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), f(q * (F.col("n") - 1)).cast("bigint").alias("rank")) for i, q in enumerate(levels) for side, f in (("low", F.floor), ("high", F.ceil))))
    wanted = sums.select(*keys, "_b", "n", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto", F.explode(ranks).alias("_t")).where("_t.rank >= _before and _t.rank < _upto")
    held = counted.join(wanted.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v")
    held = held.withColumn("_sum", F.sum("_n").over(in_bucket)).withColumnRenamed("_n", "_m")
    found = held.join(wanted, [*keys, "_b"]).where("_t.rank >= _before + _sum - _m and _t.rank < _before + _sum")
    at = lambda i, side: F.max(F.when((F.col("_t.i") == i) & (F.col("_t.side") == side), F.col("_v")))
    ends = found.groupBy(*keys).agg(F.max("n").alias("n"), *(at(i, side).alias(f"_{side}{i}") for i in range(len(levels)) for side in ("low", "high")))
    part = lambda q: q * (F.col("n") - 1) - F.floor(q * (F.col("n") - 1))
    return ends.select(*keys, "n", F.array(*(F.col(f"_low{i}") * (1 - part(q)) + F.col(f"_high{i}") * part(q) for i, q in enumerate(levels))).alias("p"))


def wide_baselines(facts: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``robust_baselines`` for groups of many values."""
    stats = exact_percentiles(facts, keys, value, LEVELS)
    spread = facts.join(stats.select(*keys, F.col("p")[0].alias("_m")), keys).select(*keys, F.abs(F.col(value) - F.col("_m")).alias("_off"))
    off = exact_percentiles(spread, keys, "_off", (0.5,)).select(*keys, F.col("p")[0].alias("mad"))
    return stats.join(off, keys).select(*keys, "n", r6(F.col("p")[0]).alias("historical_median"), r6(F.col("mad")).alias("mad"), *(r6(F.col("p")[i]).alias(f"p{round(q * 100)}") for i, q in enumerate(LEVELS)))


def baselines_asked(asked: DataFrame, facts: DataFrame, value: str = "value") -> DataFrame:
    """Baselines of the asked (location_id, pollutant, month, hour_of_day); one without any value has no statistics, n 0 and the reason no_data."""
    keys = ["location_id", "pollutant", "month", "hour_of_day"]
    found = asked.join(hourly_baselines(facts, value), keys, "left")
    return found.select(*keys, F.coalesce("n", F.lit(0)).alias("n"), "historical_median", "mad", *(f"p{round(q * 100)}" for q in LEVELS), F.col("n").isNull().alias("fallback_used"), F.when(F.col("n").isNull(), "no_data").alias("fallback_reason"))


def with_calendar(facts: DataFrame) -> DataFrame:
    return facts.withColumns({"month": F.month("hour_start"), "hour_of_day": F.hour("hour_start")})


def hourly_baselines(facts: DataFrame, value: str = "value") -> DataFrame:
    return robust_baselines(with_calendar(facts), ["location_id", "pollutant", "month", "hour_of_day"], value)


def monthly_baselines(facts: DataFrame, value: str = "value") -> DataFrame:
    return robust_baselines(with_calendar(facts), ["location_id", "pollutant", "month"], value)


def baselines_with_fallback(facts: DataFrame, least: int = SETTINGS.baseline_least, weekly_least: int = SETTINGS.weekly_least, value: str = "value") -> DataFrame:
    """Own hour if it has ``least`` values, else the location's month if it has ``weekly_least``, else all locations' hour."""
    rows = with_calendar(facts)
    picked = ["n", "historical_median", "mad"]
    side = lambda keys, tag, of=robust_baselines: of(rows, keys, value).select(*keys, F.struct(*picked).alias(tag))
    own = side(["location_id", "pollutant", "month", "hour_of_day"], "own")
    month = side(["location_id", "pollutant", "month"], "month_wide")
    city = side(["pollutant", "month", "hour_of_day"], "city", wide_baselines)
    joined = own.join(month, ["location_id", "pollutant", "month"], "left").join(city, ["pollutant", "month", "hour_of_day"], "left")
    level = F.when(F.col("own.n") >= least, "own").when(F.col("month_wide.n") >= weekly_least, "weekly_fallback").otherwise("citywide_fallback")
    chosen = F.when(level == "own", F.col("own")).when(level == "weekly_fallback", F.col("month_wide")).otherwise(F.col("city"))
    return joined.select("location_id", "pollutant", "month", "hour_of_day", F.col("own.n").alias("own_n"), level.alias("level"), *(chosen[c].alias(c) for c in picked))


def parity_fallback(hourly: DataFrame, least: int = SETTINGS.baseline_least) -> DataFrame:
    """Sparse groups get the placeholder [50.0]: one value, median 50, no deviation."""
    few = F.col("n") < least
    return hourly.select("location_id", "pollutant", "month", "hour_of_day", F.when(few, 1).otherwise(F.col("n")).alias("n"), F.when(few, 50.0).otherwise(F.col("historical_median")).alias("historical_median"), F.when(few, 0.0).otherwise(F.col("mad")).alias("mad"), F.when(few, "citywide_fallback").alias("fallback_reason"))
