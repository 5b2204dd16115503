"""Scalar expressions over columns: keys, units, time, geography."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"


def stripped(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(BLANKS))


def iso_utc(ts: Column) -> Column:
    """ISO 8601 with offset; the fraction is left out where microseconds are zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00"))


def record_key(*parts: Column) -> Column:
    """SHA-256 of the parts, lower-cased and stripped, joined by a bar; a null reads 'none'."""
    return F.sha2(F.concat_ws("|", *(F.lower(stripped(F.coalesce(p.cast("string"), F.lit("none")))) for p in parts)), 256)


def connector_key(source: str, *parts: Column) -> Column:
    """The connectors' own key: neither lower-cased nor stripped."""
    return F.sha2(F.concat_ws("|", F.lit(source), *(p.cast("string") for p in parts)), 256)


def url_cache_key(url: Column) -> Column:
    return F.md5(url)


def measurement_key() -> Column:
    return record_key(F.col("source"), F.col("station_id"), F.col("sensor_id"), F.col("pollutant"), iso_utc(F.col("observed_at")))


def weather_key() -> Column:
    return record_key(F.col("source"), F.col("location_id"), iso_utc(F.col("observed_at")))


def surrogate_key(*names: str) -> Column:
    blank = F.lit("_dbt_utils_surrogate_key_null_")
    return F.md5(F.concat_ws("-", *(F.coalesce(F.col(n).cast("string"), blank) for n in names)))


def event_uuid(location: Column, pollutant: Column, start: Column) -> Column:
    digest = F.sha2(F.concat_ws(":", location, pollutant, iso_utc(start)), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *(F.substring(digest, a, n) for a, n in cuts))


def factor_sql_units(unit: Column) -> Column:
    """Factor to µg/m³ of the mart: gases by a flat 1.2."""
    return F.when(unit.isin("µg/m³", "ug/m3"), 1.0).when(unit.isin("mg/m³", "mg/m3"), 1000.0).when(unit.isin("ppb", "ppm"), 1.2).otherwise(1.0)


def connector_units(value: Column, unit: Column) -> tuple[Column, Column]:
    """Value and unit of the connector: mg/m³ is converted and relabelled, a blank unit is µg/m³, others stay."""
    unit = F.when(unit.isNull() | (stripped(unit) == ""), "µg/m³").otherwise(unit)
    milli = unit == "mg/m³"
    return F.when(milli, value * 1000.0).otherwise(value), F.when(milli, "µg/m³").otherwise(unit)


def hour_path(ts: Column) -> Column:
    return F.date_format(ts, "'year='yyyy'/month='MM'/day='dd'/hour='HH")


def days_ago(now: Column, days: int) -> Column:
    return now - F.expr(f"interval {int(days)} days")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_ceil(ts: Column) -> Column:
    floor = hour_floor(ts)
    return F.when(floor == ts, floor).otherwise(floor + F.expr("interval 1 hour"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), 0).when(month.isin(3, 4, 5), 1).when(month.isin(6, 7, 8), 2).otherwise(3)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def micro_degrees(x: Column) -> Column:
    return (x * 1e6).cast("bigint")


def severity_rank(severity: Column, names: tuple[str, ...]) -> Column:
    return reduce(lambda acc, pair: acc.when(severity == pair[1], pair[0]), list(enumerate(names))[1:], F.when(severity == names[0], 0))
