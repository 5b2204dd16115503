"""Sources and sinks: JSON payloads, partitioned Parquet, quarantine files."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SETTINGS, WX_RANGES
from ..functions.scalars import connector_units, stripped
from ..schemas import AIR_QUALITY, WEATHER, enforce

MEASUREMENTS = "results array<struct<location: struct<id: bigint>, sensor: struct<id: bigint>, parameter: struct<id: string>, value: string, unit: string, date: struct<utc: string>>>, meta struct<next: struct<cursor: string>>"
HOURLY = "hourly struct<time: array<string>, temperature_2m: array<double>, relative_humidity_2m: array<double>, wind_speed_10m: array<double>, wind_direction_10m: array<double>, pressure_msl: array<double>, precipitation: array<double>, cloud_cover: array<double>>"
# Names of the payload's parallel arrays and of the canonical columns.
HOURLY_COLUMNS = {"temperature_2m": "temperature_c", "relative_humidity_2m": "humidity_pct", "wind_speed_10m": "wind_speed_kmh", "wind_direction_10m": "wind_direction_deg", "pressure_msl": "pressure_hpa", "precipitation": "precipitation_mm", "cloud_cover": "cloud_cover_pct"}

ROW_GROUP_BYTES = 128 * 1024 * 1024


def response_hash(column: str = "payload"):
    return F.sha2(F.col(column), 256)


def parse_measurements(payloads: DataFrame) -> DataFrame:
    """(payload, ingested_at) of measurement responses to canonical rows; rows without ids, value or time go."""
    rows = payloads.select("ingested_at", response_hash().alias("raw_payload_hash"), F.explode(F.from_json("payload", MEASUREMENTS)["results"]).alias("m"))
    rows = rows.select("ingested_at", "raw_payload_hash", F.col("m.location.id").alias("l"), F.col("m.sensor.id").alias("s"), F.lower("m.parameter.id").alias("pollutant"), F.expr("try_cast(m.value as double)").alias("v"), F.col("m.unit").alias("u"), F.expr("try_to_timestamp(m.date.utc)").cast("timestamp_ntz").alias("observed_at"))
    rows = rows.where("l is not null and l <> 0 and s is not null and s <> 0 and v is not null and observed_at is not null").where(F.col("pollutant").isin(*SETTINGS.monitored))
    value, unit = connector_units(F.col("v"), F.col("u"))
    return rows.select(F.lit("openaq").alias("source"), F.col("l").cast("string").alias("station_id"), F.col("s").cast("string").alias("sensor_id"), "pollutant", value.alias("value"), unit.alias("unit"), "observed_at", "ingested_at", "raw_payload_hash")


def in_weather_ranges(df: DataFrame) -> DataFrame:
    """A value out of its range drops the whole record; nulls pass."""
    for c, (low, high) in WX_RANGES.items():
        df = df.where(F.col(c).isNull() | F.col(c).between(low, high))
    return df


def parse_hourly_weather(payloads: DataFrame) -> DataFrame:
    """(location_id, payload, ingested_at) of parallel arrays to one row an hour; short arrays end in nulls."""
    h = F.from_json("payload", HOURLY)["hourly"]
    rows = payloads.select("location_id", "ingested_at", response_hash().alias("raw_payload_hash"), h.alias("h"))
    none = F.array().cast("array<double>")
    rows = rows.select("location_id", "ingested_at", "raw_payload_hash", "h.time", *(F.coalesce(f"h.{c}", none).alias(c) for c in HOURLY_COLUMNS))
    rows = rows.select("location_id", "ingested_at", "raw_payload_hash", F.explode(F.arrays_zip("time", *HOURLY_COLUMNS)).alias("z"))
    t = F.col("z.time")
    at = F.when(t.rlike("^[0-9]+$"), F.timestamp_seconds(F.expr("try_cast(z.time as bigint)"))).otherwise(F.expr("try_to_timestamp(z.time)")).cast("timestamp_ntz")
    rows = rows.select(F.lit("open_meteo").alias("source"), "location_id", at.alias("observed_at"), *(F.col(f"z.{a}").alias(b) for a, b in HOURLY_COLUMNS.items()), "ingested_at", "raw_payload_hash")
    return in_weather_ranges(rows.where("observed_at is not null and temperature_c is not null and humidity_pct is not null"))


def register_locations(rows: DataFrame) -> DataFrame:
    """Station coordinates within the bounds of the globe."""
    return rows.where("latitude between -90 and 90 and longitude between -180 and 180").select("station_id", "latitude", "longitude")


def write_raw(df: DataFrame, root: str, kind: str, run_id: str, mode: str = "append") -> None:
    """Contract check, then hive partitions by the observed day; ``overwrite`` replaces only the days that occur."""
    out = enforce(df, kind).withColumn("run_id", F.lit(run_id))
    days = {"year": "yyyy", "month": "MM", "day": "dd"}
    out = out.withColumns({k: F.date_format("observed_at", f) for k, f in days.items()})
    out.repartition(*days).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*days).parquet(root)


def landing_dir(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: beneath ``spark.checkpoint.dir``, else the warehouse. It goes when the driver's JVM ends."""
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/landing-{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def read_raw(spark: SparkSession, root: str, kind: str, start: date, end: date) -> DataFrame:
    """Daily partitions of a closed range. The filter is on partition columns, so other days aren't listed or read."""
    schema = AIR_QUALITY if kind == "air_quality" else WEATHER
    df = spark.read.schema(f"{schema}, run_id string, year string, month string, day string").parquet(root)
    key = F.concat("year", "month", "day")
    return df.where(key.between(f"{start:%Y%m%d}", f"{end:%Y%m%d}")).drop("year", "month", "day")


def write_baselines(df: DataFrame, root: str, version: str) -> None:
    df.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("location_id", "version").parquet(root)


def quarantine(classified: DataFrame, root: str) -> None:
    """Invalid and suspicious rows with their reasons, as JSON lines by source, class and observed day."""
    out = classified.where(F.col("class") != "VALID").withColumn("reasons", F.concat(F.when(F.col("failure").isNotNull(), F.array("failure")).otherwise(F.array().cast("array<string>")), "warnings"))
    out.withColumn("date", F.to_date("observed_at")).drop("failure", "warnings").write.mode("append").partitionBy("source", "class", "date").json(root)


def read_quarantine(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    df = spark.read.json(root)
    return df if kind is None else df.where(F.col("class") == kind.upper())


def quarantine_statistics(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.json(root).agg(F.count_if(F.col("class") == "INVALID").alias("invalid"), F.count_if(F.col("class") == "SUSPICIOUS").alias("suspicious"), F.count(F.lit(1)).alias("total"))


def status_predicates(code) -> dict:
    """Kinds of HTTP status of a landed response."""
    return {"is_success": code.between(200, 299), "is_transient": code.isin(408, 429, 500, 502, 503, 504), "is_permanent": code.between(400, 499) & (code != 429)}


def upsert_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose keys aren't there yet, ready to append."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
