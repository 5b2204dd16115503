"""The observation tables as canonical frames, and the same in SQL for the oracle.

The events table is the stream of observations; a duplicate of every seventh one arrives an hour later with a changed value.
Cleaned observations and hourly marts are tables: the first query of an application that needs one writes it for the later ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import factor_sql_units, hour_floor
from ..operators import anomaly, baselines, dedup, events, facts, quality
from ..sources.landing import landing_dir

NOW = "2024-01-20 12:00:00"
AQ_KEYS = ["source", "station_id", "sensor_id", "pollutant", "observed_at"]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


#: Folders of written marts by application, source folder, state of the source table, and name.
WRITTEN: dict[tuple, str] = {}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _files(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def mart_table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The mart as written before from the same events, else written now. A change of the events' files makes it anew."""
        path, system = self._files(f"{self.dir}/events.parquet")
        state = system.getFileStatus(path).getModificationTime(), system.getContentSummary(path).getLength()
        key = (self.spark.sparkContext.applicationId, self.dir, state, name)
        done, system = self._files(f"{WRITTEN[key]}/_SUCCESS") if key in WRITTEN else (None, None)
        rows = build()
        if done is None or not system.exists(done):
            WRITTEN[key] = landing_dir(self.spark, name)
            rows.write.parquet(WRITTEN[key])
        return self.spark.read.schema(rows.schema).parquet(WRITTEN[key])

    @cached_property
    def aq_first(self) -> DataFrame:
        kind = "CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' WHEN 'signup' THEN 'o3' ELSE 'so2' END"
        unit = "CASE event_id % 10 WHEN 0 THEN 'mg/m³' WHEN 1 THEN 'ppb' WHEN 2 THEN 'grain' ELSE 'µg/m³' END"
        return self.table("events").selectExpr("'openaq' AS source", "CAST(user_id % 20 AS STRING) AS station_id", "CAST(user_id AS STRING) AS sensor_id", f"{kind} AS pollutant", "value", f"{unit} AS unit", "ts AS observed_at", "ts + make_dt_interval(0, CAST(event_id % 9 AS INT)) AS ingested_at", "CAST(event_id AS STRING) AS raw_payload_hash")

    @cached_property
    def aq(self) -> DataFrame:
        again = self.aq_first.where("CAST(raw_payload_hash AS BIGINT) % 7 = 0").withColumns({"ingested_at": F.col("ingested_at") + F.expr("interval 1 hour"), "value": F.col("value") + 1})
        return self.aq_first.unionByName(again)

    @cached_property
    def aq_dedup(self) -> DataFrame:
        return dedup.latest_ingested(self.aq, AQ_KEYS)

    @cached_property
    def aq_clean(self) -> DataFrame:
        return self.mart_table("aq_clean", lambda: self.aq_dedup.where("value is not null").withColumn("value_ug", F.round(F.col("value") * factor_sql_units(F.col("unit")), 6)))

    @cached_property
    def stations(self) -> DataFrame:
        """Stations 18 and 19 are missing on purpose."""
        return self.aq_first.where("CAST(station_id AS INT) < 18").selectExpr("source", "station_id", "concat('loc', CAST(CAST(station_id AS INT) % 5 AS STRING)) AS location_id").distinct()

    @cached_property
    def locations(self) -> DataFrame:
        """Location 4 has no city on purpose."""
        names = self.table("nation").where("n_nationkey < 4").selectExpr("concat('loc', CAST(n_nationkey AS STRING)) AS location_id", "n_name AS city")
        return self.stations.select("location_id").distinct().join(names, "location_id", "left")

    @cached_property
    def aq_mapped(self) -> DataFrame:
        return facts.with_location(self.aq_clean, self.stations)

    @cached_property
    def aq_hourly(self) -> DataFrame:
        return self.mart_table("aq_hourly", lambda: facts.air_quality_hourly(self.aq_clean))

    @cached_property
    def loc_hourly(self) -> DataFrame:
        return self.mart_table("loc_hourly", lambda: facts.location_hourly(self.aq_mapped))

    @cached_property
    def hourly(self) -> DataFrame:
        """location_id, pollutant, hour_start, value: the pooled series of a location."""
        return self.loc_hourly.select("location_id", "pollutant", "hour_start", F.col("median_value").alias("value"))

    @cached_property
    def wx(self) -> DataFrame:
        rows = self.table("events").where("event_type in ('view', 'click')")
        return rows.selectExpr("'open_meteo' AS source", "concat('loc', CAST(user_id % 5 AS STRING)) AS location_id", "ts AS observed_at", "round(value % 60, 4) AS temperature_c", "round(value % 130, 4) AS humidity_pct", "CAST(event_id % 40 AS DOUBLE) AS wind_speed_kmh", "CAST((event_id * 7) % 361 AS DOUBLE) AS wind_direction_deg", "CAST(960 + event_id % 80 AS DOUBLE) AS pressure_hpa", "CAST(event_id % 6 AS DOUBLE) AS precipitation_mm", "CAST(event_id % 101 AS DOUBLE) AS cloud_cover_pct", "ts + make_dt_interval(0, CAST(event_id % 9 AS INT)) AS ingested_at", "CAST(event_id AS STRING) AS raw_payload_hash")

    @cached_property
    def wx_dedup(self) -> DataFrame:
        return dedup.latest_ingested(self.wx.where("temperature_c is not null"), ["source", "location_id", "observed_at"])

    @cached_property
    def wx_first(self) -> DataFrame:
        return self.mart_table("wx_first", lambda: dedup.first_in_hour(self.wx_dedup.where("humidity_pct <= 100").withColumn("hour_start", hour_floor(F.col("observed_at"))), ["source", "location_id"]))

    @cached_property
    def wx_hours(self) -> DataFrame:
        return self.wx_first.select("location_id", "hour_start", F.col("temperature_c").alias("temperature"), F.col("humidity_pct").alias("humidity"), F.col("wind_speed_kmh").alias("wind_speed"), F.col("pressure_hpa").alias("pressure"), F.col("wind_direction_deg").alias("wind_direction"))

    @cached_property
    def month_baselines(self) -> DataFrame:
        return baselines.robust_baselines(self.hourly, ["location_id", "pollutant"])

    @cached_property
    def hour_baselines(self) -> DataFrame:
        return baselines.hourly_baselines(self.hourly)

    @cached_property
    def mart(self) -> DataFrame:
        return facts.with_baselines(self.aq_hourly, self.stations, self.hour_baselines)

    @cached_property
    def citywide(self) -> DataFrame:
        return baselines.wide_baselines(self.hourly, ["pollutant"])

    @cached_property
    def anomalies(self) -> DataFrame:
        observed = self.loc_hourly.select("location_id", "pollutant", "hour_start", F.col("max_value").alias("observed_value"))
        return anomaly.detect(observed, self.month_baselines, ["location_id", "pollutant"])

    @cached_property
    def events(self) -> DataFrame:
        return events.detect_events(self.anomalies, ("ELEVATED", "HIGH", "SEVERE", "EXTREME"))

    @cached_property
    def classified(self) -> DataFrame:
        return quality.classify_air_quality(self.aq, now())


_STATS = "count(*) AS n, round(quantile_cont(value, 0.5), 6) AS historical_median, round(mad(value), 6) AS mad, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99"
SEVERITY = "CASE WHEN robust_z IS NULL THEN 'NORMAL' WHEN abs(robust_z) >= 5 THEN 'EXTREME' WHEN abs(robust_z) >= 4 THEN 'SEVERE' WHEN abs(robust_z) >= 3 THEN 'HIGH' WHEN abs(robust_z) >= 2 THEN 'ELEVATED' ELSE 'NORMAL' END"


def dec2(x: str, precision: int) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(24,6)) AS DECIMAL({precision},2))"


def z_sql(x: str, m: str = "historical_median", d: str = "mad") -> str:
    return f"round(CASE WHEN {d} = 0 THEN CASE WHEN {m} = 0 THEN CASE WHEN abs({x}) > 100 THEN 5.0 ELSE 0.0 END WHEN {x} / {m} >= 2 THEN 3.0 WHEN {x} / {m} <= 0.5 THEN -3.0 ELSE 0.0 END ELSE ({x} - {m}) / (1.4826 * {d}) END, 6)"


#: The same views for the oracle.
CTES = f"""WITH
aq_first AS (SELECT 'openaq' AS source, CAST(user_id % 20 AS VARCHAR) AS station_id, CAST(user_id AS VARCHAR) AS sensor_id,
  CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' WHEN 'signup' THEN 'o3' ELSE 'so2' END AS pollutant, value,
  CASE event_id % 10 WHEN 0 THEN 'mg/m³' WHEN 1 THEN 'ppb' WHEN 2 THEN 'grain' ELSE 'µg/m³' END AS unit, ts AS observed_at,
  ts + to_hours(CAST(event_id % 9 AS INT)) AS ingested_at, CAST(event_id AS VARCHAR) AS raw_payload_hash FROM events),
aq AS (SELECT * FROM aq_first UNION ALL SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at, value + 1 AS value) FROM aq_first WHERE CAST(raw_payload_hash AS BIGINT) % 7 = 0),
aq_dedup AS (SELECT * FROM aq QUALIFY row_number() OVER (PARTITION BY source, station_id, sensor_id, pollutant, observed_at ORDER BY ingested_at DESC, raw_payload_hash DESC) = 1),
aq_clean AS (SELECT *, round(value * CASE WHEN unit = 'µg/m³' THEN 1.0 WHEN unit = 'mg/m³' THEN 1000.0 WHEN unit IN ('ppb', 'ppm') THEN 1.2 ELSE 1.0 END, 6) AS value_ug FROM aq_dedup WHERE value IS NOT NULL),
stations AS (SELECT DISTINCT source, station_id, 'loc' || CAST(CAST(station_id AS INT) % 5 AS VARCHAR) AS location_id FROM aq_first WHERE CAST(station_id AS INT) < 18),
locations AS (SELECT s.location_id, n.n_name AS city FROM (SELECT DISTINCT location_id FROM stations) s LEFT JOIN nation n ON s.location_id = 'loc' || n.n_nationkey AND n.n_nationkey < 4),
aq_mapped AS (SELECT c.*, coalesce(s.location_id, 'UNMAPPED') AS location_id FROM aq_clean c LEFT JOIN stations s USING (source, station_id)),
aq_hourly AS (SELECT source, station_id, pollutant, date_trunc('hour', observed_at) AS hour_start, count(*) AS observation_count, count(DISTINCT raw_payload_hash) AS unique_records, round(avg(value_ug), 6) AS mean_value,
  {dec2("quantile_cont(value_ug, 0.5)", 10)} AS median_value, min(value_ug) AS min_value, max(value_ug) AS max_value, {dec2("stddev_pop(value_ug)", 10)} AS stddev_value, count(*) FILTER (value_ug > 0) AS positive_count FROM aq_clean GROUP BY ALL),
loc_hourly AS (SELECT location_id, pollutant, date_trunc('hour', observed_at) AS hour_start, count(*) AS n, count(DISTINCT station_id) AS active_stations, round(quantile_cont(value_ug, 0.25), 6) AS p25,
  round(quantile_cont(value_ug, 0.5), 6) AS median_value, round(quantile_cont(value_ug, 0.75), 6) AS p75, round(avg(value_ug), 6) AS mean_value, max(value_ug) AS max_value, min(value_ug) AS min_value FROM aq_mapped WHERE location_id <> 'UNMAPPED' GROUP BY ALL),
hourly AS (SELECT location_id, pollutant, hour_start, median_value AS value FROM loc_hourly),
wx AS (SELECT 'open_meteo' AS source, 'loc' || CAST(user_id % 5 AS VARCHAR) AS location_id, ts AS observed_at, round(value % 60, 4) AS temperature_c, round(value % 130, 4) AS humidity_pct, CAST(event_id % 40 AS DOUBLE) AS wind_speed_kmh,
  CAST((event_id * 7) % 361 AS DOUBLE) AS wind_direction_deg, CAST(960 + event_id % 80 AS DOUBLE) AS pressure_hpa, CAST(event_id % 6 AS DOUBLE) AS precipitation_mm, CAST(event_id % 101 AS DOUBLE) AS cloud_cover_pct,
  ts + to_hours(CAST(event_id % 9 AS INT)) AS ingested_at, CAST(event_id AS VARCHAR) AS raw_payload_hash FROM events WHERE event_type IN ('view', 'click')),
wx_dedup AS (SELECT * FROM wx WHERE temperature_c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, location_id, observed_at ORDER BY ingested_at DESC, raw_payload_hash DESC) = 1),
wx_first AS (SELECT *, date_trunc('hour', observed_at) AS hour_start FROM wx_dedup WHERE humidity_pct <= 100 QUALIFY row_number() OVER (PARTITION BY source, location_id, date_trunc('hour', observed_at) ORDER BY observed_at, raw_payload_hash) = 1),
wx_hours AS (SELECT location_id, hour_start, temperature_c AS temperature, humidity_pct AS humidity, wind_speed_kmh AS wind_speed, pressure_hpa AS pressure, wind_direction_deg AS wind_direction FROM wx_first),
month_baselines AS (SELECT location_id, pollutant, {_STATS} FROM hourly GROUP BY ALL),
hour_baselines AS (SELECT location_id, pollutant, CAST(month(hour_start) AS INT) AS month, CAST(hour(hour_start) AS INT) AS hour_of_day, {_STATS} FROM hourly GROUP BY ALL),
mart AS (SELECT a.*, s.location_id, b.historical_median, b.mad, b.p90, b.p95, b.p99 FROM aq_hourly a JOIN stations s USING (source, station_id)
  LEFT JOIN hour_baselines b ON s.location_id = b.location_id AND a.pollutant = b.pollutant AND month(a.hour_start) = b.month AND hour(a.hour_start) = b.hour_of_day),
citywide AS (SELECT pollutant, {_STATS} FROM hourly GROUP BY ALL),
zs AS (SELECT h.location_id, h.pollutant, h.hour_start, h.max_value AS observed_value, b.historical_median, b.mad, {z_sql("h.max_value")} AS robust_z FROM loc_hourly h LEFT JOIN month_baselines b USING (location_id, pollutant)),
anomalies AS (SELECT *, {SEVERITY} AS severity, CASE WHEN historical_median IS NULL THEN 'no_baseline_available' END AS reason FROM zs),
structural AS (SELECT *, CASE WHEN source IS NULL THEN 'missing source' WHEN station_id IS NULL THEN 'missing station_id' WHEN sensor_id IS NULL THEN 'missing sensor_id' WHEN pollutant IS NULL THEN 'missing pollutant' WHEN value IS NULL THEN 'missing value'
  WHEN unit IS NULL THEN 'missing unit' WHEN observed_at IS NULL THEN 'missing observed_at' WHEN ingested_at IS NULL THEN 'missing ingested_at' WHEN raw_payload_hash IS NULL THEN 'missing raw_payload_hash' END AS r1,
  CASE WHEN value < 0 THEN 'negative value' END AS r2, CASE WHEN observed_at > TIMESTAMP '{NOW}' + INTERVAL 1 HOUR THEN 'observed in the future' END AS r3,
  CASE WHEN NOT coalesce(unit IN ('µg/m³', 'mg/m³', 'ppb', 'ppm'), false) THEN 'unknown unit' END AS w1,
  CASE WHEN value > CASE lower(pollutant) WHEN 'pm25' THEN 500.0 WHEN 'pm10' THEN 800.0 WHEN 'no2' THEN 200.0 WHEN 'o3' THEN 200.0 END THEN 'above the pollutant''s bound' END AS w2,
  CASE WHEN value > 0 AND value = floor(value) AND value % 10 = 0 THEN 'suspiciously round' END AS w3 FROM aq),
classified AS (SELECT source, station_id, sensor_id, pollutant, value, unit, observed_at, ingested_at, raw_payload_hash, coalesce(r1, r2, r3) AS failure,
  list_filter([CASE WHEN coalesce(r1, r2) IS NULL THEN w1 END, CASE WHEN coalesce(r1, r2, r3) IS NULL THEN w2 END, CASE WHEN coalesce(r1, r2, r3) IS NULL THEN w3 END], lambda x: x IS NOT NULL) AS warnings,
  CASE WHEN coalesce(r1, r2, r3) IS NOT NULL THEN 'INVALID' WHEN coalesce(w1, w2, w3) IS NOT NULL THEN 'SUSPICIOUS' ELSE 'VALID' END AS class FROM structural),
q AS (SELECT location_id, pollutant, hour_start, observed_value, robust_z, severity, epoch_us(hour_start) AS micros FROM anomalies WHERE severity <> 'NORMAL'),
q1 AS (SELECT *, row_number() OVER w AS rn, lead(micros, 1) OVER w AS l1, lead(micros, 2) OVER w AS l2 FROM q WINDOW w AS (PARTITION BY location_id, pollutant ORDER BY micros, observed_value)),
q2 AS (SELECT *, (SELECT max(y.rn) FROM q1 y WHERE y.location_id = x.location_id AND y.pollutant = x.pollutant AND y.micros <= x.micros + 14400000000) AS win FROM q1 x),
q3 AS (SELECT *, CASE WHEN l1 - micros = 3600000000 AND l2 - l1 = 3600000000 THEN rn + 2 WHEN win - rn + 1 >= 3 THEN win END AS last FROM q2),
q4 AS (SELECT location_id, pollutant, list_reduce(list_prepend({{'nxt': 1::BIGINT, 'l': 0::BIGINT, 's': []::STRUCT(f BIGINT, t BIGINT)[]}}, list({{'nxt': rn::BIGINT, 'l': last::BIGINT, 's': []::STRUCT(f BIGINT, t BIGINT)[]}} ORDER BY rn)),
  lambda a, r: CASE WHEN r.nxt >= a.nxt THEN {{'nxt': (r.l + 1)::BIGINT, 'l': 0::BIGINT, 's': list_append(a.s, {{'f': r.nxt, 't': r.l}})}} ELSE a END).s AS spans FROM q3 WHERE last IS NOT NULL GROUP BY ALL),
q5 AS (SELECT location_id, pollutant, unnest(spans) AS sp FROM q4),
spans AS (SELECT q3.location_id, q3.pollutant, q5.sp.f AS first, min(hour_start) AS start_time, max(hour_start) AS end_time, max(nullif(observed_value, 0)) AS peak_value, avg(nullif(observed_value, 0)) AS mean_value, max(abs(robust_z)) AS peak_z,
  max(list_position(['NORMAL', 'ELEVATED', 'HIGH', 'SEVERE', 'EXTREME'], severity)) AS rank, count(*) AS anomaly_count
  FROM q3 JOIN q5 ON q3.location_id = q5.location_id AND q3.pollutant = q5.pollutant AND q3.rn BETWEEN q5.sp.f AND q5.sp.t GROUP BY ALL),
isl AS (SELECT *, sum(CASE WHEN epoch_us(start_time) - epoch_us(prev) <= 3600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY location_id, pollutant ORDER BY start_time, first) AS island
  FROM (SELECT *, lag(end_time) OVER (PARTITION BY location_id, pollutant ORDER BY start_time, first) AS prev FROM spans)),
merged AS (SELECT location_id, pollutant, island, min(start_time) AS start_time, max(end_time) AS end_time, max(peak_value) AS peak_value, sum(mean_value * anomaly_count) / sum(anomaly_count) AS mean_value, max(peak_z) AS peak_z, max(rank) AS rank, sum(anomaly_count) AS anomaly_count FROM isl GROUP BY ALL),
hashed AS (SELECT *, sha256(location_id || ':' || pollutant || ':' || strftime(start_time, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS h FROM merged),
events_found AS (SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) AS event_id, location_id, pollutant, start_time, end_time,
  CAST(floor((epoch_us(end_time) - epoch_us(start_time)) / 3600000000) + 1 AS INT) AS duration_hours, round(peak_value, 6) AS peak_value, round(mean_value, 6) AS mean_value, peak_z, ['NORMAL', 'ELEVATED', 'HIGH', 'SEVERE', 'EXTREME'][rank] AS severity, CAST(anomaly_count AS BIGINT) AS anomaly_count FROM hashed)
"""
STATS = _STATS
