"""Every registered query of the engine with its SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SETTINGS
from ..functions import scalars as S
from ..operators import anomaly, baselines, dedup, events, facts, features, forecast, health, late, ml, quality, serving
from ..operators.facts import r6
from ..sources import landing
from .views import CTES, NOW, SEVERITY, STATS, Views, dec2, now, z_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def register(f: Callable[[Views], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = CTES + sql
        return f

    return register


KEY = "location_id, pollutant"


# Scans, duplicates
@query("SELECT * FROM aq WHERE observed_at >= TIMESTAMP '2024-01-05' AND observed_at < TIMESTAMP '2024-01-08'")
def scan_raw_aq(v):
    return v.aq.where("observed_at >= timestamp_ntz'2024-01-05' and observed_at < timestamp_ntz'2024-01-08'")


@query("SELECT * FROM wx WHERE observed_at >= TIMESTAMP '2024-01-05' AND observed_at < TIMESTAMP '2024-01-08'")
def scan_raw_weather(v):
    return v.wx.where("observed_at >= timestamp_ntz'2024-01-05' and observed_at < timestamp_ntz'2024-01-08'")


@query("SELECT * FROM aq_dedup")
def win_dedup_aq(v):
    return v.aq_dedup


@query("SELECT * FROM wx_dedup")
def win_dedup_wx(v):
    return v.wx_dedup


@query("SELECT * FROM wx_first")
def win_first_in_hour(v):
    return v.wx_first


@query("SELECT sensor_id, arg_max(value, CAST(raw_payload_hash AS BIGINT)) AS value, max(CAST(raw_payload_hash AS BIGINT)) AS position FROM aq_first GROUP BY sensor_id")
def set_dedup_batch(v):
    rows = v.aq_first.select("sensor_id", "value", F.col("raw_payload_hash").cast("bigint").alias("position"))
    return dedup.last_in_batch(rows, "sensor_id", "position")


@query("SELECT raw_payload_hash, value FROM aq_first WHERE raw_payload_hash IN (SELECT raw_payload_hash FROM aq_first WHERE value > 50)")
def semi_existing_keys(v):
    return dedup.already_stored(v.aq_first.select("raw_payload_hash", "value"), v.aq_first.where("value > 50"), "raw_payload_hash")


@query("SELECT raw_payload_hash, value FROM aq_first WHERE raw_payload_hash NOT IN (SELECT raw_payload_hash FROM aq_first WHERE value > 50)")
def anti_new_keys(v):
    return dedup.not_stored(v.aq_first.select("raw_payload_hash", "value"), v.aq_first.where("value > 50"), "raw_payload_hash")


@query("SELECT count(*) AS total, count(DISTINCT raw_payload_hash) AS unique_records, count(*) - count(DISTINCT raw_payload_hash) AS duplicates, round((count(*) - count(DISTINCT raw_payload_hash)) / greatest(count(*), 1), 6) AS duplicate_ratio FROM aq")
def agg_dedup_stats(v):
    return dedup.dedup_statistics(v.aq, "raw_payload_hash")


@query("SELECT raw_payload_hash, value, observed_at FROM aq_first WHERE value > 10 UNION ALL SELECT raw_payload_hash, value, observed_at FROM aq_first WHERE value > 90")
def set_union_all(v):
    rows = v.aq_first.select("raw_payload_hash", "value", "observed_at")
    return rows.where("value > 10").unionByName(rows.where("value > 90"))


# Units, filters, rules
@query("SELECT raw_payload_hash, CASE WHEN unit = 'mg/m³' THEN value * 1000.0 ELSE value END AS value, CASE WHEN unit = 'mg/m³' THEN 'µg/m³' ELSE unit END AS unit FROM aq_first")
def unit_norm_connector(v):
    value, unit = S.connector_units(F.col("value"), F.col("unit"))
    return v.aq_first.select("raw_payload_hash", value.alias("value"), unit.alias("unit"))


@query("SELECT raw_payload_hash, ingested_at, unit, value_ug FROM aq_clean")
def unit_norm_sql(v):
    return v.aq_clean.select("raw_payload_hash", "ingested_at", "unit", "value_ug")


@query("SELECT raw_payload_hash, pollutant FROM aq_first WHERE pollutant IN ('pm25', 'no2')")
def filter_monitored(v):
    return v.aq_first.where(F.col("pollutant").isin("pm25", "no2")).select("raw_payload_hash", "pollutant")


@query("SELECT raw_payload_hash, pollutant FROM (SELECT raw_payload_hash, CASE WHEN CAST(raw_payload_hash AS BIGINT) % 5 = 0 THEN 'co' ELSE pollutant END AS pollutant FROM aq_first) WHERE pollutant <> 'co'")
def filter_monitored_settings(v):
    rows = v.aq_first.withColumn("pollutant", F.when(F.col("raw_payload_hash").cast("bigint") % 5 == 0, "co").otherwise(F.col("pollutant")))
    return rows.where(F.col("pollutant").isin(*SETTINGS.monitored)).select("raw_payload_hash", "pollutant")


@query("SELECT raw_payload_hash, station_id, sensor_id FROM aq_first WHERE station_id <> '0' AND sensor_id <> '' AND value IS NOT NULL AND observed_at IS NOT NULL")
def filter_required_ids(v):
    return v.aq_first.where("station_id <> '0' and sensor_id <> '' and value is not null and observed_at is not null").select("raw_payload_hash", "station_id", "sensor_id")


@query("SELECT raw_payload_hash, value FROM aq WHERE value IS NOT NULL")
def filter_value_not_null(v):
    return v.aq.where("value is not null").select("raw_payload_hash", "value")


@query("SELECT raw_payload_hash, location_id FROM aq_mapped WHERE location_id <> 'UNMAPPED'")
def filter_mapped(v):
    return v.aq_mapped.where("location_id <> 'UNMAPPED'").select("raw_payload_hash", "location_id")


@query("SELECT * FROM anomalies WHERE severity IN ('HIGH', 'SEVERE', 'EXTREME')")
def filter_severity(v):
    return events.qualifying(v.anomalies)


@query("SELECT * FROM wx WHERE (humidity_pct IS NULL OR humidity_pct BETWEEN 0 AND 100) AND (temperature_c IS NULL OR temperature_c BETWEEN -60 AND 60) AND (pressure_hpa IS NULL OR pressure_hpa BETWEEN 900 AND 1100)")
def wx_range_filter(v):
    from ..sources.landing import in_weather_ranges

    return in_weather_ranges(v.wx)


def rule(name: str, column: str, build):
    @query(f"SELECT raw_payload_hash, ingested_at, {column} AS message FROM structural")
    def f(v):
        return v.aq.select("raw_payload_hash", "ingested_at", build().alias("message"))

    QUERIES[name], ORACLES[name] = QUERIES.pop("f"), ORACLES.pop("f")


rule("rule_aq_structural", "r1", quality.aq_structural)
rule("rule_aq_semantic", "r2", quality.aq_semantic)
rule("rule_aq_temporal", "r3", lambda: quality.in_future(now()))
rule("rule_aq_unit", "w1", quality.aq_unit_warning)
rule("rule_aq_outlier", "w2", quality.aq_outlier_warning)
rule("rule_aq_round", "w3", quality.aq_round_warning)


@query("SELECT raw_payload_hash, CASE WHEN source IS NULL OR location_id IS NULL OR observed_at IS NULL OR temperature_c IS NULL OR humidity_pct IS NULL THEN 'missing' END AS message FROM wx")
def rule_wx_structural(v):
    return v.wx.select("raw_payload_hash", F.when(quality.wx_structural().isNotNull(), "missing").alias("message"))


@query("SELECT raw_payload_hash, CASE WHEN humidity_pct < 0 OR humidity_pct > 100 THEN 'humidity_pct out of range' WHEN temperature_c < -60 OR temperature_c > 60 THEN 'temperature_c out of range' WHEN wind_direction_deg < 0 OR wind_direction_deg > 360 THEN 'wind_direction_deg out of range' WHEN wind_speed_kmh < 0 THEN 'wind_speed_kmh out of range' WHEN pressure_hpa < 900 OR pressure_hpa > 1100 THEN 'pressure_hpa out of range' WHEN precipitation_mm < 0 THEN 'precipitation_mm out of range' END AS message FROM wx")
def rule_wx_semantic(v):
    return v.wx.select("raw_payload_hash", quality.wx_semantic().alias("message"))


@query(f"SELECT raw_payload_hash, CASE WHEN observed_at > TIMESTAMP '{NOW}' + INTERVAL 1 HOUR THEN 'observed in the future' END AS message FROM wx")
def rule_wx_temporal(v):
    return v.wx.select("raw_payload_hash", quality.in_future(now()).alias("message"))


@query("SELECT raw_payload_hash, ingested_at, failure, array_to_string(warnings, '|') AS warnings, class FROM classified")
def classify_aq(v):
    return v.classified.select("raw_payload_hash", "ingested_at", "failure", F.array_join("warnings", "|").alias("warnings"), "class")


@query(f"SELECT raw_payload_hash, CASE WHEN humidity_pct > 100 THEN 'INVALID' WHEN observed_at > TIMESTAMP '{NOW}' + INTERVAL 1 HOUR THEN 'INVALID' ELSE 'VALID' END AS class FROM wx")
def classify_wx(v):
    return quality.classify_weather(v.wx, now()).select("raw_payload_hash", "class")


@query("SELECT class, count(*) AS records FROM classified GROUP BY class")
def validate_batch(v):
    return quality.batch_counts(v.classified)


@query("SELECT class, raw_payload_hash, coalesce(failure, '') AS failure FROM classified WHERE class <> 'VALID'")
def quarantine_rows(v):
    return v.classified.where("class <> 'VALID'").select("class", "raw_payload_hash", F.coalesce("failure", F.lit("")).alias("failure"))


@query("SELECT count(*) FILTER (class = 'INVALID') AS invalid, count(*) FILTER (class = 'SUSPICIOUS') AS suspicious, count(*) FILTER (class <> 'VALID') AS total FROM classified")
def quarantine_stats(v):
    c = F.col("class")
    return v.classified.agg(F.count_if(c == "INVALID").alias("invalid"), F.count_if(c == "SUSPICIOUS").alias("suspicious"), F.count_if(c != "VALID").alias("total"))


@query(f"SELECT raw_payload_hash, observed_at > TIMESTAMP '{NOW}' + INTERVAL 5 MINUTE AS is_future FROM aq_first")
def is_future(v):
    return v.aq_first.select("raw_payload_hash", (F.col("observed_at") > now() + F.expr("interval 5 minutes")).alias("is_future"))


@query("SELECT raw_payload_hash, CAST(observed_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09' AS inside FROM aq_first")
def split_contains_date(v):
    return v.aq_first.select("raw_payload_hash", F.to_date("observed_at").between(F.lit(date(2024, 1, 3)), F.lit(date(2024, 1, 9))).alias("inside"))


# Data tests
@query("SELECT hour_start, count(*) AS n FROM aq_hourly GROUP BY hour_start HAVING count(*) > 1")
def dqtest_unique(v):
    return v.aq_hourly.groupBy("hour_start").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT source, station_id, pollutant, hour_start FROM aq_hourly WHERE mean_value IS NULL OR station_id IS NULL OR pollutant NOT IN ('pm25', 'pm10', 'no2', 'o3')")
def dqtest_not_null_accepted(v):
    return v.aq_hourly.where("mean_value is null or station_id is null or pollutant not in ('pm25', 'pm10', 'no2', 'o3')").select("source", "station_id", "pollutant", "hour_start")


@query("SELECT source, station_id, pollutant, hour_start, CAST(observation_count * 100 AS DECIMAL(10,2)) AS coverage_pct FROM aq_hourly WHERE observation_count / 1.0 * 100 > 100")
def dqtest_coverage(v):
    return v.aq_hourly.withColumn("coverage_pct", facts.coverage(F.col("observation_count"))).where("coverage_pct > 100 or coverage_pct < 0").select("source", "station_id", "pollutant", "hour_start", "coverage_pct")


@query("SELECT DISTINCT station_id FROM aq_hourly WHERE station_id NOT IN (SELECT station_id FROM stations)")
def dqtest_relationships(v):
    return v.aq_hourly.join(v.stations, "station_id", "left_anti").select("station_id").distinct()


@query(f"SELECT max(hour_start) AS latest, max(hour_start) >= TIMESTAMP '{NOW}' - INTERVAL 2 HOUR AS recent FROM aq_hourly")
def dqtest_recency(v):
    return v.aq_hourly.agg(F.max("hour_start").alias("latest")).withColumn("recent", F.col("latest") >= now() - F.expr("interval 2 hours"))


@query("SELECT station_id, pollutant, hour_start FROM mart WHERE mean_value < 0 OR observation_count < 1 OR median_value NOT BETWEEN 0 AND 99")
def dqtest_between(v):
    rows = v.mart.where("mean_value < 0 or observation_count < 1 or median_value not between 0 and 99")
    return rows.select("station_id", "pollutant", "hour_start")


@query("SELECT unnest(['station_id', 'hour_start', 'observation_count', 'mean_value', 'median_value', 'stddev_value']) AS column_name, unnest([any_value(typeof(station_id)), any_value(typeof(hour_start)), any_value(typeof(observation_count)), any_value(typeof(mean_value)), any_value(typeof(median_value)), any_value(typeof(stddev_value))]) AS kind FROM aq_hourly")
def dqtest_column_types(v):
    names = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "double": "DOUBLE", "decimal(10,2)": "DECIMAL(10,2)"}
    kinds = dict(v.aq_hourly.dtypes)
    found = [(c, names.get(kinds[c], kinds[c])) for c in ("station_id", "hour_start", "observation_count", "mean_value", "median_value", "stddev_value")]
    return v.spark.createDataFrame(found, "column_name string, kind string")


# Joins
@query("SELECT h.*, coalesce(s.location_id, 'UNMAPPED') AS location_id FROM aq_hourly h LEFT JOIN stations s USING (source, station_id)")
def join_station_dim(v):
    return facts.with_location(v.aq_hourly, v.stations)


@query("SELECT w.location_id, w.hour_start, coalesce(l.city, 'UNKNOWN') AS city FROM wx_first w LEFT JOIN locations l USING (location_id)")
def join_location_dim(v):
    return v.wx_first.join(v.locations, "location_id", "left").select("location_id", "hour_start", F.coalesce("city", F.lit("UNKNOWN")).alias("city"))


@query(f"SELECT h.location_id, h.pollutant, h.hour_start, h.value, b.n, b.historical_median, b.mad FROM hourly h LEFT JOIN (SELECT location_id, pollutant, month(hour_start) AS m, hour(hour_start) AS hod, {STATS} FROM hourly GROUP BY ALL) b ON h.location_id = b.location_id AND h.pollutant = b.pollutant AND month(h.hour_start) = b.m AND hour(h.hour_start) = b.hod")
def join_baseline_expr(v):
    b = baselines.hourly_baselines(v.hourly).select("location_id", "pollutant", "month", "hour_of_day", "n", "historical_median", "mad")
    return baselines.with_calendar(v.hourly).join(b, ["location_id", "pollutant", "month", "hour_of_day"], "left").drop("month", "hour_of_day")


@query("SELECT h.location_id, h.pollutant, h.hour_start, h.value, b.historical_median, b.p95 FROM hourly h LEFT JOIN month_baselines b USING (location_id, pollutant)")
def join_baseline_lookup(v):
    return v.hourly.join(v.month_baselines.select("location_id", "pollutant", "historical_median", "p95"), ["location_id", "pollutant"], "left")


@query("SELECT s_suppkey AS station_key, n_name AS location, s_acctbal AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0")
def join_active_stations(v):
    return v.table("supplier").where("s_acctbal > 0").join(v.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr("s_suppkey as station_key", "n_name as location", "s_acctbal as balance")


@query("SELECT o_orderkey AS run_id, c_name AS source_name, CAST(o_orderdate AS TIMESTAMP) AS started_at, CAST(o_orderkey % 5000 AS DOUBLE) AS duration_seconds FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def join_recent_runs(v):
    top = v.table("orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)
    runs = top.join(v.table("customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr("o_orderkey as run_id", "c_name as source_name", "cast(o_orderdate as timestamp_ntz) as started_at")
    runs = runs.withColumn("finished_at", F.col("started_at") + F.expr("make_dt_interval(0, 0, 0, run_id % 5000)"))
    return runs.withColumn("duration_seconds", S.epoch_seconds(F.col("finished_at")) - S.epoch_seconds(F.col("started_at"))).drop("finished_at")


@query("SELECT p_partkey AS model_id, p_name AS model_name, p_type AS target, o_orderkey AS version, o_totalprice AS mae, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM part JOIN orders ON p_partkey = o_custkey WHERE o_orderstatus = 'F'")
def join_active_models(v):
    """Models with their versions: of many versions a model has, those that are active."""
    versions = v.table("orders").where("o_orderstatus = 'F'").selectExpr("o_custkey as model_id", "o_orderkey as version", "o_totalprice as mae", "cast(o_orderdate as timestamp_ntz) as created_at")
    return v.table("part").selectExpr("p_partkey as model_id", "p_name as model_name", "p_type as target").join(versions, "model_id")


_FALLBACK = f"""SELECT location_id, pollutant, hour_start, observed_value, historical_median, mad, reason, robust_z, {SEVERITY} AS severity, coalesce(reason IN ('citywide', 'recent_7d'), false) AS fallback_used FROM (
SELECT *, {z_sql("observed_value")} AS robust_z FROM (SELECT h.location_id, h.pollutant, h.hour_start, h.max_value AS observed_value,
CASE WHEN o.historical_median IS NOT NULL THEN o.historical_median WHEN c.pollutant IS NOT NULL THEN c.historical_median ELSE r.historical_median END AS historical_median,
CASE WHEN o.historical_median IS NOT NULL THEN o.mad WHEN c.pollutant IS NOT NULL THEN c.mad ELSE r.mad END AS mad,
CASE WHEN o.historical_median IS NOT NULL THEN NULL WHEN c.pollutant IS NOT NULL THEN 'citywide' WHEN r.pollutant IS NOT NULL THEN 'recent_7d' ELSE 'no_baseline_available' END AS reason
FROM loc_hourly h LEFT JOIN (SELECT * FROM month_baselines WHERE location_id IN ('loc0', 'loc1')) o USING (location_id, pollutant)
LEFT JOIN (SELECT * FROM citywide WHERE pollutant IN ('pm25', 'no2')) c ON h.pollutant = c.pollutant LEFT JOIN (SELECT * FROM citywide WHERE pollutant IN ('pm25', 'o3')) r ON h.pollutant = r.pollutant))"""


@query(_FALLBACK)
def join_fallback_chain(v):
    observed = v.loc_hourly.select("location_id", "pollutant", "hour_start", F.col("max_value").alias("observed_value"))
    own = v.month_baselines.where("location_id in ('loc0', 'loc1')")
    return anomaly.detect_with_fallback(observed, own, v.citywide.where("pollutant in ('pm25', 'no2')"), v.citywide.where("pollutant in ('pm25', 'o3')"))


@query("SELECT h.location_id, h.pollutant, h.hour_start, h.value, p.value AS value_6h_before FROM hourly h LEFT JOIN hourly p ON h.location_id = p.location_id AND h.pollutant = p.pollutant AND p.hour_start = h.hour_start - INTERVAL 6 HOUR")
def join_fact_shift(v):
    keys = ["location_id", "pollutant", "hour_start"]
    past = v.hourly.select("location_id", "pollutant", (F.col("hour_start") + F.expr("interval 6 hours")).alias("hour_start"), F.col("value").alias("value_6h_before"))
    return v.hourly.join(past, keys, "left")


@query("SELECT e.event_id, e.location_id, e.pollutant, count(a.hour_start) AS anomalies FROM events_found e LEFT JOIN anomalies a ON a.location_id = e.location_id AND a.pollutant = e.pollutant AND a.hour_start BETWEEN e.start_time AND e.end_time GROUP BY ALL")
def join_event_anomaly_range(v):
    return events.events_with_anomalies(v.events, v.anomalies)


# Aggregations
@query("SELECT * FROM aq_hourly")
def agg_aq_hourly(v):
    return v.aq_hourly


@query("SELECT source, location_id, hour_start, count(*) AS observation_count, CAST(round(avg(temperature_c), 2) AS DECIMAL(5,2)) AS temperature_mean, CAST(round(min(temperature_c), 2) AS DECIMAL(5,2)) AS temperature_min, CAST(round(max(temperature_c), 2) AS DECIMAL(5,2)) AS temperature_max, CAST(round(avg(humidity_pct), 2) AS DECIMAL(5,2)) AS humidity_mean, CAST(round(avg(wind_speed_kmh), 2) AS DECIMAL(7,2)) AS wind_speed_mean, CAST(round(max(wind_speed_kmh), 2) AS DECIMAL(7,2)) AS wind_speed_max, CAST(round(avg(wind_direction_deg), 2) AS DECIMAL(7,2)) AS wind_direction_mean, CAST(round(avg(pressure_hpa), 2) AS DECIMAL(8,2)) AS pressure_mean, CAST(round(sum(precipitation_mm), 2) AS DECIMAL(8,2)) AS precipitation_total, CAST(round(avg(cloud_cover_pct), 2) AS DECIMAL(5,2)) AS cloud_cover_mean FROM wx_first GROUP BY ALL")
def agg_wx_hourly(v):
    return facts.weather_hourly(v.wx_first)


@query("SELECT * FROM loc_hourly")
def agg_location(v):
    return v.loc_hourly


_WINDOW = """SELECT w.location_id, w.pollutant, round(quantile_cont(value_ug, 0.25), 6) AS p25, round(quantile_cont(value_ug, 0.5), 6) AS median_value, round(quantile_cont(value_ug, 0.75), 6) AS p75, round(avg(value_ug), 6) AS mean_value,
max(value_ug) AS max_value, min(value_ug) AS min_value, count(value_ug) AS valid_count, count(DISTINCT station_id) AS active_stations, coalesce(round(count(value_ug) / nullif(4 * 6 * count(DISTINCT station_id), 0) * 100, 6), 0.0) AS coverage_pct
FROM (SELECT location_id, unnest(['pm25', 'so2', 'co']) AS pollutant FROM locations) w LEFT JOIN aq_mapped m ON m.location_id = w.location_id AND m.pollutant = w.pollutant AND observed_at >= TIMESTAMP '2024-01-10 06:00:00' AND observed_at < TIMESTAMP '2024-01-10 12:00:00' GROUP BY ALL"""


@query(_WINDOW)
def agg_location_empty(v):
    at = lambda t: F.lit(f"2024-01-10 {t}:00:00").cast("timestamp_ntz")
    return facts.aggregate_window(v.aq_mapped, v.locations, ["pm25", "so2", "co"], at("06"), at("12"), 15, 6)


@query(f"SELECT location_id, pollutant, CAST(month(hour_start) AS INT) AS month, CAST(hour(hour_start) AS INT) AS hour_of_day, {STATS} FROM hourly GROUP BY ALL")
def agg_baseline_hourly(v):
    return baselines.hourly_baselines(v.hourly)


@query(f"SELECT location_id, pollutant, CAST(month(hour_start) AS INT) AS month, {STATS} FROM hourly GROUP BY ALL")
def agg_baseline_monthly(v):
    return baselines.monthly_baselines(v.hourly)


_S3 = "count(*) AS n, round(quantile_cont(value, 0.5), 6) AS med, round(mad(value), 6) AS mad"


@query(f"""SELECT location_id, pollutant, CAST(m AS INT) AS month, CAST(hod AS INT) AS hour_of_day, o.n AS own_n, CASE WHEN o.n >= 25 THEN 'own' WHEN w.n >= 20 THEN 'weekly_fallback' ELSE 'citywide_fallback' END AS level,
CASE WHEN o.n >= 25 THEN o.n WHEN w.n >= 20 THEN w.n ELSE c.n END AS n, CASE WHEN o.n >= 25 THEN o.med WHEN w.n >= 20 THEN w.med ELSE c.med END AS historical_median, CASE WHEN o.n >= 25 THEN o.mad WHEN w.n >= 20 THEN w.mad ELSE c.mad END AS mad
FROM (SELECT location_id, pollutant, month(hour_start) AS m, hour(hour_start) AS hod, {_S3} FROM hourly GROUP BY ALL) o LEFT JOIN (SELECT location_id, pollutant, month(hour_start) AS m, {_S3} FROM hourly GROUP BY ALL) w USING (location_id, pollutant, m)
LEFT JOIN (SELECT pollutant, month(hour_start) AS m, hour(hour_start) AS hod, {_S3} FROM hourly GROUP BY ALL) c USING (pollutant, m, hod)""")
def agg_baseline_fallback(v):
    return baselines.baselines_with_fallback(v.hourly, least=25)


@query(f"SELECT location_id, pollutant, CAST(month(hour_start) AS INT) AS month, CAST(hour(hour_start) AS INT) AS hour_of_day, CAST(CASE WHEN count(*) < 60 THEN 1 ELSE count(*) END AS BIGINT) AS n, CASE WHEN count(*) < 60 THEN 50.0 ELSE round(quantile_cont(value, 0.5), 6) END AS historical_median, CASE WHEN count(*) < 60 THEN 0.0 ELSE round(mad(value), 6) END AS mad, CASE WHEN count(*) < 60 THEN 'citywide_fallback' END AS fallback_reason FROM hourly GROUP BY ALL")
def agg_baseline_parity(v):
    return baselines.parity_fallback(baselines.hourly_baselines(v.hourly))


@query("SELECT a.location_id, a.pollutant, a.month, a.hour_of_day, coalesce(b.n, 0) AS n, b.historical_median, b.mad, b.p50, b.p75, b.p90, b.p95, b.p99, b.n IS NULL AS fallback_used, CASE WHEN b.n IS NULL THEN 'no_data' END AS fallback_reason FROM (SELECT location_id, unnest(['pm25', 'co']) AS pollutant, 1 AS month, 0 AS hour_of_day FROM locations) a LEFT JOIN hour_baselines b USING (location_id, pollutant, month, hour_of_day)")
def agg_baseline_empty(v):
    asked = v.locations.select("location_id", F.explode(F.array(F.lit("pm25"), F.lit("co"))).alias("pollutant"), F.lit(1).alias("month"), F.lit(0).alias("hour_of_day"))
    return baselines.baselines_asked(asked, v.hourly)


@query("SELECT pollutant, round(quantile_cont(value_ug, 0.1), 6) AS p10, round(quantile_cont(value_ug, 0.9), 6) AS p90 FROM aq_clean GROUP BY pollutant")
def agg_percentile(v):
    return baselines.exact_percentiles(v.aq_clean, ["pollutant"], "value_ug", (0.1, 0.9)).select("pollutant", r6(F.col("p")[0]).alias("p10"), r6(F.col("p")[1]).alias("p90"))


@query("SELECT pollutant, round(mad(value), 6) AS mad FROM hourly GROUP BY pollutant")
def agg_mad(v):
    return v.citywide.select("pollutant", "mad")


@query("SELECT count(*) AS total, count(*) FILTER (severity = 'NORMAL') AS normal, count(*) FILTER (severity = 'ELEVATED') AS elevated, count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'SEVERE') AS severe, count(*) FILTER (severity = 'EXTREME') AS extreme, count(*) FILTER (severity <> 'NORMAL') AS total_anomalies, round(count(*) FILTER (severity <> 'NORMAL') / count(*), 6) AS anomaly_rate FROM anomalies")
def agg_anomaly_summary(v):
    return anomaly.summary(v.anomalies)


@query("SELECT severity, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM anomalies GROUP BY severity")
def agg_severity_distribution(v):
    return anomaly.severity_distribution(v.anomalies)


@query("SELECT location_id, count(*) AS n, round(avg(mad), 6) AS mean_mad, min(mad) AS min_mad FROM month_baselines GROUP BY location_id")
def agg_baseline_stats(v):
    return v.month_baselines.groupBy("location_id").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("mad")).alias("mean_mad"), F.min("mad").alias("min_mad"))


@query("SELECT location_id, pollutant, first, start_time, end_time, round(peak_value, 6) AS peak_value, round(mean_value, 6) AS mean_value, peak_z, anomaly_count FROM spans")
def agg_event(v):
    rows = events.raw_events(events.candidate_ends(events.qualifying(v.anomalies, ("ELEVATED", "HIGH", "SEVERE", "EXTREME"))))
    return rows.select("location_id", "pollutant", F.col("first").cast("bigint").alias("first"), "start_time", "end_time", r6(F.col("peak_value")).alias("peak_value"), r6(F.col("mean_value")).alias("mean_value"), "peak_z", "anomaly_count")


@query("SELECT location_id, pollutant, CAST(rn AS BIGINT) AS rn, CAST(last AS BIGINT) AS last FROM q3 WHERE last IS NOT NULL")
def seq_candidate_ends(v):
    return events.candidate_ends(events.qualifying(v.anomalies, ("ELEVATED", "HIGH", "SEVERE", "EXTREME"))).where("last is not null").select("location_id", "pollutant", F.col("rn").cast("bigint").alias("rn"), F.col("last").cast("bigint").alias("last"))


@query("SELECT location_id, pollutant, CAST(sp.f AS BIGINT) AS first, CAST(sp.t AS BIGINT) AS last FROM q5")
def seq_greedy_scan(v):
    spans = events.greedy_spans(events.candidate_ends(events.qualifying(v.anomalies, ("ELEVATED", "HIGH", "SEVERE", "EXTREME"))))
    return spans.select("location_id", "pollutant", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"))


@query("SELECT * FROM events_found")
def event_detect(v):
    return v.events


# Anomalies
@query("SELECT * FROM anomalies")
def anom_detect_batch(v):
    return v.anomalies


@query(f"SELECT location_id, pollutant, hour_start, {z_sql('h.value')} AS robust_z FROM hourly h JOIN month_baselines USING (location_id, pollutant)")
def anom_robust_z(v):
    return anomaly.detect(v.hourly, v.month_baselines, ["location_id", "pollutant"], "value").select("location_id", "pollutant", "hour_start", "robust_z")


@query("SELECT raw_payload_hash, CAST(CASE WHEN m = 0 THEN CASE WHEN abs(value) > 100 THEN 5.0 ELSE 0.0 END WHEN value / m >= 2 THEN 3.0 WHEN value / m <= 0.5 THEN -3.0 ELSE 0.0 END AS DOUBLE) AS z FROM (SELECT raw_payload_hash, value, CAST(CAST(raw_payload_hash AS BIGINT) % 3 * 40 AS DOUBLE) AS m FROM aq_first)")
def anom_zero_mad(v):
    rows = v.aq_first.select("raw_payload_hash", "value", (F.col("raw_payload_hash").cast("bigint") % 3 * 40).cast("double").alias("m"))
    return rows.select("raw_payload_hash", anomaly.zero_mad_z(F.col("value"), F.col("m")).alias("z"))


_FLAG = "CASE WHEN abs(CAST(median_value AS DECIMAL(24,6)) - CAST(historical_median AS DECIMAL(24,6))) > 3 * CAST(mad AS DECIMAL(24,6)) THEN 1 ELSE 0 END"
_NEAR = "(1 - least(1.0, abs(mean_value - coalesce(historical_median, mean_value)) / (coalesce(mad, 1.0) + 0.1::DOUBLE)))"
_QUALITY = dec2(f"least(100.0, greatest(0.0, observation_count * 100 * 0.7::DOUBLE + {_NEAR} * 30))", 5)


@query(f"SELECT location_id, source, station_id, pollutant, hour_start, {_FLAG} AS is_anomaly FROM mart")
def anom_flag_mart(v):
    return facts.air_quality_mart(v.mart).select("location_id", "source", "station_id", "pollutant", "hour_start", F.col("anomaly_flag").alias("is_anomaly"))


_DEFAULTS = "coalesce(historical_median, CAST(median_value AS DOUBLE)) AS baseline_median, coalesce(mad, 0.0) AS baseline_mad, coalesce(p90, max_value) AS baseline_p90, coalesce(p95, max_value) AS baseline_p95, coalesce(p99, max_value) AS baseline_p99"


@query(f"SELECT station_id, pollutant, hour_start, {_DEFAULTS} FROM mart")
def anom_baseline_default(v):
    return facts.air_quality_mart(v.mart).select("station_id", "pollutant", "hour_start", *(f"baseline_{c}" for c in ("median", "mad", "p90", "p95", "p99")))


@query(f"SELECT station_id, pollutant, hour_start, {_QUALITY} AS quality_score FROM mart")
def quality_score_aq(v):
    return facts.air_quality_mart(v.mart).select("station_id", "pollutant", "hour_start", "quality_score")


@query("SELECT location_id, hour_start, round(least(100.0, greatest(0.0, count(*) * 100.0::DOUBLE)), 2) AS quality_score FROM wx_first GROUP BY ALL")
def quality_score_wx(v):
    return v.wx_first.groupBy("location_id", "hour_start").agg(F.count(F.lit(1)).alias("n")).select("location_id", "hour_start", facts.weather_score(F.col("n")).alias("quality_score"))


_AT = "strftime(hour_start, '%Y-%m-%d %H:%M:%S')"


@query(f"SELECT md5(location_id || '-' || pollutant || '-' || {_AT}) AS fact_key, md5(source || '-' || station_id || '-' || location_id || '-' || pollutant || '-' || {_AT}) AS full_key, location_id, source, station_id, pollutant, hour_start, observation_count, unique_records, mean_value, median_value, min_value, max_value, stddev_value, 1 AS expected_observation_count, {dec2('observation_count * 100.0', 10)} AS coverage_pct, {_DEFAULTS}, {_FLAG} AS anomaly_flag, {_QUALITY} AS quality_score FROM mart")
def hourly_air_quality_facts(v):
    return facts.air_quality_mart(v.mart)


# Health
_HEALTH = """SELECT station_id, availability_pct, round(100.0 - availability_pct, 6) AS missing_rate, duplicate_rate, stale_rate, flatline_rate, outlier_rate FROM (SELECT station_id, least(100.0, round(count(DISTINCT date_trunc('hour', observed_at)) * 100.0 / 720, 6)) AS availability_pct,
round((count(*) - count(DISTINCT (sensor_id, pollutant, observed_at))) * 100.0 / count(*), 6) AS duplicate_rate, round(count(*) FILTER (ingested_at - observed_at > INTERVAL 6 HOUR) * 100.0 / count(*), 6) AS stale_rate,
round(count(*) FILTER (value = v1 AND value = v2) * 100.0 / count(*), 6) AS flatline_rate, round(count(*) FILTER (abs((value - m) / nullif(sd, 0)) > 3) * 100.0 / count(*), 6) AS outlier_rate
FROM (SELECT *, lag(value, 1) OVER w AS v1, lag(value, 2) OVER w AS v2, avg(value) OVER (PARTITION BY station_id, pollutant) AS m, stddev_pop(value) OVER (PARTITION BY station_id, pollutant) AS sd FROM aq WINDOW w AS (PARTITION BY station_id, sensor_id, pollutant ORDER BY observed_at, ingested_at, value)) GROUP BY station_id)"""
_PEN = "(CASE WHEN availability_pct < 80 THEN 30 ELSE 0 END + CASE WHEN missing_rate > 10 THEN 20 ELSE 0 END + CASE WHEN duplicate_rate > 5 THEN 10 ELSE 0 END + CASE WHEN stale_rate > 5 THEN 10 ELSE 0 END + CASE WHEN flatline_rate > 10 THEN 10 ELSE 0 END + CASE WHEN outlier_rate > 2 THEN 5 ELSE 0 END)"
_SCORE = f"SELECT station_id, CAST(greatest(0, least(100, 100 - {_PEN})) AS DOUBLE) AS health_score FROM ({_HEALTH})"


@query(_HEALTH)
def health_metrics(v):
    return health.station_metrics(v.aq, 720)


@query(f"SELECT station_id, health_score, CASE WHEN health_score >= 80 THEN 'healthy' WHEN health_score >= 50 THEN 'degraded' ELSE 'offline' END AS status FROM ({_SCORE})")
def health_score(v):
    return health.scored(health.station_metrics(v.aq, 720)).select("station_id", "health_score", "status")


@query(f"SELECT count(*) AS stations, count(*) FILTER (health_score >= 80) AS healthy, count(*) FILTER (health_score >= 50 AND health_score < 80) AS degraded, count(*) FILTER (health_score < 50) AS offline, round(count(*) FILTER (health_score >= 80) * 100.0 / count(*), 6) AS healthy_pct, round(avg(health_score), 6) AS mean_score, list_sort(list(health_score))[count(*) // 2 + 1] AS median_score FROM ({_SCORE})")
def agg_health_summary(v):
    return health.health_summary(health.scored(health.station_metrics(v.aq, 720)))


@query(f"SELECT station_id, health_score FROM ({_SCORE}) ORDER BY health_score DESC")
def sort_health_desc(v):
    return health.scored(health.station_metrics(v.aq, 720)).select("station_id", "health_score").orderBy(F.desc("health_score"), "station_id")


# Features
_RANGE = "(PARTITION BY location_id, h.pollutant ORDER BY epoch(hour_start) RANGE BETWEEN {} PRECEDING AND {} PRECEDING)"


def _over(low: int, high: int) -> str:
    return _RANGE.format(low * 3600, high * 3600)


def _imputed() -> str:
    lags = [f"CASE WHEN max(value) OVER {_over(k, k)} IS NULL AND coalesce(last_value(value IGNORE NULLS) OVER {_over(k + 3, k)}, c.historical_median) IS NOT NULL THEN 1 ELSE 0 END" for k in features.LAGS]
    means = [f"CASE WHEN avg(value) OVER {_over(w, 1)} IS NULL THEN 1 ELSE 0 END" for w in (*features.MEANS, 24)]
    return "CAST(" + " + ".join(lags + means) + " AS INT)"


_FEATURES = "SELECT location_id, h.pollutant, hour_start, " + ", ".join([*(f"coalesce(last_value(value IGNORE NULLS) OVER {_over(k + 3, k)}, c.historical_median) AS lag_{k}h" for k in features.LAGS), *(f"round(coalesce(avg(value) OVER {_over(w, 1)}, c.historical_median), 6) AS mean_{w}h" for w in features.MEANS), *(f"round(CASE WHEN count(value) OVER {_over(w, 1)} < 2 THEN 0.0 ELSE stddev_pop(value) OVER {_over(w, 1)} END, 6) AS std_{w}h" for w in features.STDS), f"coalesce(max(value) OVER {_over(24, 1)}, c.p99, c.historical_median) AS max_24h", f"{_imputed()} AS imputation_count"]) + " FROM hourly h LEFT JOIN citywide c ON h.pollutant = c.pollutant"


@query(_FEATURES)
def feat_generate(v):
    return features.pollutant_features(v.hourly, v.hourly, v.citywide)


@query("SELECT location_id, h.pollutant, hour_start, last_value(value IGNORE NULLS) OVER " + _over(4, 1) + " AS filled FROM hourly h")
def asof_ffill(v):
    rows = v.hourly.withColumn("epoch", F.unix_seconds(F.col("hour_start").cast("timestamp")))
    return rows.select("location_id", "pollutant", "hour_start", features.lag_filled("value", ["location_id", "pollutant"], 1).alias("filled"))


_WX = "(PARTITION BY location_id ORDER BY epoch(hour_start) RANGE BETWEEN {} PRECEDING AND {} PRECEDING)"


def _filled(c: str) -> str:
    return f"coalesce(last_value({c} IGNORE NULLS) OVER {_WX.format(4 * 3600, 3600)}, {c}_mean)"


def _wx_sql(targets: str) -> str:
    """Weather features of the hours of ``targets``, over the grid of these and the weather's own hours."""
    mean = lambda c, w: f"round(avg({c}) OVER {_WX.format(w * 3600, 3600)}, 6)"
    lags = [f"{_filled(c)} AS {c}_lag_1h" for c in features.WEATHER]
    means = [f"coalesce({mean(c, w)}, {c}_mean) AS {c}_mean_{w}h" for c in features.WEATHER_MEANS for w in (6, 24)]
    wind = [f"round({f}({_filled('wind_direction')} * pi() / 180), 6) + 0.0::DOUBLE AS {n}" for f, n in (("sin", "wind_x"), ("cos", "wind_y"))]
    imputed = [f"CASE WHEN max({c}) OVER {_WX.format(3600, 3600)} IS NULL AND {_filled(c)} IS NOT NULL THEN 1 ELSE 0 END" for c in features.WEATHER]
    imputed += [f"CASE WHEN {mean(c, w)} IS NULL THEN 1 ELSE 0 END" for c in features.WEATHER_MEANS for w in (6, 24)]
    city = ", ".join(f"round(avg({c}), 6) AS {c}_mean" for c in features.WEATHER)
    grid = f"(SELECT location_id, hour_start FROM {targets} UNION SELECT location_id, hour_start FROM wx_hours) LEFT JOIN wx_hours USING (location_id, hour_start) CROSS JOIN (SELECT {city} FROM wx_hours)"
    rows = f"SELECT location_id, hour_start, {', '.join([*lags, *means, *wind])}, CAST({' + '.join(imputed)} AS INT) AS weather_imputation_count FROM {grid}"
    return f"SELECT * FROM ({rows}) WHERE (location_id, hour_start) IN (SELECT (location_id, hour_start) FROM {targets})"


@query(_wx_sql("wx_hours"))
def feat_weather(v):
    return features.weather_features(v.wx_hours, v.wx_hours, features.citywide_weather(v.wx_hours))


_CALENDAR = "CAST(hour(hour_start) AS INT) AS hour_of_day, CAST(isodow(hour_start) - 1 AS INT) AS day_of_week, CAST(month(hour_start) AS INT) AS month, CAST(dayofyear(hour_start) AS INT) AS day_of_year, CASE WHEN isodow(hour_start) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(hour(hour_start) AS INT) AS hour_since_midnight, CASE WHEN month(hour_start) IN (12, 1, 2) THEN 0 WHEN month(hour_start) <= 5 THEN 1 WHEN month(hour_start) <= 8 THEN 2 ELSE 3 END AS season"


@query(f"SELECT location_id, hour_start, {_CALENDAR} FROM wx_hours")
def feat_calendar(v):
    return v.wx_hours.select("location_id", "hour_start", *(c.alias(n) for n, c in features.calendar(F.col("hour_start")).items()))


@query("SELECT location_id, hour_start, round(degrees(sin(radians(wind_direction))), 6) + 0.0::DOUBLE AS x, round(cos(wind_direction * pi() / 180), 6) + 0.0::DOUBLE AS y FROM wx_hours")
def feat_wind_xy(v):
    return v.wx_hours.select("location_id", "hour_start", (r6(F.degrees(F.sin(F.radians("wind_direction")))) + 0.0).alias("x"), (r6(F.cos(F.col("wind_direction") * F.pi() / 180)) + 0.0).alias("y"))


@query(f"SELECT f.* EXCLUDE (imputation_count), w.* EXCLUDE (location_id, hour_start, weather_imputation_count), {_CALENDAR}, CAST(f.imputation_count + coalesce(w.weather_imputation_count, 0) AS INT) AS imputation_count, 60 AS horizon_minutes, '1.0.0' AS feature_version FROM ({_FEATURES}) f LEFT JOIN ({_wx_sql('hourly')}) w USING (location_id, hour_start)")
def feature_table(v):
    return features.feature_table(v.hourly, v.hourly, v.citywide, v.wx_hours, citywide_wx=features.citywide_weather(v.wx_hours))


# Forecasts and models
def _shift(minutes: int) -> str:
    return f"SELECT h.location_id, h.pollutant, h.hour_start, h.value, p.value AS prediction, CASE WHEN p.value IS NOT NULL THEN 'high' ELSE 'low' END AS confidence FROM hourly h LEFT JOIN hourly p ON p.location_id = h.location_id AND p.pollutant = h.pollutant AND p.hour_start = h.hour_start - INTERVAL {minutes} MINUTE"


_ROLLING = "SELECT h.location_id, h.pollutant, h.hour_start, round(avg(p.value), 6) AS prediction, CASE WHEN count(p.value) / 7.0 >= 0.9 THEN 'high' WHEN count(p.value) / 7.0 >= 0.7 THEN 'medium' ELSE 'low' END AS confidence, count(p.value) AS days_used FROM hourly h CROSS JOIN range(1, 8) d(k) LEFT JOIN hourly p ON p.location_id = h.location_id AND p.pollutant = h.pollutant AND p.hour_start = h.hour_start - to_days(CAST(d.k AS INT)) GROUP BY ALL"


@query(_shift(180))
def fc_naive(v):
    return forecast.naive(v.hourly, v.hourly, 180)


@query(_shift(1440))
def fc_same_hour_yesterday(v):
    return forecast.same_hour_yesterday(v.hourly, v.hourly)


@query(_ROLLING)
def fc_rolling_mean(v):
    return forecast.rolling_mean(v.hourly, v.hourly)


@query(f"SELECT round(avg(abs(value - prediction)), 6) AS mae, round(sqrt(avg((value - prediction) ** 2)), 6) AS rmse, count(*) AS valid_count FROM ({_shift(60)}) WHERE prediction IS NOT NULL")
def agg_forecast_eval(v):
    return forecast.evaluate(forecast.naive(v.hourly, v.hourly, 60).withColumnRenamed("value", "actual"))


@query(f"SELECT round(avg(e), 6) AS mae, round(sqrt(avg(e ** 2)), 6) AS rmse, round(quantile_cont(e, 0.5), 6) AS median_ae, round(avg(CASE WHEN abs(value) > 1e-10 THEN e / abs(value) ELSE 0 END) * 100, 6) AS mape, count(*) AS n FROM (SELECT *, abs(value - prediction) AS e FROM ({_shift(60)}) WHERE prediction IS NOT NULL)")
def agg_model_eval(v):
    return forecast.evaluate_model(forecast.naive(v.hourly, v.hourly, 60).withColumnRenamed("value", "actual"))


@query(f"SELECT round(quantile_cont(value - prediction, 0.05), 6) AS low, round(quantile_cont(value - prediction, 0.95), 6) AS high, count(*) AS n FROM ({_shift(60)}) WHERE prediction IS NOT NULL")
def agg_residual_pct(v):
    return forecast.residual_interval(forecast.naive(v.hourly, v.hourly, 60).withColumnRenamed("value", "actual"))


_EVALS = " UNION ALL ".join(f"SELECT '{n}' AS model, round(avg(abs(value - prediction)), 6) AS mae FROM ({q}) WHERE prediction IS NOT NULL" for n, q in (("naive", _shift(60)), ("yesterday", _shift(1440))))


def _evals(v):
    return (
        forecast.evaluate(forecast.naive(v.hourly, v.hourly, 60).withColumnRenamed("value", "actual")).select(F.lit("naive").alias("model"), "mae")
        .unionByName(forecast.evaluate(forecast.same_hour_yesterday(v.hourly, v.hourly).withColumnRenamed("value", "actual")).select(F.lit("yesterday").alias("model"), "mae"))
    )


@query(f"SELECT model, mae FROM ({_EVALS}) ORDER BY mae")
def model_rank(v):
    return _evals(v).where("mae is not null").orderBy("mae")


@query(f"SELECT arg_min(model, mae) AS model, min(mae) AS mae FROM ({_EVALS})")
def model_best_baseline(v):
    return forecast.best_model(_evals(v))


@query(f"SELECT model, mae * 0.9::DOUBLE AS threshold FROM ({_EVALS})")
def model_threshold(v):
    return _evals(v).select("model", forecast.threshold(F.col("mae"), 10.0).alias("threshold"))


@query("SELECT raw_payload_hash, CASE WHEN value <= 0 THEN true ELSE (value - 40.0) / value * 100 >= 5 END AS promote FROM aq_first")
def model_promote(v):
    return v.aq_first.select("raw_payload_hash", forecast.promotes(F.col("value"), F.lit(40.0)).alias("promote"))


@query(f"SELECT h.location_id, h.pollutant, h.hour_start, round(p.value * 0.9, 6) AS lower, round(p.value * 1.1, 6) AS upper, 0.5::DOUBLE AS interval_confidence FROM hourly h JOIN hourly p ON p.location_id = h.location_id AND p.pollutant = h.pollutant AND p.hour_start = h.hour_start - INTERVAL 60 MINUTE")
def predict_baseline(v):
    rows = forecast.naive(v.hourly, v.hourly, 60).where("prediction is not null")
    bounds = forecast.interval(F.col("prediction"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(0))
    return rows.select("location_id", "pollutant", "hour_start", *(c.alias(n) for n, c in bounds.items()))


@query("SELECT location_id, pollutant, hour_start, CASE WHEN CAST(hour_start AS DATE) <= DATE '2024-01-21' THEN 'train' WHEN CAST(hour_start AS DATE) <= DATE '2024-01-25' THEN 'validation' WHEN CAST(hour_start AS DATE) <= DATE '2024-01-30' THEN 'test' END AS split FROM hourly")
def split_chrono(v):
    split = forecast.chronological_split(date(2024, 1, 1), date(2024, 1, 30))
    return forecast.with_split(v.hourly, F.to_date("hour_start"), split).drop("value")


@query("SELECT CAST(k AS INT) AS fold, DATE '2024-01-01' AS train_start, CAST(DATE '2024-01-01' + (10 + k * 7 - 1)::INT AS DATE) AS train_end, CAST(DATE '2024-01-01' + (10 + k * 7)::INT AS DATE) AS test_start, least(CAST(DATE '2024-01-01' + (10 + k * 7 + 6)::INT AS DATE), DATE '2024-01-30') AS test_end FROM range(0, 10) r(k) WHERE DATE '2024-01-01' + (10 + k * 7)::INT <= DATE '2024-01-30'")
def split_walk_forward(v):
    bounds = v.spark.sql("select date'2024-01-01' as start, date'2024-01-30' as end")
    return forecast.walk_forward(bounds, 10, 7)


_PAIRS = "SELECT h.location_id, h.pollutant, h.hour_start, h.value, a.value AS lag_1h, b.value AS lag_24h FROM hourly h LEFT JOIN hourly a ON a.location_id = h.location_id AND a.pollutant = h.pollutant AND a.hour_start = h.hour_start - INTERVAL 1 HOUR LEFT JOIN hourly b ON b.location_id = h.location_id AND b.pollutant = h.pollutant AND b.hour_start = h.hour_start - INTERVAL 24 HOUR"
_FITTED = f"SELECT p.*, f.a + f.b * lag_24h AS fitted FROM ({_PAIRS}) p, (SELECT regr_intercept(value, lag_24h) AS a, regr_slope(value, lag_24h) AS b FROM ({_PAIRS})) f"


def _pairs(v):
    at = lambda minutes, name: forecast.shifted(v.hourly.select("location_id", "pollutant", "hour_start"), v.hourly, minutes).select("location_id", "pollutant", "hour_start", F.col("prediction").alias(name))
    keys = ["location_id", "pollutant", "hour_start"]
    return v.hourly.join(at(60, "lag_1h"), keys, "left").join(at(1440, "lag_24h"), keys, "left")


@query(f"SELECT round(avg(e), 6) AS mae, round(sqrt(avg(e ** 2)), 6) AS rmse, round(quantile_cont(e, 0.5), 6) AS median_ae, round(avg(CASE WHEN abs(value) > 1e-10 THEN e / abs(value) ELSE 0 END) * 100, 6) AS mape, count(*) AS n FROM (SELECT *, abs(value - fitted) AS e FROM ({_FITTED}) WHERE fitted IS NOT NULL)")
def train_linear(v):
    table = _pairs(v)
    return ml.training_metrics(ml.train(table, "value", "linear", ["lag_24h"]), table, "value")


@query(f"""SELECT location_id, pollutant, hour_start, CAST(h AS INT) AS horizon_minutes, round(coalesce(m, lag_1h), 6) AS prediction, CASE WHEN m IS NOT NULL THEN 'model' WHEN lag_1h IS NOT NULL THEN 'baseline' ELSE 'error' END AS method,
round(CASE WHEN m IS NOT NULL AND n >= 10 THEN m + low ELSE coalesce(m, lag_1h) * 0.9::DOUBLE END, 6) AS lower, round(CASE WHEN m IS NOT NULL AND n >= 10 THEN m + high ELSE coalesce(m, lag_1h) * 1.1::DOUBLE END, 6) AS upper,
CASE WHEN m IS NOT NULL AND n >= 10 THEN round(greatest(0.1, least(0.9, 1 - (high - low) / 100)), 6) WHEN coalesce(m, lag_1h) IS NOT NULL THEN 0.5 END::DOUBLE AS interval_confidence
FROM (SELECT location_id, pollutant, hour_start, lag_1h, h, CASE WHEN h = 60 THEN fitted END AS m FROM ({_FITTED}), unnest([60, 180, 360]) t(h)),
(SELECT round(quantile_cont(value - fitted, 0.05), 6) AS low, round(quantile_cont(value - fitted, 0.95), 6) AS high, count(*) AS n FROM ({_FITTED}) WHERE fitted IS NOT NULL)""")
def predict_horizons(v):
    table = _pairs(v)
    model = ml.train(table, "value", "linear", ["lag_24h"])
    residuals = forecast.residual_interval(ml.predictions(model, table).withColumnRenamed("value", "actual"))
    return ml.predict_horizons(table, {60: model}, {60: residuals})


# Scalars
_ISO = "strftime(observed_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(observed_at) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(observed_at) % 1000000 AS VARCHAR), 6, '0') END || '+00:00'"


@query(f"SELECT raw_payload_hash, sha256(lower(source || '|' || station_id || '|' || sensor_id || '|' || pollutant || '|' || {_ISO})) AS measurement_key FROM aq_first")
def measurement_key(v):
    return v.aq_first.select("raw_payload_hash", S.measurement_key().alias("measurement_key"))


@query(f"SELECT raw_payload_hash, sha256(lower(source || '|' || location_id || '|' || {_ISO})) AS weather_key FROM wx")
def weather_key(v):
    return v.wx.select("raw_payload_hash", S.weather_key().alias("weather_key"))


@query(f"SELECT raw_payload_hash, {_ISO} AS iso, date_trunc('hour', observed_at) AS floor_hour, CASE WHEN date_trunc('hour', observed_at) = observed_at THEN observed_at ELSE date_trunc('hour', observed_at) + INTERVAL 1 HOUR END AS ceil_hour, strftime(observed_at, 'year=%Y/month=%m/day=%d') AS partition_path, observed_at + INTERVAL 330 MINUTE AS ist, round(epoch(observed_at), 3) AS epoch_s FROM aq_first")
def time_functions(v):
    t = F.col("observed_at")
    return v.aq_first.select("raw_payload_hash", S.iso_utc(t).alias("iso"), S.hour_floor(t).alias("floor_hour"), S.hour_ceil(t).alias("ceil_hour"), F.date_format(t, "'year='yyyy'/month='MM'/day='dd").alias("partition_path"), F.from_utc_timestamp(t, "Asia/Kolkata").cast("timestamp_ntz").alias("ist"), F.round(S.epoch_seconds(t), 3).alias("epoch_s"))


@query("SELECT station_id, unnest(generate_series(min(date_trunc('day', observed_at)), min(date_trunc('day', observed_at)) + INTERVAL 47 HOUR, INTERVAL 1 HOUR)) AS hour_start FROM aq_first GROUP BY station_id")
def hour_range(v):
    first = v.aq_first.groupBy("station_id").agg(F.min(F.date_trunc("day", "observed_at")).cast("timestamp_ntz").alias("low"))
    return first.select("station_id", F.explode(F.expr("sequence(low, low + interval 47 hours, interval 1 hour)")).alias("hour_start"))


@query("SELECT raw_payload_hash, round(2 * 6371.0 * asin(sqrt(least(1.0, sin(radians(lat2 - lat1) / 2) ** 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2))), 4) AS km, CAST(trunc(lat2 * 1000000.0::DOUBLE) AS BIGINT) AS lat_micro FROM (SELECT raw_payload_hash, 22.5::DOUBLE AS lat1, 88.25::DOUBLE AS lon1, CAST(value % 90 AS DOUBLE) AS lat2, CAST(CAST(raw_payload_hash AS BIGINT) % 180 AS DOUBLE) AS lon2 FROM aq_first)")
def haversine(v):
    rows = v.aq_first.select("raw_payload_hash", F.lit(22.5).alias("lat1"), F.lit(88.25).alias("lon1"), (F.col("value") % 90).alias("lat2"), (F.col("raw_payload_hash").cast("bigint") % 180).cast("double").alias("lon2"))
    return rows.select("raw_payload_hash", F.round(S.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")), 4).alias("km"), S.micro_degrees(F.col("lat2")).alias("lat_micro"))


# Late data, watermarks
@query(f"SELECT raw_payload_hash, CASE WHEN TIMESTAMP '{NOW}' - observed_at <= INTERVAL 1 HOUR THEN 'IMMEDIATE' WHEN TIMESTAMP '{NOW}' - observed_at <= INTERVAL 6 HOUR THEN 'RECENT' ELSE 'BACKFILL' END AS late_class FROM aq_first")
def late_classify(v):
    return v.aq_first.select("raw_payload_hash", late.late_class(F.col("observed_at"), now()).alias("late_class"))


@query(f"SELECT DISTINCT CAST(observed_at AS DATE) AS date, CAST(hour(observed_at) AS INT) AS hour FROM aq_first WHERE observed_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR")
def late_affected_hours(v):
    return late.affected_hours(v.aq_first, now(), 24)


@query("SELECT DISTINCT CAST(observed_at AS DATE) AS date, CAST(hour(observed_at) AS INT) AS hour FROM aq_first")
def set_distinct_partitions(v):
    return v.aq_first.select(F.to_date("observed_at").alias("date"), F.hour("observed_at").alias("hour")).distinct()


@query("SELECT CAST(o_custkey % 3 AS INT) AS source_id, arg_max(o_orderdate, (o_orderdate, o_orderkey)) AS requested_end, max(o_orderkey) FILTER (o_orderdate = md) AS run FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey % 3) AS md FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def top1_watermark(v):
    runs = v.table("orders").where("o_orderstatus = 'F'").selectExpr("CAST(o_custkey % 3 AS INT) AS source_id", "o_orderdate", "o_orderkey")
    return runs.groupBy("source_id").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("x")).select("source_id", F.col("x.o_orderdate").alias("requested_end"), F.col("x.o_orderkey").alias("run"))


@query("SELECT source_id, coalesce(last_event, TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 6 HOUR) AS query_start FROM (SELECT station_id AS source_id, max(observed_at) FILTER (value > 99) AS last_event FROM aq_first GROUP BY station_id)")
def wm_query_start(v):
    rows = v.aq_first.groupBy(F.col("station_id").alias("source_id")).agg(F.max(F.when(F.col("value") > 99, F.col("observed_at"))).alias("last_event"))
    return rows.select("source_id", late.query_start(F.col("last_event"), now(), 6).alias("query_start"))


@query("SELECT CAST(o_custkey % 3 AS VARCHAR) AS source_id, arg_max(CAST(o_orderdate AS TIMESTAMP), (f, o_orderdate)) AS requested_end, max(f) AS finished_at FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 4 AS INT)) AS f FROM orders WHERE o_orderstatus = 'F') GROUP BY 1 HAVING count(*) > 0")
def wm_latest(v):
    runs = v.table("orders").selectExpr("CAST(o_custkey % 3 AS STRING) AS source_id", "if(o_orderstatus = 'F', 'success', 'failed') AS status", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS requested_end", "CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(CAST(o_orderkey % 4 AS INT)) AS finished_at")
    return late.latest_watermark(runs)


@query(f"SELECT raw_payload_hash, CASE WHEN observed_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR THEN 'lookback' ELSE 'backfill' END AS part, TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AS range_start, TIMESTAMP '{NOW}' AS range_end FROM aq_first")
def late_split(v):
    recent, rest = late.split_by_lookback(v.aq_first, now(), 24)
    low, high = late.lookback_range(now(), 24)
    part = lambda rows, name: rows.select("raw_payload_hash", F.lit(name).alias("part"), low.alias("range_start"), high.alias("range_end"))
    return part(recent, "lookback").unionByName(part(rest, "backfill"))


@query(f"SELECT raw_payload_hash, sha256('openaq|' || station_id || '|' || sensor_id || '|' || pollutant || '|' || {_ISO}) AS own_key, md5('https://api.test/v3?id=' || raw_payload_hash) AS cache_key, strftime(observed_at, 'year=%Y/month=%m/day=%d/hour=%H') AS hour_path, observed_at - INTERVAL 3 DAY AS days_before FROM aq_first")
def connector_keys(v):
    t = F.col("observed_at")
    own = S.connector_key("openaq", F.col("station_id"), F.col("sensor_id"), F.col("pollutant"), S.iso_utc(t))
    url = F.concat(F.lit("https://api.test/v3?id="), F.col("raw_payload_hash"))
    return v.aq_first.select("raw_payload_hash", own.alias("own_key"), S.url_cache_key(url).alias("cache_key"), S.hour_path(t).alias("hour_path"), S.days_ago(t, 3).alias("days_before"))


# Landed payloads, partitions, quarantine
@query("SELECT source, station_id, sensor_id, pollutant, value, unit, date_trunc('second', observed_at) AS observed_at FROM (SELECT *, CASE WHEN unit = 'mg/m³' THEN value * 1000.0 ELSE value END AS v FROM aq_first) WHERE CAST(station_id AS INT) <> 0 AND CAST(sensor_id AS BIGINT) <> 0 AND value IS NOT NULL".replace("pollutant, value, unit", "pollutant, v AS value, CASE WHEN unit = 'mg/m³' THEN 'µg/m³' ELSE unit END AS unit"))
def parse_openaq(v):
    result = "named_struct('location', named_struct('id', CAST(station_id AS BIGINT)), 'sensor', named_struct('id', CAST(sensor_id AS BIGINT)), 'parameter', named_struct('id', upper(pollutant)), 'value', value, 'unit', unit, 'date', named_struct('utc', date_format(observed_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")))"
    page = v.aq_first.selectExpr("CAST(raw_payload_hash AS BIGINT) DIV 50 AS page", f"{result} AS result").groupBy("page").agg(F.collect_list("result").alias("results"))
    payloads = page.select(F.to_json(F.struct("results")).alias("payload"), now().alias("ingested_at"))
    return landing.parse_measurements(payloads).drop("ingested_at", "raw_payload_hash")


@query("SELECT source, location_id, date_trunc('minute', observed_at) AS observed_at, temperature_c, humidity_pct, wind_speed_kmh, wind_direction_deg, pressure_hpa, precipitation_mm, cloud_cover_pct FROM wx WHERE temperature_c BETWEEN -60 AND 60 AND humidity_pct BETWEEN 0 AND 100 AND wind_speed_kmh BETWEEN 0 AND 200 AND wind_direction_deg BETWEEN 0 AND 360 AND pressure_hpa BETWEEN 900 AND 1100 AND precipitation_mm BETWEEN 0 AND 1000 AND cloud_cover_pct BETWEEN 0 AND 100")
def parse_open_meteo(v):
    hour = F.struct(F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm").alias("time"), *landing.HOURLY_COLUMNS.values())
    page = v.wx.withColumn("page", F.expr("CAST(raw_payload_hash AS BIGINT) DIV 50")).groupBy("location_id", "page").agg(F.collect_list(hour).alias("h"))
    arrays = F.struct(F.col("h.time").alias("time"), *(F.col(f"h.{b}").alias(a) for a, b in landing.HOURLY_COLUMNS.items()))
    payloads = page.select("location_id", F.to_json(F.struct(arrays.alias("hourly"))).alias("payload"), now().alias("ingested_at"))
    return landing.parse_hourly_weather(payloads).drop("ingested_at", "raw_payload_hash")


@query("SELECT source, station_id, sensor_id, pollutant, value, unit, observed_at, ingested_at, raw_payload_hash, 'run-1' AS run_id FROM aq_first WHERE observed_at >= TIMESTAMP '2024-01-05' AND observed_at < TIMESTAMP '2024-01-08' AND value IS NOT NULL")
def scan_partition_range(v):
    root = landing.landing_dir(v.spark, "raw")
    landing.write_raw(v.aq_first.where("value is not null"), root, "air_quality", "run-1")
    return landing.read_raw(v.spark, root, "air_quality", date(2024, 1, 5), date(2024, 1, 7))


@query("SELECT raw_payload_hash, class, CAST(len(warnings) + CASE WHEN failure IS NULL THEN 0 ELSE 1 END AS INT) AS reasons FROM classified WHERE class = 'SUSPICIOUS'")
def quarantine_roundtrip(v):
    root = landing.landing_dir(v.spark, "quarantine")
    landing.quarantine(v.classified, root)
    return landing.read_quarantine(v.spark, root, "suspicious").select("raw_payload_hash", "class", F.size("reasons").alias("reasons"))


@query("SELECT raw_payload_hash, value FROM aq_first WHERE CAST(raw_payload_hash AS BIGINT) % 3 <> 0")
def control_plane_upsert(v):
    rows = v.aq_first.select("raw_payload_hash", "value")
    return landing.upsert_new(rows.where("CAST(raw_payload_hash AS BIGINT) % 3 = 0"), rows.unionByName(rows), ["raw_payload_hash"])


# Sorts and limits
@query("SELECT * FROM anomalies ORDER BY location_id, pollutant, hour_start")
def sort_anomalies(v):
    return v.anomalies.orderBy("location_id", "pollutant", "hour_start")


@query("SELECT event_id, location_id, pollutant, start_time FROM events_found ORDER BY location_id, pollutant, start_time")
def sort_events(v):
    return v.events.select("event_id", "location_id", "pollutant", "start_time").orderBy("location_id", "pollutant", "start_time")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def topk_recent_runs(v):
    return v.table("orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)


@query(f"SELECT * FROM anomalies WHERE location_id = 'loc1' AND severity IN ('HIGH', 'EXTREME') AND hour_start >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR")
def sort_recent_high(v):
    return v.anomalies.where((F.col("location_id") == "loc1") & F.col("severity").isin("HIGH", "EXTREME") & (F.col("hour_start") >= now() - F.expr("interval 24 hours"))).orderBy(F.desc("hour_start"))


# Serving
@query("SELECT l.location_id, l.city, coalesce(s.n, 0) AS active_stations, m.last_update FROM locations l LEFT JOIN (SELECT location_id, count(*) AS n FROM stations GROUP BY ALL) s USING (location_id) LEFT JOIN (SELECT location_id, max(observed_at) AS last_update FROM aq_mapped GROUP BY ALL) m USING (location_id)")
def srv_locations(v):
    return serving.locations(v.locations, v.stations, v.aq_mapped)


_AGE = f"CAST(floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us({{}})) / 60000000.0) AS BIGINT)"


@query(f"""SELECT x.*, b.p95, w.* EXCLUDE (location_id), 'µg/m³' AS unit, abs(robust_z) AS anomaly_score, CASE WHEN severity IN ('SEVERE', 'EXTREME') THEN 'SUSPICIOUS' ELSE 'VALID' END AS quality_flag, {_AGE.format("hour_start")} AS data_age_minutes, 60 AS expected_interval_minutes,
CASE WHEN {_AGE.format("hour_start")} <= 60 THEN 'fresh' WHEN {_AGE.format("hour_start")} <= 1440 THEN 'stale' ELSE 'missing' END AS freshness
FROM (SELECT location_id, pollutant, max(hour_start) AS hour_start, arg_max(observed_value, hour_start) AS observed_value, arg_max(historical_median, hour_start) AS historical_median, arg_max(robust_z, hour_start) AS robust_z, arg_max(severity, hour_start) AS severity FROM anomalies WHERE location_id = 'loc2' GROUP BY ALL) x
LEFT JOIN month_baselines b USING (location_id, pollutant) LEFT JOIN (SELECT location_id, max(observed_at) AS weather_at, arg_max(temperature_c, observed_at) AS temperature_c, arg_max(humidity_pct, observed_at) AS humidity_pct, arg_max(wind_speed_kmh, observed_at) AS wind_speed_kmh, arg_max(wind_direction_deg, observed_at) AS wind_direction_deg FROM wx_first GROUP BY ALL) w USING (location_id)""".replace("b.p95, w.*", "b.p95, w.*"))
def srv_current(v):
    return serving.current(v.anomalies, v.month_baselines, v.wx_first, "loc2", now())


def _history(unit: str, hours: float, baselines_sql: str, on: str) -> str:
    rows = f"SELECT location_id, pollutant, date_trunc('{unit}', observed_at) AS bucket, round(avg(value_ug), 6) AS mean_value, round(quantile_cont(value_ug, 0.5), 6) AS median_value, min(value_ug) AS min_value, max(value_ug) AS max_value, count(*) AS n, round(count(DISTINCT date_trunc('hour', observed_at)) * 100.0 / {hours}::DOUBLE, 6) AS coverage_pct FROM aq_mapped WHERE location_id = 'loc1' AND pollutant = 'pm25' AND observed_at >= TIMESTAMP '2024-01-03' AND observed_at < TIMESTAMP '2024-01-11' GROUP BY ALL"
    return f"SELECT h.*, b.historical_median AS baseline_median FROM ({rows}) h LEFT JOIN ({baselines_sql}) b ON h.location_id = b.location_id AND h.pollutant = b.pollutant AND month(h.bucket) = b.month{on}"


@query(_history("day", 24.0, f"SELECT location_id, pollutant, month(hour_start) AS month, {STATS} FROM hourly GROUP BY ALL", ""))
def srv_history(v):
    return serving.history(v.aq_mapped, "loc1", "pm25", "2024-01-03", "2024-01-10", "daily", baselines.monthly_baselines(v.hourly))


@query(_history("hour", 1.0, "SELECT * FROM hour_baselines", " AND hour(h.bucket) = b.hour_of_day"))
def srv_history_hourly(v):
    return serving.history(v.aq_mapped, "loc1", "pm25", "2024-01-03", "2024-01-10", "hourly", v.hour_baselines)


@query("SELECT location_id, pollutant, CAST(h AS INT) AS horizon_minutes, max(hour_start) AS made_at, arg_max(value, hour_start) AS prediction, greatest(0.65, 1 - h / 1000.0)::DOUBLE AS confidence_score FROM hourly, unnest([60, 180, 360]) t(h) WHERE location_id = 'loc1' GROUP BY location_id, pollutant, h")
def srv_forecast(v):
    made = v.hourly.select("location_id", "pollutant", F.col("hour_start").alias("made_at"), F.col("value").alias("prediction"), F.explode(F.array(*map(F.lit, SETTINGS.horizons))).alias("horizon_minutes"))
    return serving.latest_forecasts(made, "loc1", (60, 180, 360, 720))


@query("SELECT e.event_id, e.location_id, e.pollutant, e.start_time, e.end_time, round(avg(w.temperature_c), 6) AS mean_temperature_c, round(avg(w.humidity_pct), 6) AS mean_humidity_pct, round(avg(w.wind_speed_kmh), 6) AS mean_wind_speed_kmh FROM events_found e LEFT JOIN wx_first w ON w.location_id = e.location_id AND w.hour_start BETWEEN e.start_time AND e.end_time WHERE e.start_time <= TIMESTAMP '2024-01-20' AND e.end_time >= TIMESTAMP '2024-01-05' GROUP BY ALL")
def srv_events(v):
    return events.events_with_weather(serving.events_between(v.events, "2024-01-05", "2024-01-20"), v.wx_first)


@query(f"SELECT location_id, pollutant, CAST(month(hour_start) AS INT) AS month, CAST(hour(hour_start) AS INT) AS hour_of_day, {STATS} FROM hourly WHERE location_id = 'loc1' AND pollutant = 'pm25' AND month(hour_start) = 1 AND hour(hour_start) = 0 GROUP BY ALL")
def srv_baseline(v):
    return serving.baseline(baselines.hourly_baselines(v.hourly), "loc1", "pm25", 1, 0)


_STATUS = "CASE WHEN {} THEN 'healthy' ELSE 'degraded' END"


@query(f"""SELECT *, CASE WHEN ingestion_status = 'healthy' AND quality_status = 'healthy' AND model_status = 'healthy' THEN 'healthy' ELSE 'degraded' END AS system_status FROM (
SELECT q.*, w.*, m.*, {_STATUS.format("openaq_freshness_minutes <= 10 AND weather_freshness_minutes <= 10")} AS ingestion_status, {_STATUS.format("rejection_rate_pct < 10")} AS quality_status, {_STATUS.format("model_mae IS NOT NULL")} AS model_status
FROM (SELECT age AS openaq_freshness_minutes, records_24h, rejected_24h, coalesce(round(rejected_24h * 100.0 / nullif(records_24h, 0), 6), 0.0) AS rejection_rate_pct FROM (SELECT {_AGE.format("max(ingested_at)")} AS age, count(*) FILTER (ingested_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR) AS records_24h, count(*) FILTER (ingested_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND class = 'INVALID') AS rejected_24h FROM classified)) q,
(SELECT {_AGE.format("max(ingested_at)")} AS weather_freshness_minutes FROM wx) w, (SELECT arg_min(model, mae) AS production_model, min(mae) AS model_mae FROM ({_EVALS})) m)""")
def srv_health(v):
    return serving.system_health(v.classified, v.wx, _evals(v), now())


@query("""SELECT *, CASE WHEN health_score >= 80 THEN 'healthy' WHEN health_score >= 50 THEN 'degraded' WHEN health_score IS NOT NULL THEN 'offline' END AS health FROM (SELECT *, CASE WHEN scope = 'station' THEN round(greatest(0.0, valid_pct - (100 - coverage_pct)), 6) END AS health_score FROM (
SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(location_id) = 0 THEN 'location' WHEN grouping(station_id) = 0 THEN 'station' ELSE 'all' END AS scope, coalesce(source, location_id, station_id) AS name, count(*) AS records, count(*) FILTER (class = 'VALID') AS valid, count(*) FILTER (class = 'SUSPICIOUS') AS suspicious, count(*) FILTER (class = 'INVALID') AS invalid, round(count(*) FILTER (class = 'VALID') * 100.0 / count(*), 6) AS valid_pct,
round(least(100.0, count(DISTINCT date_trunc('hour', observed_at)) * 100.0::DOUBLE / 720), 6) AS coverage_pct
FROM (SELECT c.source, c.station_id, c.class, c.observed_at, coalesce(s.location_id, 'UNMAPPED') AS location_id FROM classified c LEFT JOIN stations s USING (source, station_id)) GROUP BY GROUPING SETS ((), (source), (location_id), (station_id))))""")
def srv_quality(v):
    return serving.quality_report(facts.with_location(v.classified, v.stations).select("source", "location_id", "station_id", "observed_at", "class"), 720)


@query("SELECT source, location_id, hour_start, round(((degrees(atan2(avg(sin(radians(wind_direction_deg))), avg(cos(radians(wind_direction_deg))))) + 360) % 360 + 360) % 360, 6) AS wind_direction_circular FROM wx_first GROUP BY ALL")
def x_circular_wind(v):
    return facts.circular_wind(v.wx_first)
