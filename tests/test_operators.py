"""Operators on small fixtures with values worked out by hand, at and around their thresholds."""

import json
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger import config
from skyledger.functions import scalars
from skyledger.operators import anomaly, baselines, dedup, events, facts, features, forecast, health, late, ml, quality, serving
from skyledger.plans.views import WRITTEN, Views
from skyledger.schemas import ContractError
from skyledger.sources import control, landing
from skyledger.streaming.hourly import hourly_facts, rewrite_affected_hours

BASE = datetime(2031, 3, 4, 6)
AQ = "source string, station_id string, sensor_id string, pollutant string, value double, unit string, observed_at timestamp_ntz, ingested_at timestamp_ntz, raw_payload_hash string"
SERIES = "location_id string, pollutant string, hour_start timestamp_ntz, value double"


def aq(spark, *changes):
    row = {"source": "openaq", "station_id": "7001", "sensor_id": "88", "pollutant": "no2", "value": 17.25, "unit": "µg/m³", "observed_at": BASE, "ingested_at": BASE + timedelta(minutes=9), "raw_payload_hash": "h0"}
    return spark.createDataFrame([tuple({**row, **c}.values()) for c in changes], AQ)


UNIT = 1.4826 * 4  # one deviation where the median is 20 and the absolute deviation 4


@pytest.mark.parametrize(("z", "level"), [(1.99, "NORMAL"), (2.01, "ELEVATED"), (2.99, "ELEVATED"), (-3.01, "HIGH"), (3.99, "HIGH"), (4.01, "SEVERE"), (-4.99, "SEVERE"), (5.01, "EXTREME")])
def test_robust_z_around_levels(spark, z, level):
    df = spark.createDataFrame([(20 + z * UNIT, 20.0, 4.0)], "x double, m double, d double").withColumn("z", anomaly.robust_z(F.col("x"), F.col("m"), F.col("d")))
    got = df.withColumn("s", anomaly.severity(F.col("z"))).first()
    assert got.s == level and abs(got.z - z) < 1e-9


@pytest.mark.parametrize(("x", "median", "z"), [(16.0, 8.0, 3.0), (15.9, 8.0, 0.0), (4.0, 8.0, -3.0), (4.1, 8.0, 0.0), (100.5, 0.0, 5.0), (100.0, 0.0, 0.0), (-101.0, 0.0, 5.0)])
def test_z_without_a_deviation(spark, x, median, z):
    assert spark.range(1).select(anomaly.robust_z(F.lit(x), F.lit(median), F.lit(0.0)).alias("z")).first().z == z


def test_severity_without_a_baseline(spark):
    assert spark.range(1).select(anomaly.severity(F.lit(None).cast("double")).alias("s")).first().s == "NORMAL"


def series(spark, offsets, severity="SEVERE", location="harbour"):
    return spark.createDataFrame([(location, "no2", BASE + timedelta(hours=h), 61.0 + i, 4.2, severity) for i, h in enumerate(offsets)], "location_id string, pollutant string, hour_start timestamp_ntz, observed_value double, robust_z double, severity string")


@pytest.mark.parametrize(("offsets", "counts"), [([5, 6, 7], [3]), ([5, 7, 9], [3]), ([5, 7, 9.1], []), ([5, 6], []), ([5, 6, 7, 7.5, 8.5, 9.5], [6]), ([5, 6, 7, 9, 10, 11], [3, 3]), (range(6, 10), [3]), (range(6, 12), [6]), ([1, 2, 3, 40, 41, 42], [3, 3])])
def test_event_runs(spark, offsets, counts):
    got = events.detect_events(series(spark, list(offsets))).orderBy("start_time").collect()
    assert [r.anomaly_count for r in got] == counts


def test_event_ids_are_stable_and_elevated_is_no_event(spark):
    first, again = (events.detect_events(series(spark, [0, 1, 2])).first().event_id for _ in range(2))
    assert first == again and len(first) == 36
    assert events.detect_events(series(spark, [0, 1, 2], "ELEVATED")).isEmpty()


def model_spans(times):
    out, i = [], 0
    while i < len(times):
        if i + 2 < len(times) and times[i + 1] - times[i] == 1 and times[i + 2] - times[i + 1] == 1:
            last = i + 2
        else:
            inside = [k for k in range(i, len(times)) if times[k] <= times[i] + 4]
            last = inside[-1] if len(inside) >= 3 else None
        if last is None:
            i += 1
        else:
            out.append((i + 1, last + 1))
            i = last + 1
    return out


def test_greedy_scan_against_a_model(spark):
    rng = random.Random(5)
    groups = {f"g{g}": sorted(rng.sample([h / 2 for h in range(160)], rng.randint(1, 60))) for g in range(40)}
    rows = [(g, "no2", BASE + timedelta(hours=t), 100.0 + t, 3.5, "HIGH") for g, ts in groups.items() for t in ts]
    df = spark.createDataFrame(rows, "location_id string, pollutant string, hour_start timestamp_ntz, observed_value double, robust_z double, severity string")
    got = {}
    for r in events.greedy_spans(events.candidate_ends(df)).collect():
        got.setdefault(r.location_id, []).append((r["first"], r["last"]))
    spans = {g: model_spans(ts) for g, ts in groups.items() if model_spans(ts)}
    assert {g: sorted(s) for g, s in got.items()} == spans
    found = {(r.location_id, r["first"]): (r.anomaly_count, r.peak_value) for r in events.raw_events(events.candidate_ends(df)).collect()}
    assert found == {(g, a): (z - a + 1, 100.0 + groups[g][z - 1]) for g, s in spans.items() for a, z in s}


@pytest.mark.parametrize(("metrics", "score", "status"), [((92, 8, 5, 5, 10, 2), 100, "healthy"), ((80, 10, 0, 0, 0, 0), 100, "healthy"), ((79.5, 0, 5.1, 0, 0, 0), 60, "degraded"), ((99, 10.5, 0, 0, 10.5, 2.5), 65, "degraded"), ((3, 97, 60, 70, 80, 90), 15, "offline")])
def test_health(spark, metrics, score, status):
    df = spark.createDataFrame([tuple(map(float, metrics))], "availability_pct double, missing_rate double, duplicate_rate double, stale_rate double, flatline_rate double, outlier_rate double")
    got = health.scored(df).first()
    assert (got.health_score, got.status) == (score, status) and (score == 100) == (not got.penalties_applied)


def test_health_summary_takes_the_upper_median(spark):
    scores = spark.createDataFrame([(float(s), "healthy" if s >= 80 else "offline") for s in (100, 10, 85, 40)], "health_score double, status string")
    got = health.health_summary(scores).first()
    assert (got.stations, got.healthy, got.offline, got.degraded, got.median_score, got.mean_score, got.healthy_pct) == (4, 2, 2, 0, 85.0, 58.75, 50.0)
    assert health.health_summary(scores.limit(0)).first().stations == 0


def test_rules_and_classes(spark):
    late_one = BASE + timedelta(hours=1, minutes=1)
    df = aq(spark, {}, {"value": -0.5}, {"unit": "furlong"}, {"value": None}, {"observed_at": late_one}, {"observed_at": BASE + timedelta(hours=1)}, {"value": 200.5}, {"value": 200.0}, {"value": 70.0}, {"unit": "furlong", "observed_at": late_one})
    got = [(r["class"], r.failure, r.warnings) for r in quality.classify_air_quality(df, F.lit(BASE).cast("timestamp_ntz")).collect()]
    assert [g[0] for g in got] == ["VALID", "INVALID", "SUSPICIOUS", "INVALID", "INVALID", "VALID", "SUSPICIOUS", "SUSPICIOUS", "SUSPICIOUS", "INVALID"]
    assert got[3][1] == "missing value" and got[9][2] == ["unknown unit"] and got[7][2] == ["suspiciously round"]


def test_location_aggregate(spark):
    values = {"p": [12.0, 18.0], "q": [3.0], "r": [21.0, 27.0, 30.0, 33.0]}
    df = spark.createDataFrame([("harbour", s, "o3", BASE, v) for s, vs in values.items() for v in vs], "location_id string, station_id string, pollutant string, observed_at timestamp_ntz, value_ug double")
    got = facts.location_hourly(df).first()
    assert (got.n, got.active_stations, got.median_value, got.p25, got.p75, got.max_value, got.min_value) == (7, 3, 21.0, 15.0, 28.5, 33.0, 3.0)


def test_mart_uses_the_baseline_of_its_month_and_hour(spark):
    hourly = facts.air_quality_hourly(aq(spark, *({"value": v, "raw_payload_hash": f"h{v}"} for v in (10.0, 11.0, 12.005, 40.0))).withColumn("value_ug", F.col("value")))
    stations = spark.createDataFrame([("openaq", "7001", "harbour")], "source string, station_id string, location_id string")
    kinds = "location_id string, pollutant string, month int, hour_of_day int, historical_median double, mad double, p90 double, p95 double, p99 double"
    base = spark.createDataFrame([("harbour", "no2", 3, 6, 5.0, 2.0, 8.0, 9.0, 9.5), ("harbour", "no2", 3, 7, 99.0, 0.5, 1.0, 1.0, 1.0), ("harbour", "no2", 4, 6, 99.0, 0.5, 1.0, 1.0, 1.0)], kinds)
    got = facts.air_quality_mart(facts.with_baselines(hourly, stations, base)).collect()
    assert len(got) == 1 and (float(got[0].median_value), got[0].baseline_median, got[0].baseline_p95, got[0].anomaly_flag, float(got[0].coverage_pct)) == (11.5, 5.0, 9.0, 1, 400.0)
    flag = lambda mad: facts.air_quality_mart(facts.with_baselines(hourly, stations, base.withColumn("mad", F.lit(mad)).where("month = 3"))).first().anomaly_flag
    assert flag(2.16) == 1 and flag(2.17) == 0
    bare = facts.air_quality_mart(facts.with_baselines(hourly, stations, base.limit(0))).first()
    assert (bare.baseline_median, bare.baseline_mad, bare.baseline_p99, bare.anomaly_flag, float(bare.quality_score)) == (11.5, 0.0, 40.0, 0, 100.0)
    assert facts.air_quality_mart(facts.with_baselines(hourly, stations.limit(0), base)).isEmpty()


def test_exact_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(7)
    groups = {"mixed": rng.normal(size=301) * 50, "ties": rng.integers(-3, 4, 500).astype(float), "one": np.array([4.5]), "wide": 10.0 ** rng.integers(-300, 300, 64), "same": np.full(40, -0.125)}
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("one", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    levels = (0.0, 0.05, 0.5, 0.9, 1.0)
    got = {r.k: r for r in baselines.exact_percentiles(df, ["k"], "x", levels).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert got[k].n == len(xs) and np.allclose(got[k].p, np.quantile(xs, levels), rtol=1e-12)
    whole = baselines.exact_percentiles(df.where("k = 'mixed'"), [], "x", (0.5,)).first()
    assert abs(whole.p[0] - np.median(groups["mixed"])) < 1e-12


def test_wide_baselines_equal_the_plain_ones(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice("ab"), rng.gauss(30, 9)) for _ in range(400)] + [("c", 2.0)], "pollutant string, value double")
    plain, wide = (sorted(f(df, ["pollutant"]).collect()) for f in (baselines.robust_baselines, baselines.wide_baselines))
    assert [r[0:2] for r in plain] == [r[0:2] for r in wide] and np.allclose([r[2:] for r in plain], [r[2:] for r in wide], atol=2e-6)


def test_features_do_not_leak(spark):
    target = datetime(2031, 3, 9, 21)
    rows = [("harbour", "no2", target - timedelta(hours=k), 7.0 + 2 * k) for k in range(1, 25)]
    past = spark.createDataFrame(rows, SERIES)
    future = past.unionByName(spark.createDataFrame([("harbour", "no2", target, 1e6), ("harbour", "no2", target + timedelta(hours=1), 1e6)], past.schema))
    asked = spark.createDataFrame([("harbour", "no2", target)], "location_id string, pollutant string, hour_start timestamp_ntz")
    city = spark.createDataFrame([("no2", 31.0, 64.0)], "pollutant string, historical_median double, p99 double")
    got = features.pollutant_features(asked, future, city).first()
    assert (got.lag_1h, got.lag_24h, got.mean_3h, got.mean_24h, got.max_24h, got.imputation_count) == (9.0, 55.0, 11.0, 32.0, 55.0, 0)
    assert abs(got.std_6h - 2 * (35 / 12) ** 0.5) < 1e-6
    bare = features.pollutant_features(asked, past.where("value < 0"), city).first()
    assert bare.imputation_count == 11 and bare.lag_6h == 31.0 and bare.max_24h == 64.0


def test_weather_falls_back_to_the_city(spark):
    hour = datetime(2031, 3, 9, 21)
    kinds = "location_id string, hour_start timestamp_ntz, temperature double, humidity double, wind_speed double, pressure double, wind_direction double"
    wx = spark.createDataFrame([("harbour", hour - timedelta(hours=1), 12.0, 70.0, 5.0, 990.0, 90.0), ("hill", hour - timedelta(hours=3), 4.0, 50.0, 15.0, 980.0, 0.0), ("far", hour - timedelta(hours=90), 2.0, 60.0, 10.0, 1000.0, 180.0)], kinds)
    asked = spark.createDataFrame([(c, hour) for c in ("harbour", "hill", "far")], "location_id string, hour_start timestamp_ntz")
    got = {r.location_id: r for r in features.weather_features(asked, wx, features.citywide_weather(wx)).collect()}
    assert (got["harbour"].temperature_lag_1h, got["harbour"].weather_imputation_count) == (12.0, 0)
    assert (got["hill"].temperature_lag_1h, got["hill"].temperature_mean_6h, got["hill"].weather_imputation_count) == (4.0, 4.0, 5)
    assert (got["far"].temperature_lag_1h, got["far"].pressure_mean_24h, got["far"].weather_imputation_count) == (6.0, 990.0, 13)
    alone = {r.location_id: r for r in features.weather_features(asked, wx).collect()}
    assert alone["far"].temperature_lag_1h is None and alone["far"].weather_imputation_count == 0 and alone["hill"].weather_imputation_count == 5


@pytest.mark.parametrize(("days", "parts"), [(40, (28, 6, 6)), (90, (62, 13, 15)), (17, (11, 2, 4))])
def test_split(days, parts):
    got = forecast.chronological_split(date(2031, 5, 1), date(2031, 5, 1) + timedelta(days=days - 1))
    assert tuple((b - a).days + 1 for a, b in got.values()) == parts
    with pytest.raises(ValueError):
        forecast.chronological_split(date(2031, 5, 1), date(2031, 5, 1))


def test_payload_parsers(spark):
    at = "2031-03-04T06:00:00Z"
    result = lambda l, s, p, v, u: {"location": {"id": l}, "sensor": {"id": s}, "parameter": {"id": p}, "value": v, "unit": u, "date": {"utc": at}}  # noqa: E731, E741
    body = json.dumps({"results": [result(9, 31, "O3", 0.25, "mg/m³"), result(0, 31, "o3", 1, ""), result(9, 0, "o3", 1, ""), result(9, 32, "o3", "x", ""), result(9, 33, "radon", 2, ""), result(9, 34, "no2", 3, " ")]})
    got = landing.parse_measurements(spark.createDataFrame([(body, BASE)], "payload string, ingested_at timestamp_ntz")).orderBy("sensor_id").collect()
    assert [(r.station_id, r.sensor_id, r.pollutant, r.value, r.unit, r.observed_at) for r in got] == [("9", "31", "o3", 250.0, "µg/m³", BASE), ("9", "34", "no2", 3.0, "µg/m³", BASE)]
    body = json.dumps({"hourly": {"time": ["2031-03-04T06:00", str(int(datetime(2031, 3, 4, 7).timestamp())), "2031-03-04T08:00", "2031-03-04T09:00"], "temperature_2m": [3.5, 4.0, 61.0, None], "relative_humidity_2m": [80.0, 100.0, 60.0, 50.0], "wind_speed_10m": [21.5]}})
    got = landing.parse_hourly_weather(spark.createDataFrame([("harbour", body, BASE)], "location_id string, payload string, ingested_at timestamp_ntz")).collect()
    assert [(r.temperature_c, r.wind_speed_kmh) for r in got] == [(3.5, 21.5), (4.0, None)]


def test_partitioned_round_trip(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = aq(spark, {}, {"station_id": "7002", "observed_at": BASE + timedelta(days=1)}, {"station_id": "7003", "observed_at": BASE + timedelta(days=2)})
    for _ in range(2):  # the same days twice leave one copy
        landing.write_raw(rows, root, "air_quality", "run1", mode="overwrite")
    got = landing.read_raw(spark, root, "air_quality", date(2031, 3, 4), date(2031, 3, 5))
    assert {r.station_id for r in got.collect()} == {"7001", "7002"}
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString()
    with pytest.raises(ContractError):
        landing.write_raw(aq(spark, {"value": None}), root, "air_quality", "run2")


def test_weather_partitions_baselines_and_stations(spark, tmp_path):
    row = ("open_meteo", "harbour", BASE, 3.5, 80.0, None, None, None, None, None, BASE, "h1")
    from skyledger.schemas import WEATHER

    landing.write_raw(spark.createDataFrame([row], WEATHER), str(tmp_path / "wx"), "weather", "run1")
    assert landing.read_raw(spark, str(tmp_path / "wx"), "weather", date(2031, 3, 4), date(2031, 3, 4)).first().temperature_c == 3.5
    base = spark.createDataFrame([("harbour", "no2", 20.0)], "location_id string, pollutant string, historical_median double")
    for median in (20.0, 21.0):
        landing.write_baselines(base.withColumn("historical_median", F.lit(median)), str(tmp_path / "b"), "v1")
    assert [r.historical_median for r in spark.read.parquet(str(tmp_path / "b")).collect()] == [21.0]
    places = spark.createDataFrame([("a", 10.0, 20.0), ("b", 91.0, 0.0), ("c", 0.0, -181.0), ("d", None, 1.0)], "station_id string, latitude double, longitude double")
    assert [r.station_id for r in landing.register_locations(places).collect()] == ["a"]


def test_response_hash_status_and_upsert(spark):
    import hashlib

    got = spark.createDataFrame([("{}",)], "payload string").select(landing.response_hash().alias("h")).first().h
    assert got == hashlib.sha256(b"{}").hexdigest()
    codes = spark.createDataFrame([(c,) for c in (200, 404, 429, 503)], "code int").select("code", *(c.alias(n) for n, c in landing.status_predicates(F.col("code")).items())).collect()
    assert [(r.is_success, r.is_transient, r.is_permanent) for r in codes] == [(True, False, False), (False, False, True), (False, True, False), (False, True, False)]
    old, new = (spark.createDataFrame([(i,) for i in ids], "k int") for ids in ((1, 2), (2, 3, 3)))
    assert [r.k for r in landing.upsert_new(old, new, ["k"]).collect()] == [3]


def test_quarantine_files(spark, tmp_path):
    marked = quality.classify_air_quality(aq(spark, {}, {"value": -2.0}, {"unit": "furlong"}), F.lit(BASE).cast("timestamp_ntz"))
    landing.quarantine(marked, str(tmp_path / "q"))
    assert landing.quarantine_statistics(spark, str(tmp_path / "q")).first() == (1, 1, 2)
    assert [r.reasons for r in landing.read_quarantine(spark, str(tmp_path / "q"), "invalid").collect()] == [["negative value"]]


def test_stream_equals_batch(spark, tmp_path):
    rows = aq(spark, *({"observed_at": BASE + timedelta(minutes=m), "value": float(m + 1)} for m in (0, 20, 40, 80)), {"observed_at": BASE, "value": 9.0}, {"observed_at": BASE + timedelta(hours=30)})
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = hourly_facts(stream).writeStream.format("memory").queryName("hours").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = {r.hour_start: r.observation_count for r in spark.table("hours").collect()}
    assert got[BASE] == 3 and got[BASE + timedelta(hours=1)] == 1


def test_rewritten_hours_are_the_same_twice(spark, tmp_path):
    root = str(tmp_path / "store")
    write = rewrite_affected_hours(root)
    first = aq(spark, {"value": 1.0}, {"value": 3.0, "observed_at": BASE + timedelta(minutes=5)}, {"value": 5.0, "observed_at": BASE + timedelta(days=1)})
    second = aq(spark, {"value": 8.0, "observed_at": BASE + timedelta(minutes=10)}, {"value": 3.0, "observed_at": BASE + timedelta(minutes=5)})
    for batch in (first, second, second, first.limit(0)):
        write(batch, 0)
    got = {r.hour_start: (r.observation_count, r.mean_value) for r in spark.read.parquet(f"{root}/hourly_facts").collect()}
    assert got == {BASE: (3, 4.0), BASE + timedelta(days=1): (1, 5.0)}


def test_dedup_and_late(spark):
    rows = aq(spark, {"raw_payload_hash": "a"}, {"ingested_at": BASE + timedelta(hours=1), "raw_payload_hash": "b"}, {"observed_at": None, "sensor_id": "n"}, {"observed_at": BASE - timedelta(hours=4), "sensor_id": "m"})
    keys = ["source", "station_id", "sensor_id", "pollutant", "observed_at"]
    assert "b" in {r.raw_payload_hash for r in dedup.latest_ingested(rows, keys).collect()}
    now = F.lit(BASE + timedelta(hours=2)).cast("timestamp_ntz")
    assert rows.select(late.late_class(F.col("observed_at"), now).alias("c")).first().c == "RECENT"
    recent, rest = late.split_by_lookback(rows, now, 6)
    assert {r.sensor_id for r in recent.collect()} == {"88", "m"} and {r.sensor_id for r in rest.collect()} == {"n"}
    assert {r.sensor_id for r in late.split_by_lookback(rows, now, 5)[1].collect()} == {"n", "m"}


def test_watermark_ignores_failed_runs(spark):
    at = lambda h: BASE + timedelta(hours=h)
    runs = spark.createDataFrame([("a", "success", at(1), at(2)), ("a", "failed", at(9), at(10)), ("a", "success", at(0), at(3)), ("b", "failed", at(1), at(1))], "source_id string, status string, requested_end timestamp_ntz, finished_at timestamp_ntz")
    assert [(r.source_id, r.requested_end) for r in late.latest_watermark(runs).collect()] == [("a", at(0))]


def test_scalars(spark):
    got = spark.range(1).select(scalars.iso_utc(F.lit(BASE).cast("timestamp_ntz")).alias("iso"), F.round(scalars.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(2.0)), 3).alias("km"), scalars.micro_degrees(F.lit(-2.3456789)).alias("micro"), scalars.hour_path(F.lit(BASE).cast("timestamp_ntz")).alias("path")).first()
    assert (got.iso, got.km, got.micro, got.path) == ("2031-03-04T06:00:00+00:00", 222.39, -2345678, "year=2031/month=03/day=04/hour=06")


def test_history_rejects_bad_ranges(spark):
    for args in (("2031-03-04", "2031-03-05", "weekly"), ("2031-03-05", "2031-03-04", "daily")):
        with pytest.raises(ValueError):
            serving.history(spark.range(1), "harbour", "no2", *args)


def line(spark, n=120):
    rng = random.Random(42)
    rows = [("harbour", "no2", BASE + timedelta(hours=i), float(x), float(i % 24), 3.0 * x - i % 24) for i, x in enumerate(rng.uniform(0, 9) for _ in range(n))]
    return spark.createDataFrame(rows, "location_id string, pollutant string, hour_start timestamp_ntz, lag_1h double, hour_of_day double, target double")


def test_models(spark):
    df = line(spark)
    for kind in ("linear", "rf", "hgb"):
        model = ml.train(df, "target", kind, small=True)
        assert ml.training_metrics(model, df, "target").first().mae < (1e-6 if kind == "linear" else 4)
        assert (kind == "linear") == (ml.importances(model) == {})
    scaler = model.stages[1]
    x = np.array(df.select("lag_1h", "hour_of_day").collect())
    assert np.allclose(scaler.mean.toArray(), x.mean(axis=0)) and np.allclose(scaler.std.toArray(), x.std(axis=0))
    with pytest.raises(ml.LeakError):
        ml.select_features(df, "lag_1h")
    with pytest.raises(ValueError):
        ml.estimator("xgboost", "target")


def test_models_have_the_engines_size():
    rf, hgb = ml.estimator("rf", "t"), ml.estimator("hgb", "t")
    assert (rf.getNumTrees(), rf.getMaxDepth(), hgb.getMaxIter(), hgb.getMaxDepth(), hgb.getMaxBins()) == (100, 15, 100, 10, 255)


def test_linear_model_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 20, 0.1]
    y = x @ [2.0, -0.3, 7.0] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "lag_1h double, mean_6h double, std_6h double, target double")
    model = ml.train(df, "target", "linear")
    fitted = np.c_[np.ones(200), x] @ np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)[0]
    assert np.allclose([r.prediction for r in model.transform(df).collect()], fitted, atol=1e-6)


def test_model_files_and_predictions(spark, tmp_path):
    df = line(spark)
    ml.save(ml.train(df, "target", "linear"), str(tmp_path / "m"), {"target": "target", "mae": 0.5})
    model, details = ml.load(str(tmp_path / "m"))
    assert details == {"mae": 0.5, "target": "target"}
    holes = df.withColumn("hour_of_day", F.when(F.col("hour_start") > F.lit(BASE).cast("timestamp_ntz"), F.col("hour_of_day"))).withColumn("lag_1h", F.when(F.hour("hour_start") != 8, F.col("lag_1h"))).limit(4)
    spread = spark.createDataFrame([(-1.0, 3.0, 10)], "low double, high double, n long")
    got = {(r.hour_start, r.horizon_minutes): r for r in ml.predict_horizons(holes, {60: model}, {60: spread}).collect()}
    assert len(got) == 12
    one = got[BASE + timedelta(hours=1), 60]
    assert one.method == "model" and abs(one.upper - one.lower - 4) < 1e-5 and one.interval_confidence == 0.9
    assert got[BASE, 60].method == "baseline" and got[BASE, 60].interval_confidence == 0.5 and abs(got[BASE, 60].upper / got[BASE, 60].prediction - 1.1) < 1e-4
    assert got[BASE + timedelta(hours=2), 180].method == got[BASE + timedelta(hours=2), 60].method == "error" and got[BASE + timedelta(hours=2), 60].prediction is None
    few = ml.predict_horizons(holes, {60: model}, {60: spread.withColumn("n", F.lit(9))}).where("method = 'model'").first()
    assert few.interval_confidence == 0.5


def test_settings_from_file_and_environment(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"event_hours": 5, "monitored": ["no2"], "merge_hours": 2}))
    got = config.load(str(path), {"SKYLEDGER_EVENT_HOURS": "6", "SKYLEDGER_UNITS": "a, b"})
    assert (got.event_hours, got.monitored, got.merge_hours, got.units, got.event_least) == (6, ("no2",), 2.0, ("a", "b"), 3)
    assert config.load(None, {}) == config.Settings()
    for bad in ({"no_such": 1}, {"event_hours": "five"}):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            config.load(str(path), {})
    with pytest.raises(ValueError):
        config.load(None, {"SKYLEDGER_EVENT_HOURS": "five"})


def test_retries_and_rates():
    calls, slept = [], []

    def fails(kind, until):
        def call():
            calls.append(1)
            if len(calls) < until:
                raise kind("no")
            return "yes"

        return call

    assert control.with_retry(fails(TimeoutError, 3), sleep=slept.append) == "yes" and 1.8 <= slept[0] <= 2.2 and 3.6 <= slept[1] <= 4.4
    calls.clear()
    with pytest.raises(ConnectionError):
        control.with_retry(fails(ConnectionError, 9), sleep=slept.append)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(KeyError):
        control.with_retry(fails(KeyError, 9), sleep=slept.append)
    assert len(calls) == 1
    clock = [0.0]
    bucket = control.TokenBucket(30, clock=lambda: clock[0], sleep=lambda s: clock.__setitem__(0, clock[0] + s))
    assert all(bucket.acquire() for _ in range(30)) and not bucket.acquire()
    bucket.wait()
    assert abs(clock[0] - 2.0) < 1e-6
    with pytest.raises(ValueError):
        bucket.wait(31)


def test_pages_follow_the_cursor():
    body = lambda c: {"results": [], "meta": {"next": {"cursor": c}}}
    answers = {None: (200, body("b")), "b": (200, body("c")), "c": (404, {})}
    assert len(list(control.pages(answers.get))) == 2 and len(list(control.pages(answers.get, most=1))) == 1
    with pytest.raises(ConnectionError):
        list(control.pages(lambda c: (503, {})))
    with pytest.raises(PermissionError):
        list(control.pages(lambda c: (401, {})))


def test_cache_and_ingest_run(spark, tmp_path):
    cache = control.ResponseCache(spark, str(tmp_path / "cache"))
    assert cache.get("u") is None
    cache.put("u", "{}\n")
    assert cache.get("u") == "{}\n" and cache.get("v") is None
    landed = tmp_path / "pages"
    landed.mkdir()
    (landed / "1.json").write_text(json.dumps({"results": [{"location": {"id": 9}, "sensor": {"id": 31}, "parameter": {"id": "o3"}, "value": 2.5, "unit": "ppb", "date": {"utc": "2031-03-04T06:00:00Z"}}]}, indent=1))
    runs, raw = str(tmp_path / "runs"), str(tmp_path / "raw")
    args = (spark, "openaq", lambda low, high: control.landed_pages(spark, str(landed)), landing.parse_measurements, lambda rows, run: landing.write_raw(rows, raw, "air_quality", run), runs, BASE)
    run = control.ingest(*args)
    assert run["status"] == "success" and run["records_written"] == 1 and run["requested_start"] == BASE - timedelta(hours=6)
    assert landing.read_raw(spark, raw, "air_quality", date(2031, 3, 4), date(2031, 3, 4)).first().run_id == run["run_id"]
    with pytest.raises(ZeroDivisionError):
        control.ingest(*args[:3], lambda df: 1 / 0, *args[4:], last_event=BASE - timedelta(hours=1))
    got = {r.status: r for r in spark.read.parquet(runs).collect()}
    assert set(got) == {"success", "failed"} and got["failed"].requested_start == BASE - timedelta(hours=1) and "division" in got["failed"].error


def test_marts_are_written_once_and_follow_their_events(spark, tmp_path):
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(i, BASE + timedelta(minutes=7 * i), i % 6, ("click", "view", "signup")[i % 3], float(i), "{}") for i in range(1, 40)]
    save = lambda n: spark.createDataFrame(rows[:n], kinds).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    save(39)
    before = set(WRITTEN)
    counts = [Views(spark, str(tmp_path)).aq_clean.count() for _ in range(2)]
    assert counts == [39, 39] and len(set(WRITTEN) - before) == 1
    save(20)
    assert Views(spark, str(tmp_path)).aq_clean.count() == 20
    assert Views(spark, str(tmp_path)).loc_hourly.where("location_id = 'UNMAPPED'").isEmpty()
