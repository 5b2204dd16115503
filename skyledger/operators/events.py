"""Pollution events: ordered greedy scan for runs, then merging of neighbours, without Python code on executors.

Each anomaly learns by windows where an event would end if a scan started there: three rows exactly an hour apart, else all rows within
four hours if they are three or more. A fold over (row, end) pairs then takes starts greedily. No event crosses a gap of more than four hours,
so the fold is over one episode between such gaps, not over the history of a place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS, SEVERITIES
from ..functions.scalars import event_uuid, severity_rank
from .facts import r6

KEYS = ["location_id", "pollutant"]
HOUR = 3_600_000_000


def qualifying(anomalies: DataFrame, severities: tuple[str, ...] = ("HIGH", "SEVERE", "EXTREME")) -> DataFrame:
    return anomalies.where(F.col("severity").isin(*severities))


def candidate_ends(rows: DataFrame) -> DataFrame:
    """rows with rn and ``last``: the rn at which an event that starts here would end, or null."""
    rows = rows.withColumn("micros", F.unix_micros(F.col("hour_start").cast("timestamp")))
    order = Window.partitionBy(*KEYS).orderBy("micros", "observed_value")
    ahead = Window.partitionBy(*KEYS).orderBy("micros").rangeBetween(Window.unboundedPreceding, SETTINGS.event_hours * HOUR)
    rows = rows.withColumns({"rn": F.row_number().over(order), "l1": F.lead("micros", 1).over(order), "l2": F.lead("micros", 2).over(order)})
    rows = rows.withColumn("within", F.max("rn").over(ahead))
    consecutive = (F.col("l1") - F.col("micros") == HOUR) & (F.col("l2") - F.col("l1") == HOUR)
    last = F.when(consecutive, F.col("rn") + 2).when(F.col("within") - F.col("rn") + 1 >= SETTINGS.event_least, F.col("within"))
    gap = F.col("micros") - F.lag("micros").over(order) > SETTINGS.event_hours * HOUR
    return rows.withColumns({"last": last, "opens": F.coalesce(gap.cast("int"), F.lit(1))}).withColumn("episode", F.sum("opens").over(order)).drop("l1", "l2", "within", "opens")


def greedy_spans(rows: DataFrame) -> DataFrame:
    """(keys, first, last) in rows of ``candidate_ends``, episode by episode. Only possible starts are folded, not all rows."""
    fold = """aggregate(array_sort(collect_list(struct(rn, last))), struct(0 as nxt, cast(array() as array<struct<first:int,last:int>>) as spans),
        (acc, r) -> if(r.rn >= acc.nxt, struct(r.last + 1 as nxt, concat(acc.spans, array(struct(r.rn as first, r.last as last))) as spans), acc)).spans"""
    return rows.where("last is not null").groupBy(*KEYS, "episode").agg(F.expr(fold).alias("spans")).select(*KEYS, F.inline("spans"))


def raw_events(rows: DataFrame) -> DataFrame:
    """One row for each span: extremes of time, truthy peak and mean, largest |z|, highest severity, count."""
    starts = greedy_spans(rows).withColumn("rn", F.col("first"))
    # Spans don't overlap: the span that a row may be in is the last one begun. One row for each, not rows times spans.
    so_far = Window.partitionBy(*KEYS).orderBy("rn")
    begun = rows.drop("last").join(starts, [*KEYS, "rn"], "left").withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("first", "last")})
    members = begun.where("rn <= last")
    rank = F.max(severity_rank(F.col("severity"), SEVERITIES))
    seen = F.when(F.col("observed_value") != 0, F.col("observed_value"))
    return members.groupBy(*KEYS, "first").agg(
        F.min("hour_start").alias("start_time"), F.max("hour_start").alias("end_time"), F.max(seen).alias("peak_value"), F.avg(seen).alias("mean_value"),
        F.max(F.abs("robust_z")).alias("peak_z"), rank.alias("rank"), F.count(F.lit(1)).alias("anomaly_count"),
    )


def merged_events(spans: DataFrame) -> DataFrame:
    """Neighbours whose gap is at most an hour become one event."""
    order = Window.partitionBy(*KEYS).orderBy("start_time", "first")
    gap = F.unix_micros(F.col("start_time").cast("timestamp")) - F.unix_micros(F.lag("end_time").over(order).cast("timestamp"))
    islands = spans.withColumn("opens", F.when(gap <= int(SETTINGS.merge_hours * HOUR), 0).otherwise(1)).withColumn("island", F.sum("opens").over(order))
    out = islands.groupBy(*KEYS, "island").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.max("peak_value").alias("peak_value"), F.try_divide(F.sum(F.col("mean_value") * F.col("anomaly_count")), F.sum("anomaly_count")).alias("mean_value"),
        F.max("peak_z").alias("peak_z"), F.max("rank").alias("rank"), F.sum("anomaly_count").alias("anomaly_count"),
    )
    hours = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / F.lit(HOUR)
    names = F.array(*map(F.lit, SEVERITIES))
    return out.select(event_uuid(F.col("location_id"), F.col("pollutant"), F.col("start_time")).alias("event_id"), *KEYS, "start_time", "end_time", (F.floor(hours) + 1).cast("int").alias("duration_hours"), r6(F.col("peak_value")).alias("peak_value"), r6(F.col("mean_value")).alias("mean_value"), "peak_z", F.element_at(names, F.col("rank") + 1).alias("severity"), F.col("anomaly_count").cast("bigint").alias("anomaly_count"))


def detect_events(anomalies: DataFrame, severities: tuple[str, ...] = ("HIGH", "SEVERE", "EXTREME")) -> DataFrame:
    return merged_events(raw_events(candidate_ends(qualifying(anomalies, severities))))


def events_with_anomalies(events: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Count of anomalies inside each event. Days of the span bucket the range, so the join has an equality to shuffle on."""
    e = events.select("event_id", "location_id", "pollutant", "start_time", "end_time").withColumn("day", F.explode(F.sequence(F.to_date("start_time"), F.to_date("end_time"))))
    a = anomalies.select(*KEYS, "hour_start", F.to_date("hour_start").alias("day"))
    hit = e.join(a, [*KEYS, "day"]).where("hour_start between start_time and end_time").groupBy("event_id").agg(F.count(F.lit(1)).alias("anomalies"))
    return events.select("event_id", *KEYS).join(hit, "event_id", "left").select("event_id", *KEYS, F.coalesce("anomalies", F.lit(0)).alias("anomalies"))


def events_with_weather(events: DataFrame, weather: DataFrame) -> DataFrame:
    e = events.select("event_id", "location_id", "pollutant", "start_time", "end_time").withColumn("day", F.explode(F.sequence(F.to_date("start_time"), F.to_date("end_time"))))
    w = weather.select("location_id", "hour_start", F.to_date("hour_start").alias("day"), "temperature_c", "humidity_pct", "wind_speed_kmh")
    got = e.join(w, ["location_id", "day"]).where("hour_start between start_time and end_time").groupBy("event_id").agg(*(r6(F.avg(c)).alias(f"mean_{c}") for c in ("temperature_c", "humidity_pct", "wind_speed_kmh")))
    return events.select("event_id", *KEYS, "start_time", "end_time").join(got, "event_id", "left")
