"""Canonical schemas and the check that sinks apply to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import AQ_REQUIRED, WX_REQUIRED

AIR_QUALITY = "source string, station_id string, sensor_id string, pollutant string, value double, unit string, observed_at timestamp_ntz, ingested_at timestamp_ntz, raw_payload_hash string"
WEATHER = (
    "source string, location_id string, observed_at timestamp_ntz, temperature_c double, humidity_pct double, wind_speed_kmh double, wind_direction_deg double, "
    "pressure_hpa double, precipitation_mm double, cloud_cover_pct double, ingested_at timestamp_ntz, raw_payload_hash string"
)
REQUIRED = {"air_quality": AQ_REQUIRED, "weather": WX_REQUIRED}


class ContractError(ValueError):
    """A batch holds a record that breaks its contract."""


def enforce(df: DataFrame, kind: str) -> DataFrame:
    """``df`` in canonical column order; one record with a missing required value fails the whole batch."""
    schema = AIR_QUALITY if kind == "air_quality" else WEATHER
    names = [c.split()[0] for c in schema.split(", ")]
    if lacking := [c for c in names if c not in df.columns]:
        raise ContractError(f"columns missing: {lacking}")
    broken = df.where(" or ".join(f"{c} is null" for c in REQUIRED[kind]))
    if not broken.isEmpty():
        raise ContractError(f"a required value of {kind} is null")
    return df.select(*(F.col(n).cast(t) for n, t in (c.split(" ", 1) for c in schema.split(", "))))
