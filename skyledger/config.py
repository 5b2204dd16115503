"""Thresholds and fixed values of the engine, in one place."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    monitored: tuple[str, ...] = ("pm25", "pm10", "no2", "o3", "so2")
    units: tuple[str, ...] = ("µg/m³", "mg/m³", "ppb", "ppm")
    upper_bounds: dict = field(default_factory=lambda: {"pm25": 500.0, "pm10": 800.0, "no2": 200.0, "o3": 200.0})
    future_hours: int = 1
    z_levels: tuple[tuple[float, str], ...] = ((5.0, "EXTREME"), (4.0, "SEVERE"), (3.0, "HIGH"), (2.0, "ELEVATED"))
    event_hours: int = 4
    event_least: int = 3
    merge_hours: float = 1.0
    baseline_least: int = 60
    weekly_least: int = 20
    horizons: tuple[int, ...] = (60, 180, 360)


def load(path: str | None = None, env: Mapping[str, str] = os.environ, prefix: str = "SKYLEDGER_") -> Settings:
    """Defaults, then a JSON file, then environment variables such as SKYLEDGER_EVENT_HOURS; lists there are JSON or separated by commas.

    Names that aren't settings and values of another kind raise ValueError.
    """
    given = json.loads(Path(path).read_text()) if path else {}
    known = {f.name: getattr(Settings(), f.name) for f in fields(Settings)}
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    for name, default in known.items():
        if (text := env.get(prefix + name.upper())) is not None:
            given[name] = text if isinstance(default, str) else _from_text(name, text, isinstance(default, tuple))
    return Settings(**{name: _checked(name, value, known[name]) for name, value in given.items()})


def _from_text(name: str, text: str, several: bool):
    try:
        return json.loads(text)
    except ValueError:
        if several:
            return [part.strip() for part in text.split(",")]
        raise ValueError(f"{name}: {text!r} is no number or JSON") from None


def _checked(name: str, value, default):
    if isinstance(default, tuple) and isinstance(value, list):
        value = tuple(tuple(x) if isinstance(x, list) else x for x in value)
    elif isinstance(default, float) and isinstance(value, int) and not isinstance(value, bool):
        value = float(value)
    if type(value) is not type(default):
        raise ValueError(f"{name}: {value!r} should be a {type(default).__name__}")
    return value


SETTINGS = Settings()
#: Order of severities, from which the highest is taken.
SEVERITIES = ("NORMAL", "ELEVATED", "HIGH", "SEVERE", "EXTREME")
AQ_REQUIRED = ("source", "station_id", "sensor_id", "pollutant", "value", "unit", "observed_at", "ingested_at", "raw_payload_hash")
WX_REQUIRED = ("source", "location_id", "observed_at", "temperature_c", "humidity_pct", "ingested_at", "raw_payload_hash")
#: Connector ranges of weather variables; a null passes.
WX_RANGES = {
    "temperature_c": (-60, 60), "humidity_pct": (0, 100), "wind_speed_kmh": (0, 200), "wind_direction_deg": (0, 360),
    "pressure_hpa": (900, 1100), "precipitation_mm": (0, 1000), "cloud_cover_pct": (0, 100),
}
#: Station health: metric, whether low values are bad, threshold, penalty.
PENALTIES = (
    ("availability_pct", True, 80.0, 30.0), ("missing_rate", False, 10.0, 20.0), ("duplicate_rate", False, 5.0, 10.0),
    ("stale_rate", False, 5.0, 10.0), ("flatline_rate", False, 10.0, 10.0), ("outlier_rate", False, 2.0, 5.0),
)
