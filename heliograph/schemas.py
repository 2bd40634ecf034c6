"""Column names, wire schemas and topics shared by every module.

The names, types and topics below are fixed values: messages and tables written by other programs use them.
"""

from __future__ import annotations

PANEL = "panel_id"
EVENT_TIME = "timestamp"
KEYS = [PANEL, EVENT_TIME]

# Measures carried by each kind of measurement message.
MEASURES = {
    "irradiance": "irradiance_w_m2 DOUBLE",
    "power_ac": "power_ac_w DOUBLE",
    "power_dc": "power_dc_w DOUBLE",
    "temperature": "temperature_c DOUBLE",
    "orientation": "tilt_deg DOUBLE, azimuth_deg DOUBLE",
}
KINDS = list(MEASURES)

# Topic names.
TOPICS = {
    "irradiance": "kafka_solar_irradiance",
    "power_ac": "kafka_solar_power_ac",
    "power_dc": "kafka_solar_power_dc",
    "temperature": "kafka_solar_temperature",
    "orientation": "kafka_solar_orientation",
    "enriched": "kafka_solar_enriched_features",
    "window_stats": "kafka_solar_window_stats",
    "faults": "kafka_fault_events",
    "control": "kafka_solar_control",
    "sensors": "kafka_solar_sensors",
}

WATERMARK = "10 seconds"
WINDOW = "1 minute"

WIRE = "key STRING, value STRING"

WINDOW_STATS = (
    "panel_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, "
    "avg_efficiency DOUBLE, avg_temp DOUBLE, avg_irradiance DOUBLE"
)

PANEL_STATUS = (
    "panel_id STRING, is_broken BOOLEAN, avg_efficiency DOUBLE, avg_temperature DOUBLE, "
    "avg_irradiance DOUBLE, last_updated TIMESTAMP, broken_since TIMESTAMP, reason STRING"
)
STATUS_COLUMNS = [
    "panel_id",
    "is_broken",
    "avg_efficiency",
    "avg_temperature",
    "avg_irradiance",
    "last_updated",
    "broken_since",
    "reason",
]

TRAINING = (
    "panel_id STRING, timestamp TIMESTAMP, irradiance_w_m2 DOUBLE, power_ac_w DOUBLE, "
    "power_dc_w DOUBLE, temperature_c DOUBLE, tilt_deg DOUBLE, azimuth_deg DOUBLE"
)

PREDICTION_REQUEST = (
    "panel_id STRING, irradiance_w_m2 DOUBLE, temperature_c DOUBLE, timestamp TIMESTAMP, "
    "send_to_kafka BOOLEAN"
)


def measurement_schema(kind: str) -> str:
    """DDL schema of one measurement message, without the message id that no reader uses."""
    return f"panel_id STRING, timestamp TIMESTAMP, {MEASURES[kind]}"


def measure_names(kind: str) -> list[str]:
    """Measure columns of one kind, in message order."""
    return [field.split()[0] for field in MEASURES[kind].split(", ")]
