"""Small frames and comparisons shared by the tests."""

from datetime import datetime, timedelta

from heliograph import schemas

START = datetime(2024, 1, 1, 12, 0)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def stats_frame(spark, windows):
    """Window statistics from (panel, minute, efficiency, temperature, irradiance)."""
    data = [(p, at(60 * m), at(60 * m + 60), e, t, i) for p, m, e, t, i in windows]
    return spark.createDataFrame(data, schemas.WINDOW_STATS)


def readings_frame(spark, data):
    """Wide readings from (panel, seconds, irradiance, ac, dc, temperature)."""
    schema = (
        "panel_id STRING, timestamp TIMESTAMP, irradiance_w_m2 DOUBLE, power_ac_w DOUBLE, power_dc_w DOUBLE, "
        "temperature_c DOUBLE, tilt_deg DOUBLE, azimuth_deg DOUBLE"
    )
    return spark.createDataFrame([(p, at(s), i, ac, dc, t, 30.0, 180.0) for p, s, i, ac, dc, t in data], schema)
