"""Scalar column expressions. All of them stay in the JVM and take part in code generation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Panel area in square metres, cell efficiency, lowest share of light a tilted panel receives.
PANEL_AREA_M2 = 1.6
CELL_EFFICIENCY = 0.18
LOWEST_TILT_FACTOR = 0.5

MICROS_PER_DAY = 86_400_000_000


def efficiency(ac: Column, dc: Column) -> Column:
    """Inverter efficiency in percent; NULL unless there is DC power."""
    return F.when(dc > 0, ac / dc * 100)


def temp_per_power(temperature: Column, dc: Column) -> Column:
    """Degrees per DC watt; NULL unless there is DC power."""
    return F.when(dc > 0, temperature / dc)


def clamp(x: Column, low: float, high: float) -> Column:
    """`x` held inside [low, high]; NULL stays NULL (`greatest` and `least` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x)))


def wrap_degrees(x: Column) -> Column:
    """Angle brought into [0, 360)."""
    return F.pmod(x, F.lit(360.0))


def day_phase(ts: Column) -> Column:
    """Share of the UTC day that has passed, in [0, 1)."""
    return F.pmod(F.unix_micros(ts), F.lit(MICROS_PER_DAY)) / F.lit(float(MICROS_PER_DAY))


def tilt_factor(tilt: Column) -> Column:
    """Share of the light a panel at this tilt receives."""
    return F.when(tilt.isNotNull(), F.greatest(F.lit(LOWEST_TILT_FACTOR), F.cos(F.radians(tilt))))


def expected_dc_power(irradiance: Column, tilt: Column) -> Column:
    """Noise-free DC power for an irradiance and a tilt, never below zero, two decimals."""
    power = irradiance * (F.lit(PANEL_AREA_M2 * CELL_EFFICIENCY) * tilt_factor(tilt))
    return round_exact((power + F.abs(power)) / 2, 2)  # negative power becomes 0, NULL stays NULL


def round_exact(x: Column, places: int | Column, ties: str = "even") -> Column:
    """Round the exact binary value of a double; `ties="up"` moves true ties away from zero.

    `round` and `format_string` round the shortest decimal text of a double, so 2.675 (really 2.67499...) goes up. Here
    the product with the scale is kept as a value plus its exact rounding error (Dekker's product), which tells the two
    sides of a half, and a true tie, apart. There is no branch in the expression, so that Spark computes its repeated
    parts once.
    """
    scale = F.lit(float(10**places)) if isinstance(places, int) else F.pow(F.lit(10.0), places)
    size = F.abs(x)
    spread = size * F.lit(134217729.0)  # 2**27 + 1 cuts a double into two halves
    high = spread - (spread - size)
    low = size - high
    product = size * scale
    error = (high * scale - product) + low * scale
    part = product % F.lit(1.0)
    whole = product - part
    past_half = (part - F.lit(0.5)) + error
    goes_up = (past_half >= 0) if ties == "up" else (past_half > 0) | ((past_half == 0) & (whole % F.lit(2.0) == 1))
    return F.signum(x) * ((whole + goes_up.cast("double")) / scale)


def fixed_text(x: Column, places: int, ties: str = "even") -> Column:
    """Text with a fixed number of decimals, as C's printf gives it, or NULL."""
    rounded = round_exact(x, places, ties)
    return F.when(rounded.isNotNull(), F.format_string(f"%.{places}f", rounded))


def iso_text(ts: Column, offset: bool = False) -> Column:
    """ISO-8601 text in UTC; the fraction appears only when there is one, the offset only on request."""
    fraction = F.when(F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    parts = [F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction]
    return F.concat(*parts, *([F.lit("+00:00")] if offset else []))


def parse_iso(text: Column) -> Column:
    """Instant from ISO-8601 text; NULL for anything that does not start with a full date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


_DIGITS = r"[0-9]+(_[0-9]+)*"
_NUMBER = rf"(?i)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf(inity)?|nan)\s*$"


def parse_number(text: Column) -> Column:
    """Double from decimal text, with single underscores between digits; NULL for other text.

    Java's own forms (`1.5d`, `0x1p3`) are no decimal text.
    """
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_")).try_cast("double"))


def epoch_id(ts: Column) -> Column:
    """Epoch seconds with a fraction, as a text id."""
    return (F.unix_micros(ts) / F.lit(1e6)).cast("string")


def name_uuid(name: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """UUID made from a name by SHA-1 (version 5): equal names have equal ids, on every machine and in every run."""
    digest = F.sha1(F.concat(F.lit(namespace.bytes), F.encode(name, "UTF-8")))

    def digits(start: int, number: int) -> Column:
        return F.substring(digest, start, number)

    variant = F.translate(digits(17, 1), "0123456789abcdef", "89ab" * 4)
    third, fourth = F.concat(F.lit("5"), digits(14, 3)), F.concat(variant, digits(18, 3))
    return F.concat_ws("-", digits(1, 8), digits(9, 4), third, fourth, digits(21, 12))
