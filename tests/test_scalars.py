import random
import struct
import uuid

import pytest
from helpers import at
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heliograph.functions import scalars


def _texts(spark, values, places, ties="even"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, x DOUBLE")
    found = df.select("i", scalars.fixed_text(F.col("x"), places, ties).alias("t")).collect()
    return [r.t for r in sorted(found, key=lambda r: r.i)]


@pytest.mark.parametrize("places", [0, 1, 2])
def test_fixed_text_agrees_with_printf(spark, places):
    rng = random.Random(places)
    values = [rng.uniform(-2000, 2000) for _ in range(500)]
    values += [round(rng.uniform(0, 200), places + 1) for _ in range(500)]
    values += [n / 8 for n in range(-100, 400)] + [2.675, 4.125, 0.045, 1.005, 0.5, 1.5, 2.5, 1e15, 123456789.125]
    assert _texts(spark, values, places) == [f"{v:.{places}f}" for v in values]


@settings(max_examples=5, deadline=None)
@given(seed=st.integers(0, 2**32))
def test_fixed_text_on_arbitrary_bits(spark, seed):
    rng = random.Random(seed)
    values = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(300)]
    values = [v for v in values if 1e-9 < abs(v) < 1e12]
    assert _texts(spark, values, 2) == [f"{v:.2f}" for v in values]


def test_fixed_text_ties_away_from_zero(spark):
    assert _texts(spark, [4.125, -4.125, 2.675, 0.5, 604.5], 2, "up") == ["4.13", "-4.13", "2.67", "0.50", "604.50"]
    assert _texts(spark, [0.5, 604.5, 605.5, None], 0, "up") == ["1", "605", "606", None]


def test_guarded_ratios(spark):
    data = [(90.0, 100.0), (1.0, 0.0), (1.0, -1.0), (1.0, None), (None, 2.0)]
    df = spark.createDataFrame(data, "ac DOUBLE, dc DOUBLE")
    found = df.select(
        scalars.efficiency(F.col("ac"), F.col("dc")), scalars.temp_per_power(F.col("ac"), F.col("dc"))
    ).collect()
    assert [tuple(r) for r in found] == [(90.0, 0.9), (None, None), (None, None), (None, None), (None, None)]


def test_angles_and_power(spark):
    data = [(100.0, -30.0, 0.0, 1000.0), (-5.0, 725.0, 85.0, 0.0), (None, None, None, None)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, tilt DOUBLE, irr DOUBLE")
    found = df.select(
        scalars.clamp(F.col("a"), 0, 90),
        scalars.wrap_degrees(F.col("b")),
        scalars.expected_dc_power(F.col("irr"), F.col("tilt")),
    ).collect()
    assert [tuple(r) for r in found] == [(90.0, 330.0, 288.0), (0.0, 5.0, 0.0), (None, None, None)]


def test_steep_panel_still_gets_half_of_the_light(spark):
    df = spark.createDataFrame([(1000.0, 85.0), (-10.0, 0.0)], "irr DOUBLE, tilt DOUBLE")
    found = df.select(scalars.expected_dc_power(F.col("irr"), F.col("tilt")).alias("p")).collect()
    assert [r.p for r in found] == [144.0, 0.0]


def test_day_phase(spark):
    df = spark.createDataFrame([(at(0),), (at(-12 * 3600),)], "t TIMESTAMP")
    assert [r[0] for r in df.select(scalars.day_phase(F.col("t"))).collect()] == [0.5, 0.0]


def test_times_as_text_and_back(spark):
    df = spark.createDataFrame([(at(0),), (at(0.123456),)], "t TIMESTAMP")
    found = df.select(scalars.iso_text(F.col("t")), scalars.iso_text(F.col("t"), offset=True)).collect()
    assert [tuple(r) for r in found] == [
        ("2024-01-01T12:00:00", "2024-01-01T12:00:00+00:00"),
        ("2024-01-01T12:00:00.123456", "2024-01-01T12:00:00.123456+00:00"),
    ]
    texts = ["2024-01-01T12:00:00+00:00", "2024-01-01T14:00:00+02:00", "2024-01-01", "yesterday", "2024", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = [r[0] for r in df.select(scalars.parse_iso(F.col("t"))).collect()]
    assert found == [at(0), at(0), at(-12 * 3600), None, None, None, None]


def test_numbers_from_text(spark):
    """As Python's float() reads decimal text."""
    good = ["3.5", " 7 ", "1e3", "-2", "+.5", "5.", "1_0", "1_000.2_5e1_0", "inf", "-Infinity", "\t8\n"]
    bad = ["abc", "", " ", "1.5d", "1.5F", "2f ", "0x1p3", "0x10", "_1", "1_", "1__0", "1e", ".", "1,5", None]
    df = spark.createDataFrame([(t,) for t in good + bad], "t STRING")
    found = [r[0] for r in df.select(scalars.parse_number(F.col("t"))).collect()]
    assert found == [float(t) for t in good] + [None] * len(bad)
    nan = spark.createDataFrame([("nan",)], "t STRING").select(scalars.parse_number(F.col("t"))).first()[0]
    assert nan != nan


def test_epoch_id(spark):
    df = spark.createDataFrame([(at(0.5),)], "t TIMESTAMP")
    assert float(df.select(scalars.epoch_id(F.col("t"))).first()[0]) == 1704110400.5


def test_name_uuid_is_the_standard_one(spark):
    names = ["", "a", "topic\npanel-1\n17", "Übermaß 太陽", "x" * 5000, *[f"panel-{n}" for n in range(200)]]
    found = spark.createDataFrame([(n,) for n in names], "name STRING").select("name", scalars.name_uuid(F.col("name")))
    assert {tuple(r) for r in found.collect()} == {(n, str(uuid.uuid5(uuid.NAMESPACE_URL, n))) for n in names}
