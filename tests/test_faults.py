import json

import pytest
from helpers import at, rows
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from heliograph.operators import faults, skew

SCHEMA = "panel_id STRING, timestamp TIMESTAMP, irradiance_w_m2 DOUBLE, power_dc_w DOUBLE"


def _demo(spark):
    data = [("panel-1", at(0), 900.0, 250.0), ("panel-2", at(0), 900.0, 255.0), ("panel-3", at(0), 900.0, 50.0)]
    return spark.createDataFrame(data, SCHEMA)


def _many(spark):
    """A hot moment, quiet ones, a lone reading, unknown powers and readings without a time."""
    hot = [(f"p{i}", at(0), 1.0, float(i % 7) * 30) for i in range(300)]
    quiet = [(f"p{i % 5}", at(60 * (1 + i // 5)), 1.0, 100.0 + (i * 37 % 11) * 20) for i in range(200)]
    odd = [("lone", at(90_000), 1.0, 900.0), ("null", at(0), 1.0, None), ("a", None, 1.0, 0.0), ("b", None, 1.0, 500.0)]
    return spark.createDataFrame(hot + quiet + odd, SCHEMA)


def _by_window_function(df, threshold=50.0):
    mean = F.avg("power_dc_w").over(Window.partitionBy("timestamp"))
    compared = df.withColumn("avg_power", mean).withColumn("deviation", F.abs(F.col("power_dc_w") - mean))
    return compared.where(F.col("deviation") > threshold)


def _rounded(df):
    return rows(df, "panel_id", "timestamp", F.round("avg_power", 6), F.round("deviation", 6))


def test_demo_reports_all_three_panels(spark):
    found = rows(faults.preview(faults.detect_faults(_demo(spark))))
    assert found == [("panel-1", 250.0, 185.0, 65.0), ("panel-2", 255.0, 185.0, 70.0), ("panel-3", 50.0, 185.0, 135.0)]


def test_threshold_is_strict(spark):
    assert rows(faults.detect_faults(_demo(spark), threshold=65.0), "panel_id") == [("panel-2",), ("panel-3",)]


def test_leave_one_out(spark):
    found = rows(faults.detect_faults(_demo(spark), leave_one_out=True), "panel_id", "avg_power", "deviation")
    assert found == [("panel-1", 152.5, 97.5), ("panel-2", 150.0, 105.0), ("panel-3", 252.5, 202.5)]


def test_a_lone_panel_has_no_peers(spark):
    lone = _demo(spark).limit(1)
    assert rows(faults.compare_with_peers(lone), "deviation") == [(0.0,)]
    assert rows(faults.compare_with_peers(lone, leave_one_out=True), "deviation") == [(None,)]


def test_buckets(spark):
    data = [("a", at(1), 1.0, 0.0), ("b", at(3000), 1.0, 200.0), ("c", at(4000), 1.0, 500.0)]
    df = spark.createDataFrame(data, SCHEMA)
    assert faults.detect_faults(df).count() == 0
    assert rows(faults.detect_faults(df, "1 hour"), "panel_id", "avg_power") == [("a", 100.0), ("b", 100.0)]


@pytest.mark.parametrize("threshold", [0.0, 20.0, 50.0, 1000.0])
def test_same_as_window_function(spark, threshold):
    df = _many(spark)
    assert _rounded(faults.detect_faults(df, threshold=threshold)) == _rounded(_by_window_function(df, threshold))


def test_comparison_keeps_every_reading(spark):
    df = _many(spark)
    mean = F.avg("power_dc_w").over(Window.partitionBy("timestamp"))
    wanted = df.withColumn("avg_power", mean).withColumn("deviation", F.abs(F.col("power_dc_w") - mean))
    assert _rounded(faults.compare_with_peers(df)) == _rounded(wanted)


@pytest.mark.parametrize("limit", [0, 1000])
def test_attaching_by_broadcast_and_by_split_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "HOT_SHARES", 10)
    df = _many(spark)
    groups = df.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n"), F.max("power_dc_w").alias("top"))
    found = skew.attach_group_values(df, groups, ["timestamp"], "n", broadcast_groups=limit)
    whole = Window.partitionBy("timestamp")
    wanted = df.withColumns({"n": F.count(F.lit(1)).over(whole), "top": F.max("power_dc_w").over(whole)})
    assert rows(found, *wanted.columns) == rows(wanted)


def test_only_hot_keys_are_broadcast_in_the_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_SHARES", 10)
    df = _many(spark)
    groups = df.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = skew.attach_group_values(df, groups, ["timestamp"], "n", broadcast_groups=0)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1
    assert "Window" not in text


def test_alerts(spark):
    found = {r.key: json.loads(r.value) for r in faults.alerts(faults.detect_faults(_demo(spark))).collect()}
    assert found["panel-3"] == {
        "event_type": "FAULT_DETECTED",
        "panel_id": "panel-3",
        "timestamp": "2024-01-01T12:00:00",
        "details": {"current_power": 50.0, "average_others": 185.0, "deviation": 135.0, "threshold": 50.0},
        "action_required": "Inspect Panel Immediately",
    }


def test_count_comes_with_the_write(spark, tmp_path):
    seen = Observation("faults")
    found = faults.detect_faults(_demo(spark))
    faults.counted(faults.alerts(found), seen).write.json(str(tmp_path / "alerts"))
    assert seen.get == {"fault_count": 3}
    assert rows(faults.fault_summary(found)) == [(3,)]
