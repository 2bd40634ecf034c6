import json
import struct
from datetime import datetime
from decimal import Decimal

from helpers import at, readings_frame, rows
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.operators import skew, stats, telemetry


def _frames(spark):
    return telemetry.split_measurements(
        readings_frame(
            spark,
            [
                ("p1", 0, 800.0, 90.0, 100.0, 20.0),
                ("p1", 2, 800.0, 50.0, 0.0, 30.0),
                ("p2", 0, None, 10.0, 200.0, 40.0),
            ],
        )
    )


def test_join_and_features(spark):
    found = rows(telemetry.enrich(_frames(spark)), "panel_id", "timestamp", "efficiency", "temp_per_power", "tilt_deg")
    assert found == [
        ("p1", at(0), 90.0, 0.2, 30.0),
        ("p1", at(2), None, None, 30.0),
        ("p2", at(0), 5.0, 0.2, 30.0),
    ]


def test_columns_are_in_message_order(spark):
    assert telemetry.enrich(_frames(spark)).columns == [
        "panel_id",
        "timestamp",
        "irradiance_w_m2",
        "power_ac_w",
        "power_dc_w",
        "temperature_c",
        "tilt_deg",
        "azimuth_deg",
        "efficiency",
        "temp_per_power",
    ]


def test_a_missing_or_keyless_measurement_loses_the_reading(spark):
    frames = _frames(spark)
    frames["temperature"] = frames["temperature"].where("panel_id <> 'p2'")
    frames["power_ac"] = frames["power_ac"].withColumn(
        "timestamp", F.when(F.col("timestamp") == at(0), F.col("timestamp"))
    )
    assert rows(telemetry.enrich(frames), "panel_id", "timestamp") == [("p1", at(0))]


def test_grouping_matches_like_the_join(spark):
    frames = _frames(spark)
    assert rows(telemetry.enrich(frames, once_each=True)) == rows(telemetry.enrich(frames))
    assert telemetry.enrich(frames, once_each=True).columns == telemetry.enrich(frames).columns
    frames["temperature"] = frames["temperature"].where("panel_id <> 'p2'").unionAll(frames["temperature"].limit(1))
    frames["orientation"] = frames["orientation"].withColumn("panel_id", F.lit(None).cast("string")).unionAll(
        frames["orientation"].where("panel_id = 'p2'")
    )
    assert rows(telemetry.enrich(frames, once_each=True)) == []


def test_all_joins_share_one_shuffle_per_frame(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = telemetry.enrich(_frames(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(panel_id") == 5


def test_resent_messages_multiply_and_are_counted(spark):
    frames = _frames(spark)
    frames["power_dc"] = frames["power_dc"].unionAll(frames["power_dc"])
    other = frames["irradiance"].withColumn("irradiance_w_m2", F.lit(1.0))
    frames["irradiance"] = frames["irradiance"].unionAll(frames["irradiance"]).unionAll(other)
    plain = telemetry.enrich(frames)
    counted = telemetry.enrich_counted(frames)
    assert plain.count() == 18
    assert counted.count() == 6
    assert rows(counted.groupBy("copies").count()) == [(Decimal(2), 3), (Decimal(4), 3)]
    assert rows(telemetry.expand_copies(counted, block=3)) == rows(plain)
    weighted = stats.window_stats(counted, copies="copies")
    assert rows(weighted) == rows(stats.window_stats(plain))


def _bits(df):
    """Rows with every double as its bytes, so that -0.0 is not 0.0."""
    return sorted(
        (tuple(struct.pack("d", v) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def test_hot_readings_are_found_and_give_the_same_rows(spark, monkeypatch):
    frames = _frames(spark)
    hot = frames["temperature"].limit(1).crossJoin(spark.range(300)).drop("id")
    frames["temperature"] = frames["temperature"].unionAll(hot)
    keyless = frames["power_dc"].withColumn("panel_id", F.lit(None).cast("string"))
    frames["power_dc"] = frames["power_dc"].unionAll(keyless.crossJoin(spark.range(300)).drop("id"))
    frames["irradiance"] = frames["irradiance"].withColumn("irradiance_w_m2", F.lit(-0.0))
    frames["power_ac"] = frames["power_ac"].unionAll(frames["power_ac"].withColumn("power_ac_w", F.lit(0.0)))
    frames["power_ac"] = frames["power_ac"].unionAll(frames["power_ac"].withColumn("power_ac_w", F.lit(-0.0)))
    assert not skew.has_hot_key(list(frames.values()), schemas.KEYS)
    assert skew.has_hot_key([frames["temperature"]], schemas.KEYS, 100)
    assert not skew.has_hot_key([frames["power_dc"]], schemas.KEYS, 100)
    plain = telemetry.enrich(frames)
    monkeypatch.setattr(telemetry, "enrich", None)
    found = telemetry.enrich_table(frames, hot_rows=100)
    monkeypatch.undo()
    assert _bits(found) == _bits(plain) and plain.count() > 300
    assert _bits(telemetry.enrich_table(frames)) == _bits(plain)


def test_copies_are_counted_exactly(spark):
    """More copies than a double can count: 3**34 has 17 digits, and their product with 2 and 1 is exact."""
    one = {k: f.limit(1) for k, f in _frames(spark).items()}
    counted = telemetry.enrich_counted(one)
    big = counted.withColumn("copies", F.lit(3**34).cast(telemetry.WHOLE))
    assert big.first()["copies"] == Decimal(3**34)
    assert dict(counted.dtypes)["copies"] == "decimal(38,0)"
    few = counted.withColumn("copies", F.lit(1234).cast(telemetry.WHOLE))
    assert telemetry.expand_copies(few, block=10).count() == 1234 * counted.count()


def test_fan_out_and_back(spark):
    wide = readings_frame(spark, [("p1", 0.25, 800.0, 90.0, 100.0, 20.0), ("p2", 1, None, 10.0, 200.0, 40.0)])
    messages = telemetry.fan_out(wide).persist()
    found = messages.collect()
    assert sorted(r.topic for r in found if r.key == "p1") == sorted(schemas.TOPICS[k] for k in schemas.KINDS)
    bodies = [json.loads(r.value) for r in found]
    assert len({b["measurement_id"] for b in bodies}) == 10
    assert {b["timestamp"] for b in bodies if b["panel_id"] == "p1"} == {"2024-01-01T12:00:00.250000+00:00"}
    frames = telemetry.measurements_from_messages(messages)
    assert rows(telemetry.join_measurements(frames)) == rows(wide)
    messages.unpersist()


def test_message_ids_outlive_a_repeat(spark):
    data = [("p1", 0.25, 800.0, 90.0, 100.0, 20.0), ("p1", 1, 800.0, 90.0, 100.0, 20.0), ("p2", 1, None, 10.0, 2.0, 4.0)]
    ids = []
    for order in (data, data[::-1]):
        wide = readings_frame(spark, order).repartition(2)
        nobody = wide.limit(1).withColumn("panel_id", F.lit(None).cast("string"))
        sent = telemetry.fan_out(wide.unionAll(nobody)).collect()
        ids.append({(r.topic, r.key, json.loads(r.value)["measurement_id"]) for r in sent})
        assert len({key for _, _, key in ids[-1]}) == 20
    assert {r for r in ids[0] if r[1]} == {r for r in ids[1] if r[1]}


def test_window_stats(spark):
    wide = readings_frame(
        spark,
        [
            ("p1", 0, 100.0, 50.0, 100.0, 20.0),
            ("p1", 59, 300.0, 50.0, 0.0, 40.0),
            ("p1", 60, None, None, None, None),
            ("p2", 30, 10.0, 1.0, 2.0, 3.0),
        ],
    )
    enriched = telemetry.add_features(wide)
    assert rows(stats.window_stats(enriched)) == [
        ("p1", at(0), at(60), 50.0, 30.0, 200.0),
        ("p1", at(60), at(120), None, None, None),
        ("p2", at(0), at(60), 50.0, 3.0, 10.0),
    ]
    day = rows(stats.window_stats(enriched, "1 day"), "panel_id", "window_start", "avg_irradiance")
    assert day == [("p1", datetime(2024, 1, 1), 200.0), ("p2", datetime(2024, 1, 1), 10.0)]


def test_window_stats_messages(spark):
    enriched = telemetry.add_features(readings_frame(spark, [("p1", 0, 100.0, 50.0, 0.0, 20.0)]))
    text = stats.to_messages(stats.window_stats(enriched))
    assert "avg_efficiency" not in text.first().value
    assert rows(stats.from_messages(text)) == [("p1", at(0), at(60), None, 20.0, 100.0)]
