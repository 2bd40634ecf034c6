"""Streams over folders of message files: same answers as the batch operators, late rows, restarts, keyed state."""

import json
import random

import pytest
from helpers import at, readings_frame, rows, stats_frame
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import wire
from heliograph.operators import faults, health, stats, telemetry, tilt, training
from heliograph.sources import brokers, tables
from heliograph.streaming import jobs

ONCE = {"availableNow": True}


def _readings(spark, start, n=60, panels=3, step=7):
    rng = random.Random(start)
    data = [
        (f"p{i % panels}", start + step * (i // panels), rng.uniform(0, 900), rng.uniform(0, 90), dc, 20.0 + i % 80)
        for i, dc in ((i, 100.0 * (i % 5 > 0)) for i in range(n))
    ]
    return readings_frame(spark, data)


def _send(folder, readings):
    folder.write(telemetry.fan_out(readings))


def _closing(spark, seconds):
    """One reading that moves every stream's watermark to 10 seconds before `seconds`."""
    return readings_frame(spark, [("clock", seconds, 1.0, 1.0, 1.0, 1.0)])


@pytest.fixture
def setup(spark, tmp_path):
    base = str(tmp_path)
    return brokers.Folder(f"{base}/in"), brokers.Folder(f"{base}/out"), f"{base}/checkpoints", base


def _windows(spark, out):
    return stats.from_messages(out.history(spark, schemas.TOPICS["window_stats"]))


def _rounded(df):
    means = [F.round(name, 6) for name in ("avg_efficiency", "avg_temp", "avg_irradiance")]
    return rows(df, "panel_id", "window_start", "window_end", *means)


def _batch(spark, readings, before):
    return stats.window_stats(telemetry.add_features(readings)).where(F.col("window_end") <= F.lit(at(before)))


def test_window_stats_late_rows_and_restart(spark, setup):
    source, out, checkpoints, _ = setup
    first = _readings(spark, 0)
    _send(source, first)
    _send(source, _closing(spark, 600))
    query = jobs.start_window_stats(spark, source, out, checkpoints, **ONCE)
    query.awaitTermination()
    assert _rounded(_windows(spark, out)) == _rounded(_batch(spark, first, 590))

    # A row of a closed window comes too late; the query starts again where it stopped.
    late = readings_frame(spark, [("p0", 30, 5000.0, 1.0, 1.0, 500.0)])
    second = _readings(spark, 700)
    _send(source, late)
    _send(source, second)
    _send(source, _closing(spark, 1500))
    query = jobs.start_window_stats(spark, source, out, checkpoints, **ONCE)
    query.awaitTermination()
    whole = first.unionByName(_closing(spark, 600)).unionByName(second)
    assert _rounded(_windows(spark, out)) == _rounded(_batch(spark, whole, 1490))
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped > 0

    # Nothing new: nothing is written again.
    jobs.start_window_stats(spark, source, out, checkpoints, **ONCE).awaitTermination()
    assert _windows(spark, out).count() == _batch(spark, whole, 1490).count()


def test_enriched_stream_equals_batch(spark, setup):
    source, out, checkpoints, _ = setup
    readings = _readings(spark, 0)
    _send(source, readings)
    jobs.start_enriched(spark, source, out, checkpoints, **ONCE).awaitTermination()
    schema = "panel_id STRING, timestamp TIMESTAMP, efficiency DOUBLE, temp_per_power DOUBLE"
    found = wire.decode(out.history(spark, schemas.TOPICS["enriched"]), schema)
    wanted = telemetry.add_features(readings)
    assert rows(found) == rows(wanted, "panel_id", "timestamp", "efficiency", "temp_per_power")


def test_window_stats_from_the_enriched_topic(spark, setup):
    source, out, checkpoints, _ = setup
    readings = _readings(spark, 0)
    _send(source, readings)
    _send(source, _closing(spark, 600))
    jobs.start_enriched(spark, source, source, checkpoints, **ONCE).awaitTermination()
    jobs.start_window_stats(spark, source, out, checkpoints, from_enriched=True, **ONCE).awaitTermination()
    assert _rounded(_windows(spark, out)) == _rounded(_batch(spark, readings, 590))


def test_unreadable_messages_get_a_topic(spark, setup):
    source, out, checkpoints, _ = setup
    texts = ["junk", '{"panel_id":"a","timestamp":"soon","temperature_c":1}']
    texts.append('{"panel_id":"a","timestamp":"2024-01-01T12:00:00Z","temperature_c":"warm"}')
    messages = spark.createDataFrame([("k", t) for t in texts], schemas.WIRE)
    source.write(messages, schemas.TOPICS["temperature"])
    jobs.start_rejects(spark, source, "temperature", out, "rejects", checkpoints, **ONCE).awaitTermination()
    assert rows(out.history(spark, "rejects"), "value") == sorted((t,) for t in texts[:2])


def _history(seed, panels=4, minutes=30):
    rng = random.Random(seed)
    return [
        (f"p{p}", m, rng.choice([3.0, 7.0, 50.0, None]), rng.choice([20.0, 90.0]), rng.choice([5.0, 500.0]))
        for p in range(panels)
        for m in range(minutes)
        if rng.random() < 0.7
    ]


def _publish(spark, folder, windows):
    """Messages in shuffled order within one file drop."""
    shuffled = list(windows)
    random.Random(9).shuffle(shuffled)
    folder.write(stats.to_messages(stats_frame(spark, shuffled)), schemas.TOPICS["window_stats"])


def test_keyed_state_equals_the_timeline(spark, setup):
    source, _, checkpoints, base = setup
    windows = _history(4)
    for low, high in ((0, 9), (9, 10), (10, 30)):
        part = [w for w in windows if low <= w[1] < high]
        _publish(spark, source, part + part[:4])
        jobs.start_panel_changes(spark, source, f"{base}/changes", checkpoints, **ONCE).awaitTermination()
    found = spark.read.parquet(f"{base}/changes")
    assert rows(found) == rows(health.timeline(stats_frame(spark, windows)), *found.columns)


def test_status_table_follows_the_stream(spark, setup):
    source, _, checkpoints, base = setup
    windows = _history(5)
    status = f"{base}/status"
    for low, high in ((0, 5), (5, 20), (20, 30)):
        part = [w for w in windows if low <= w[1] < high]
        _publish(spark, source, part + part[:3])
        jobs.start_panel_status(spark, source, status, checkpoints, keep=2, **ONCE).awaitTermination()
    assert tables.versions(spark, status) == [1, 2]
    assert rows(tables.read_status(spark, status)) == rows(health.latest_status(stats_frame(spark, windows)))
    early = stats_frame(spark, [w for w in windows if w[1] < 20])
    assert rows(tables.read_version(spark, status, 1)) == rows(health.latest_status_by_window(early))


def _reading_stream(spark, path, readings):
    readings.write.mode("append").parquet(path)
    return spark.readStream.schema(readings.schema).parquet(path)


def test_late_and_resent_windows_do_not_turn_a_status_back(spark, setup):
    """A healthy window, then an older broken one and the same one again in later micro-batches."""
    source, _, checkpoints, base = setup
    drops = [
        [("p0", 1, 50.0, 20.0, 500.0), ("p1", 1, 3.0, 20.0, 500.0)],
        [("p0", 5, 50.0, 20.0, 500.0), ("p1", 2, 3.0, 20.0, 500.0)],
        [("p0", 2, 3.0, 20.0, 500.0), ("p1", 2, 3.0, 20.0, 500.0), ("p1", 0, 50.0, 20.0, 500.0)],
        [("p0", 5, 50.0, 20.0, 500.0), ("p1", 3, 50.0, 20.0, 500.0)],
    ]
    for drop in drops:
        _publish(spark, source, drop)
        jobs.start_panel_changes(spark, source, f"{base}/changes", checkpoints, **ONCE).awaitTermination()
        jobs.start_panel_status(spark, source, f"{base}/status", checkpoints, **ONCE).awaitTermination()
    accepted = stats_frame(spark, drops[0] + drops[1] + drops[3][1:])
    found = spark.read.parquet(f"{base}/changes")
    assert rows(found) == rows(health.timeline(accepted), *found.columns)
    assert rows(tables.read_status(spark, f"{base}/status")) == rows(health.latest_status(accepted))


@pytest.mark.parametrize("leave_one_out", [False, True])
def test_faults_do_not_depend_on_micro_batches(spark, setup, leave_one_out):
    """Readings of an hour in several micro-batches and two starts, an hour that stays open, and late readings."""
    _, out, checkpoints, base = setup
    whole = _readings(spark, 0, n=60, panels=4, step=500)
    path, counts = f"{base}/readings", {}
    options = {"bucket": "1 hour", "threshold": 15.0, "leave_one_out": leave_one_out, "on_count": counts.__setitem__}
    times = F.unix_seconds("timestamp") - F.lit(int(at(0).timestamp()))
    cuts = [0, 900, 2500, 4100, 9000]
    parts = [whole.where((times >= a) & (times < b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    late = parts[0].withColumn("power_dc_w", F.lit(1e6))
    for number, part in enumerate([*parts, late]):
        part.coalesce(1).write.mode("append").parquet(path)
        if number in (1, 3, 4):
            stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(path)
            jobs.start_fault_alerts(stream, out, checkpoints, **options, **ONCE).awaitTermination()
    last = whole.agg(F.max("timestamp")).first()[0].timestamp() - 10
    wanted = faults.detect_faults(whole, "1 hour", leave_one_out, 15.0)
    wanted = wanted.where(F.unix_seconds("peer_time") + 3600 <= last)
    keyed = lambda df: sorted((r.key, json.loads(r.value)["timestamp"]) for r in df.collect())
    found = out.history(spark, schemas.TOPICS["faults"])
    assert keyed(found) == keyed(faults.alerts(wanted, 15.0)) and found.count() > 0
    assert sum(counts.values()) == found.count()


def test_control_commands_from_live_readings(spark, setup):
    _, out, checkpoints, base = setup
    readings = _readings(spark, 0, n=90)
    model = training.fit(readings, maxIter=2)
    stream = _reading_stream(spark, f"{base}/readings", readings)
    jobs.start_tilt_control(stream, lambda: model, out, checkpoints, **ONCE).awaitTermination()
    schema = "panel_id STRING, timestamp STRING, target_tilt DOUBLE"
    found = wire.decode(out.history(spark, schemas.TOPICS["control"]), schema)
    wanted = tilt.commands(training.optimal_tilt(readings, model))
    assert rows(found) == rows(wanted, "panel_id", "timestamp", "target_tilt")


def test_several_queries_run_side_by_side(spark, setup):
    source, out, checkpoints, _ = setup
    _send(source, _readings(spark, 0, n=15))
    one = jobs.start_enriched(spark, source, out, checkpoints, **ONCE)
    two = jobs.start_window_stats(spark, source, out, checkpoints, **ONCE)
    jobs.await_any(spark)
    one.awaitTermination()
    two.awaitTermination()
    spark.streams.resetTerminated()
    assert out.history(spark, schemas.TOPICS["enriched"]).count() == 15


def test_copies_are_counted_in_state(spark, setup):
    source, out, checkpoints, _ = setup
    readings = _readings(spark, 0)
    _send(source, readings)
    one = telemetry.fan_out(readings.limit(1))
    again = one.where(F.col("topic") == schemas.TOPICS["temperature"])
    source.write(again.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(1500)))).drop("_copy"))
    _send(source, _closing(spark, 600))
    query = jobs.start_window_stats(spark, source, out, checkpoints, counted=True, **ONCE)
    query.awaitTermination()
    most = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    assert most <= 5 * 61
    messages = {k: source.history(spark, schemas.TOPICS[k]) for k in schemas.KINDS}
    frames = {k: wire.decode(m, schemas.measurement_schema(k)) for k, m in messages.items()}
    wanted = stats.window_stats(telemetry.enrich(frames)).where(F.col("window_end") <= F.lit(at(590)))
    assert _rounded(_windows(spark, out)) == _rounded(wanted)


def test_counted_match_equals_counted_join(spark):
    readings = _readings(spark, 0)
    frames = telemetry.split_measurements(readings)
    frames["irradiance"] = frames["irradiance"].unionAll(frames["irradiance"].limit(7)).unionAll(frames["irradiance"].limit(3))
    frames["power_ac"] = frames["power_ac"].unionAll(frames["power_ac"].limit(5).withColumn("power_ac_w", F.lit(1.5)))
    assert rows(telemetry.match_counted(frames).select(*sorted(telemetry.match_counted(frames).columns))) == rows(
        telemetry.enrich_counted(frames).select(*sorted(telemetry.enrich_counted(frames).columns))
    )


def test_late_windows_are_put_in_order(spark, setup):
    """Any window of the last ten minutes may come with a later drop, and some come again after they were judged."""
    source, _, checkpoints, base = setup
    windows = _history(11, panels=3, minutes=60)
    drops = [
        [w for w in windows if w[1] < 20 and not (w[1] >= 11 and w[1] % 2)],
        [w for w in windows if 20 <= w[1] < 40 or (11 <= w[1] < 20 and w[1] % 2) or w[1] in (2, 18)],
        [w for w in windows if 40 <= w[1] or w[1] in (5, 38)],
    ]
    for drop in drops:
        _publish(spark, source, drop + drop[:4])
        started = jobs.start_panel_changes(
            spark, source, f"{base}/changes", checkpoints, lateness="10 minutes", **ONCE
        )
        started.awaitTermination()
    # Nothing but time passes: the windows that waited are judged by a panel that is heard of no more.
    _publish(spark, source, [("clock", 100, 50.0, 20.0, 500.0)])
    jobs.start_panel_changes(
        spark, source, f"{base}/changes", checkpoints, lateness="10 minutes", **ONCE
    ).awaitTermination()
    found = spark.read.parquet(f"{base}/changes")
    assert rows(found) == rows(health.timeline(stats_frame(spark, windows)), *found.columns)


def test_windows_beyond_the_lateness_are_dropped(spark, setup):
    source, _, checkpoints, base = setup
    drops = [
        [("p0", 0, 50.0, 20.0, 500.0), ("p0", 30, 3.0, 20.0, 500.0), ("p1", 1, None, None, None)],
        [("p0", 10, 3.0, 20.0, 500.0), ("p0", 25, 3.0, 90.0, 500.0), ("p0", 90, 50.0, 20.0, 500.0)],
        [("p0", 200, 50.0, 20.0, 500.0)],
    ]
    for drop in drops:
        _publish(spark, source, drop)
        jobs.start_panel_changes(
            spark, source, f"{base}/changes", checkpoints, lateness="10 minutes", **ONCE
        ).awaitTermination()
    accepted = [*drops[0], *drops[1][1:]]
    found = spark.read.parquet(f"{base}/changes")
    assert rows(found) == rows(health.timeline(stats_frame(spark, accepted)), *found.columns)
