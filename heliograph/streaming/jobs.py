"""The streaming jobs: enriched features, window statistics, panel status, fault alerts, tilt control.

Each `start_*` function takes a source and a sink from `heliograph.sources.brokers` and a folder for checkpoints, and
returns the running query. `trigger` arguments are those of `DataStreamWriter.trigger`. State settings are those of
`session.state_settings`; the number of state partitions is `spark.sql.shuffle.partitions`, or that of an enclosing
`session.state_partitions`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from heliograph import schemas, session
from heliograph.functions import wire
from heliograph.operators import faults, health, stats, telemetry, tilt, training
from heliograph.sources import brokers, status_log, tables
from heliograph.streaming import panel_state

Broker = brokers.Kafka | brokers.Folder
Sink = Broker | brokers.Console


def measurement_stream(spark: SparkSession, source: Broker, kind: str, delay: str = schemas.WATERMARK) -> DataFrame:
    """One parsed and watermarked measurement stream."""
    messages = source.stream(spark, schemas.TOPICS[kind])
    return telemetry.watermarked(wire.decode(messages, schemas.measurement_schema(kind)), delay)


def enriched_stream(
    spark: SparkSession, source: Broker, delay: str = schemas.WATERMARK, once_each: bool = False
) -> DataFrame:
    """Join of the five measurement streams with derived features. The slowest stream sets the watermark.

    `once_each` matches by grouping, with less state (see `telemetry.match_measurements`).
    """
    streams = {kind: measurement_stream(spark, source, kind, delay) for kind in schemas.KINDS}
    return telemetry.enrich(streams, once_each)


def window_stats_stream(spark: SparkSession, source: Broker) -> DataFrame:
    """Window statistics written earlier as messages."""
    return stats.from_messages(source.stream(spark, schemas.TOPICS["window_stats"]))


def send(messages: DataFrame, sink: Sink, topic: str | None, checkpoint: str, **trigger) -> StreamingQuery:
    """Stream messages to a topic, or to the topic each row names."""
    with session.state_settings(messages.sparkSession):
        return sink.start(messages, topic, checkpoint, **trigger)


def start_enriched(
    spark: SparkSession, source: Broker, sink: Sink, checkpoints: str, once_each: bool = False, **trigger
) -> StreamingQuery:
    """Enriched readings as JSON messages."""
    messages = wire.encode(enriched_stream(spark, source, once_each=once_each), key="panel_id")
    return send(messages, sink, schemas.TOPICS["enriched"], f"{checkpoints}/enriched", **trigger)


def start_rejects(
    spark: SparkSession, source: Broker, kind: str, sink: Sink, topic: str, checkpoints: str, **trigger
) -> StreamingQuery:
    """Messages of one measurement kind that lack a readable panel or time, unchanged, to a topic of their own."""
    messages = source.stream(spark, schemas.TOPICS[kind]).select("key", "value")
    rejects = wire.decode_with_rejects(messages, schemas.measurement_schema(kind), schemas.KEYS)[1]
    return send(rejects, sink, topic, f"{checkpoints}/rejects_{kind}", **trigger)


def rejoined_stream(spark: SparkSession, source: Broker, delay: str = schemas.WATERMARK) -> DataFrame:
    """Enriched readings as an enriched-features job has written them, to save joining the five streams again."""
    columns = "panel_id STRING, timestamp TIMESTAMP, efficiency DOUBLE, temperature_c DOUBLE, irradiance_w_m2 DOUBLE"
    return telemetry.watermarked(wire.decode(source.stream(spark, schemas.TOPICS["enriched"]), columns), delay)


def start_window_stats(
    spark: SparkSession,
    source: Broker,
    sink: Sink,
    checkpoints: str,
    width: str = schemas.WINDOW,
    from_enriched: bool = False,
    once_each: bool = False,
    counted: bool = False,
    **trigger,
) -> StreamingQuery:
    """Window statistics as JSON messages, each window once, when the watermark has passed its end.

    With `from_enriched` the input is the topic that `start_enriched` writes, and only one job keeps join state. With
    `counted`, for feeds that may send a message very often, copies are counted before they meet and weigh the averages.
    """
    if from_enriched:
        enriched = rejoined_stream(spark, source)
    elif counted:
        enriched = telemetry.match_counted({kind: measurement_stream(spark, source, kind) for kind in schemas.KINDS})
    else:
        enriched = enriched_stream(spark, source, once_each=once_each)
    copies = telemetry.COPIES if counted and not from_enriched else None
    messages = stats.to_messages(stats.window_stats(enriched, width, copies))
    return send(messages, sink, schemas.TOPICS["window_stats"], f"{checkpoints}/window_stats", **trigger)


def start_panel_changes(
    spark: SparkSession,
    source: Broker,
    path: str,
    checkpoints: str,
    clock: Column | None = None,
    lateness: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Change log of panel status from keyed state, as a parquet table.

    With `lateness`, windows wait that long for earlier ones and are judged in the order of time. Without it they are
    judged at once, and one that does not begin after the last of its panel is rejected.
    """
    windows = window_stats_stream(spark, source)
    if lateness is None:
        changes = panel_state.panel_changes(windows, clock)
    else:
        changes = panel_state.ordered_changes(windows, lateness, clock)
    writer = changes.writeStream.format("parquet").outputMode("append").option("path", path)
    with session.state_settings(spark):
        return _start(writer.option("checkpointLocation", f"{checkpoints}/panel_changes"), trigger)


def start_panel_status(
    spark: SparkSession,
    source: Broker,
    base: str,
    checkpoints: str,
    keep: int = 10,
    clock: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Panel status table, one new version per micro-batch, of which the newest `keep` (two or more) stay.

    Micro-batch n reads version n - 1 and writes version n. A repeated micro-batch therefore reads the same input and
    replaces only what it wrote itself. One table belongs to one checkpoint. Windows that do not begin after the last
    one of their panel are rejected (see `health.advance_status`).
    """

    def advance(windows: DataFrame, batch_id: int) -> None:
        own = windows.sparkSession
        current = tables.read_version(own, base, batch_id - 1) if batch_id else tables.empty_status(own)
        advanced = health.advance_status(current, stats.distinct_windows(windows), clock)
        tables.write_version(advanced, base, batch_id)
        tables.forget_versions(own, base, max(keep, 2))

    return _for_each(window_stats_stream(spark, source), advance, f"{checkpoints}/panel_status", trigger)


def start_status_log(
    spark: SparkSession,
    source: Broker,
    base: str,
    checkpoints: str,
    buckets: int = status_log.BUCKETS,
    compact_every: int = status_log.COMPACT_EVERY,
    clock: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Panel status kept as a base and changes, for fleets of which a micro-batch hears only a part.

    The same status as `start_panel_status` keeps; a micro-batch writes the panels that it touches and reads their buckets.
    Every `compact_every` micro-batches the changes are merged into a new base.
    """

    def advance(windows: DataFrame, batch_id: int) -> None:
        status_log.advance(windows, base, batch_id, buckets, clock)
        if (batch_id + 1) % compact_every == 0:
            status_log.compact(windows.sparkSession, base, batch_id, buckets)

    return _for_each(window_stats_stream(spark, source), advance, f"{checkpoints}/status_log", trigger)


def start_fault_alerts(
    readings: DataFrame,
    sink: Sink,
    checkpoints: str,
    bucket: str = "1 hour",
    leave_one_out: bool = False,
    threshold: float = faults.THRESHOLD_W,
    delay: str = schemas.WATERMARK,
    on_count: Callable[[int, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Fault alerts for a stream of readings; the peers of a reading are all readings of its time `bucket`.

    A bucket is judged when the watermark has passed it, so its alerts do not depend on which readings came together.
    `on_count` is told the micro-batch id and its number of faults, counted while they are written.
    """
    found = faults.detect_faults_stream(readings, bucket, leave_one_out, threshold, delay)

    def report(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        sink.write(faults.counted(faults.alerts(batch, threshold), seen), schemas.TOPICS["faults"], batch_id)
        if on_count:
            on_count(batch_id, seen.get["fault_count"])

    return _for_each(found, report, f"{checkpoints}/faults", trigger)


def start_tilt_control(
    readings: DataFrame, model: Callable[[], PipelineModel], sink: Sink, checkpoints: str, **trigger
) -> StreamingQuery:
    """Control commands for a stream of readings. `model` is asked for the model of each micro-batch, so that a refit
    takes effect without a restart."""

    def control(batch: DataFrame, batch_id: int) -> None:
        asked = tilt.valid_requests(batch) if "send_to_kafka" in batch.columns else batch
        chosen = training.optimal_tilt(asked, model())
        sink.write(wire.encode(tilt.commands(chosen), key="panel_id"), schemas.TOPICS["control"], batch_id)

    return _for_each(readings, control, f"{checkpoints}/control", trigger)


def start_fan_out(readings: DataFrame, sink: Sink, checkpoints: str, **trigger) -> StreamingQuery:
    """Wide readings as one message per measurement kind, each in its own topic."""
    return send(telemetry.fan_out(readings), sink, None, f"{checkpoints}/fan_out", **trigger)


def training_history(
    spark: SparkSession, source: Broker, topic: str = schemas.TOPICS["sensors"], max_messages: int | None = None
) -> DataFrame:
    """Training records of all messages a topic holds, or of its first `max_messages` usable ones in arrival order."""
    messages = source.history(spark, topic)
    order = [name for name in ("timestamp", "partition", "offset") if name in messages.columns]
    arrived = messages.withColumnsRenamed({name: f"_arrival_{name}" for name in order})
    arrival = [f"_arrival_{name}" for name in order]
    records = training.training_records(arrived, keep=tuple(arrival))
    if max_messages is not None:
        records = training.earliest(records, arrival or schemas.KEYS[::-1], max_messages)
    return records.drop(*arrival)


def await_any(spark: SparkSession) -> None:
    """Block until one of the session's queries ends or fails."""
    spark.streams.awaitAnyTermination()


def _for_each(stream: DataFrame, work: Callable, checkpoint: str, trigger: dict) -> StreamingQuery:
    with session.state_settings(stream.sparkSession):
        return _start(stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), trigger)


def _start(writer, trigger: dict) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()
