"""The registered queries: name -> (spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from heliograph import schemas, session
from heliograph.functions import scalars, wire
from heliograph.operators import faults, fleet, health, stats, telemetry, tilt, training
from heliograph.plans import feed
from heliograph.sources import brokers, pages, registry, status_log, tables
from heliograph.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MINUTE, DAY, HOUR = "1 minute", "1 day", "1 hour"

# Added before rounding, here and in the SQL.
NUDGE = 3.17e-8

# Status tables are cut at this time: the windows before it make the current table, the later ones update it.
CUT = "2024-01-20 00:00:00"

# Closed windows reach the status jobs in drops that end at these times.
WINDOW_DROPS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def _plain_times(df: DataFrame) -> DataFrame:
    """Times as UTC wall clock, so that they compare with SQL timestamps whatever the reader's zone."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


# Events whose state one partition holds. A task's memory goes with it, so a larger table gets more partitions.
STATE_EVENTS = 500_000

# The same for streams that group messages, each several times in a task's memory on its way through the state.
GROUPED_EVENTS = 100_000
GROUPING = {"stream_window_stats_by_grouping", "stream_window_stats_resent", "stream_job_window_stats"}


def _state_partitions(spark: SparkSession, sf_dir: str, grouping: bool = False) -> int:
    """One state partition per core, or more for a large table."""
    each = min(GROUPED_EVENTS, STATE_EVENTS) if grouping else STATE_EVENTS
    needed = -(-feed.events(spark, sf_dir).count() // each)
    return max(spark.sparkContext.defaultParallelism, needed)


def _query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.prepare(spark)
        if not function.__name__.startswith("stream_"):
            return _plain_times(function(spark, sf_dir))
        # The streams run to their end in here.
        partitions = _state_partitions(spark, sf_dir, function.__name__ in GROUPING)
        with session.state_partitions(spark, partitions), session.uncounted_state(spark), session.small_splits(spark):
            return _plain_times(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals, as sums in another order differ in the last digits.

    The nudge moves means that end on a 5 in the seventh place off the edge, where those digits would decide.
    """
    return df.withColumns({name: F.round(F.col(name) + NUDGE, 6) for name in names})


def _averages(df: DataFrame) -> DataFrame:
    return _rounded(df, *[n for n in df.columns if n.startswith(("avg_", "average_"))])


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.enrich_table(feed.measurements(feed.events(spark, sf_dir)))


def _stats(spark: SparkSession, sf_dir: str, width: str) -> DataFrame:
    return stats.window_stats(_enriched(spark, sf_dir), width)


def _status(spark: SparkSession, sf_dir: str, width: str = DAY) -> DataFrame:
    return _averages(health.latest_status(_stats(spark, sf_dir, width)))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.readings(feed.events(spark, sf_dir))


# --- enriched readings and window statistics


@_query
def enriched_features(spark, sf_dir):
    return _enriched(spark, sf_dir)


@_query
def enriched_by_grouping(spark, sf_dir):
    """The five frames matched in one shuffle."""
    return telemetry.enrich(feed.measurements(feed.events(spark, sf_dir)), once_each=True)


@_query
def enriched_messages(spark, sf_dir):
    """Enriched readings as JSON, read back: NULL fields are missing and times have milliseconds."""
    text = wire.encode(_enriched(spark, sf_dir), key="panel_id")
    schema = "timestamp TIMESTAMP, power_ac_w DOUBLE, efficiency DOUBLE, temp_per_power DOUBLE"
    n_fields = F.size(F.map_keys(wire.fields(F.col("value")))).alias("n_fields")
    return text.select("key", n_fields, F.from_json("value", schema).alias("d")).select("key", "n_fields", "d.*")


@_query
def enriched_resent(spark, sf_dir):
    """Resent messages multiply through the join; counted, joined, and expanded again."""
    return telemetry.expand_copies(telemetry.enrich_counted(feed.resent(feed.events(spark, sf_dir))))


@_query
def enriched_hot_readings(spark, sf_dir):
    """Some temperatures are sent 1,500 times more: keys are counted, and the counted join is taken."""
    return telemetry.enrich_table(feed.with_hot_readings(feed.events(spark, sf_dir), 1500))


@_query
def window_stats_1m(spark, sf_dir):
    return _averages(_stats(spark, sf_dir, MINUTE))


@_query
def window_stats_1d(spark, sf_dir):
    return _averages(_stats(spark, sf_dir, DAY))


@_query
def window_stats_resent(spark, sf_dir):
    """Daily statistics of a feed with resent messages, without ever making the multiplied rows."""
    counted = telemetry.enrich_counted(feed.resent(feed.events(spark, sf_dir)))
    return _averages(stats.window_stats(counted, DAY, copies=telemetry.COPIES))


@_query
def window_stats_messages(spark, sf_dir):
    """Daily statistics as JSON messages and back."""
    text = stats.to_messages(_stats(spark, sf_dir, DAY))
    return _averages(stats.from_messages(text))


@_query
def window_stats_from_messages(spark, sf_dir):
    """JSON messages of all five topics, parsed, joined and averaged per minute."""
    rows = feed.events(spark, sf_dir)
    frames = {
        kind: wire.decode(feed.messages(rows, [kind]), schemas.measurement_schema(kind)) for kind in schemas.KINDS
    }
    return _averages(stats.window_stats(telemetry.enrich_table(frames), MINUTE))


@_query
def expected_power(spark, sf_dir):
    return _rounded(telemetry.expected_against_actual(_readings(spark, sf_dir)), "shortfall_w").select(
        *schemas.KEYS, "irradiance_w_m2", "tilt_deg", "power_dc_w", "expected_power_w", "shortfall_w"
    )


@_query
def angle_helpers(spark, sf_dir):
    """Clamped tilt, wrapped azimuth and share of the day of every reading."""
    rows = _readings(spark, sf_dir)
    moved = F.col("tilt_deg") * F.col("temperature_c") / 20 - 30
    return _rounded(
        rows.select(
            *schemas.KEYS,
            scalars.clamp(moved, 0, 90).alias("clamped_tilt"),
            scalars.wrap_degrees(F.col("azimuth_deg") * F.col("temperature_c") - 9000).alias("wrapped_azimuth"),
            scalars.day_phase(F.col("timestamp")).alias("day_phase"),
        ),
        "clamped_tilt",
        "wrapped_azimuth",
        "day_phase",
    )


# --- peer faults


def _faults(spark, sf_dir, bucket=None, leave_one_out=False) -> DataFrame:
    rows = _readings(spark, sf_dir).select(*schemas.KEYS, "irradiance_w_m2", "power_dc_w")
    return faults.detect_faults(rows, bucket, leave_one_out)


@_query
def peer_faults_exact(spark, sf_dir):
    """Peers by exact time: every reading is taken by three panels at once, whose powers differ by up to 120 W."""
    rows = feed.read_together(_readings(spark, sf_dir))
    return _rounded(faults.detect_faults(rows), "avg_power", "deviation")


@_query
def peer_faults_hourly(spark, sf_dir):
    return _rounded(_faults(spark, sf_dir, HOUR), "avg_power", "deviation")


@_query
def peer_faults_leave_one_out(spark, sf_dir):
    return _rounded(_faults(spark, sf_dir, HOUR, leave_one_out=True), "avg_power", "deviation")


@_query
def peer_deviation_daily(spark, sf_dir):
    """Deviation of every reading from the day's mean, before any threshold."""
    rows = _readings(spark, sf_dir).select(*schemas.KEYS, "power_dc_w")
    return _rounded(faults.compare_with_peers(rows, DAY), "avg_power", "deviation")


@_query
def fault_count(spark, sf_dir):
    return faults.fault_summary(_faults(spark, sf_dir, HOUR))


@_query
def fault_preview(spark, sf_dir):
    return _rounded(faults.preview(_faults(spark, sf_dir, HOUR)), "avg_power", "deviation")


@_query
def fault_alerts(spark, sf_dir):
    """Alert messages, read back from their JSON."""
    schema = (
        "event_type STRING, panel_id STRING, timestamp STRING, action_required STRING, "
        "details STRUCT<current_power: DOUBLE, average_others: DOUBLE, deviation: DOUBLE, threshold: DOUBLE>"
    )
    parsed = faults.alerts(_faults(spark, sf_dir, HOUR)).select("key", F.from_json("value", schema).alias("a"))
    flat = parsed.select("key", "a.event_type", "a.panel_id", "a.timestamp", "a.action_required", "a.details.*")
    return _rounded(flat, "average_others", "deviation")


# --- health and status


@_query
def panel_health(spark, sf_dir):
    rows = health.classify(_stats(spark, sf_dir, DAY))
    return rows.select("panel_id", "window_start", "window_end", "reason_code", "is_broken")


@_query
def panel_health_1m(spark, sf_dir):
    rows = health.classify(_stats(spark, sf_dir, MINUTE))
    return rows.select("panel_id", "window_start", "window_end", "reason_code", "is_broken", "reason")


@_query
def panel_timeline(spark, sf_dir):
    """Status of every panel after each minute it reported in."""
    return _averages(health.timeline(_stats(spark, sf_dir, MINUTE)).drop("as_of", "from_start"))


@_query
def one_panel_timeline(spark, sf_dir):
    """Status after each second of a single panel that has all readings, made in pieces of a day."""
    readings = _enriched(spark, sf_dir).withColumn("panel_id", F.lit("fleet"))
    rows = health.timeline_in_pieces(stats.window_stats(readings, "1 second"), DAY)
    return _averages(rows.drop("as_of", "from_start"))


@_query
def status_transitions(spark, sf_dir):
    rows = health.transitions(_stats(spark, sf_dir, MINUTE))
    return rows.select("panel_id", "window_start", "change", "reason_code", "reason", "broken_since")


@_query
def panel_status_latest(spark, sf_dir):
    return _status(spark, sf_dir, MINUTE)


@_query
def panel_status_daily(spark, sf_dir):
    return _status(spark, sf_dir)


def _cut_stats(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    # Read by both halves, and made once.
    rows = session.materialise(_stats(spark, sf_dir, MINUTE), "window_stats")
    cut = F.lit(CUT).cast("timestamp")
    return rows.where(F.col("window_start") < cut), rows.where(F.col("window_start") >= cut)


@_query
def status_upsert(spark, sf_dir):
    """Status of the later windows merged into that of the earlier ones, rows replaced whole."""
    earlier, later = _cut_stats(spark, sf_dir)
    return _averages(health.upsert_status(health.latest_status(earlier), health.latest_status(later)))


@_query
def status_advance(spark, sf_dir):
    """Status table advanced by the later windows; equals the status of all windows at once."""
    earlier, later = _cut_stats(spark, sf_dir)
    return _averages(health.advance_status(health.latest_status(earlier), later))


@_query
def status_table(spark, sf_dir):
    """Status written as two versions of a table and read back from the newest."""
    earlier, later = _cut_stats(spark, sf_dir)
    base = session.run_dir(spark, "status_table")
    tables.write_version(health.latest_status_by_window(earlier), base, 1)
    tables.write_version(health.advance_status(tables.read_version(spark, base, 1), later), base, 2)
    return _averages(tables.read_status(spark, base))


@_query
def nan_guards(spark, sf_dir):
    """Rules and requests on values of which a third each are NaN: no rule fires for NaN, and NaN is no light."""
    rows = feed.events(spark, sf_dir)
    nan = F.lit(float("nan"))
    odd = lambda n, value: F.when(F.col("event_id") % 3 == n, nan).otherwise(value)
    columns = {
        "avg_efficiency": odd(0, F.col("value") / 10),
        "avg_temp": odd(1, F.col("value")),
        "avg_irradiance": odd(2, F.col("value") * 3),
        "irradiance_w_m2": odd(2, F.col("value") - 50),
        "temperature_c": F.col("value"),
    }
    answered = tilt.valid_requests(rows.withColumns({**columns, **feed.anonymous()}), feed.no_time())
    coded = answered.select("event_id", health.reason_code().alias("reason_code"))
    refused = tilt.rejected_requests(rows.withColumns({**columns, **feed.anonymous()}), feed.no_time())
    return coded.unionByName(refused.select("event_id", F.lit(-1).alias("reason_code")))


# --- questions about the fleet


@_query
def panel_page(spark, sf_dir):
    return fleet.list_panels(_status(spark, sf_dir), skip=5, limit=20)


@_query
def panel_page_after(spark, sf_dir):
    """The page behind a panel."""
    return fleet.list_panels_after(_status(spark, sf_dir), "panel-3", limit=20)


@_query
def timeline_page(spark, sf_dir):
    """A page from deep in the timeline of all panels, by a directory of ranges."""
    found = health.timeline(_stats(spark, sf_dir, MINUTE)).drop("as_of", "from_start")
    rows, path, order = session.materialise(found, "timeline"), session.run_dir(spark, "pages"), ["panel_id", "window_start"]
    pages.write_pages(rows, path, order, range_rows=100)
    return _averages(pages.read_page(spark, path, rows.schema, order, skip=750, limit=120))


@_query
def panel_lookup(spark, sf_dir):
    return fleet.get_panel(_status(spark, sf_dir), "panel-7")


@_query
def broken_panels(spark, sf_dir):
    return fleet.broken_panels(_status(spark, sf_dir))


@_query
def fleet_statistics(spark, sf_dir):
    return _averages(fleet.fleet_statistics(_status(spark, sf_dir)))


@_query
def panel_report(spark, sf_dir):
    return fleet.panel_report(_status(spark, sf_dir))


@_query
def broken_report(spark, sf_dir):
    return fleet.broken_report(_status(spark, sf_dir))


@_query
def fleet_report(spark, sf_dir):
    return fleet.fleet_report(_status(spark, sf_dir))


# --- messages


@_query
def measurement_fanout(spark, sf_dir):
    """Five messages per reading, read back from their JSON."""
    measures = ", ".join(schemas.MEASURES[kind] for kind in schemas.KINDS)
    schema = f"measurement_id STRING, panel_id STRING, timestamp STRING, {measures}"
    rows = feed.messages(feed.events(spark, sf_dir))
    return rows.select("topic", "key", F.from_json("value", schema).alias("m")).select("topic", "key", "m.*")


@_query
def message_ids(spark, sf_dir):
    """Ids that the messages of all readings, and commands for them, have in every run."""
    readings = _readings(spark, sf_dir)
    sent = telemetry.fan_out(readings).select("topic", "key", F.get_json_object("value", "$.measurement_id").alias("id"))
    commands = tilt.commands(readings.withColumn("optimal_tilt", F.col("tilt_deg")))
    return sent.unionAll(commands.select(F.lit(schemas.TOPICS["control"]), "panel_id", "message_id"))


@_query
def json_parse(spark, sf_dir):
    """Readable temperature messages; a quoted number or a bad time is NULL in that field alone."""
    schema = schemas.measurement_schema("temperature")
    rows = wire.decode(feed.raw_messages(feed.events(spark, sf_dir)), schema)
    return rows.where("panel_id IS NOT NULL")


@_query
def json_complete(spark, sf_dir):
    """Temperature messages with every field readable."""
    rows = feed.raw_messages(feed.events(spark, sf_dir))
    return wire.decode_with_rejects(
        rows, schemas.measurement_schema("temperature"), ["panel_id", "timestamp", "temperature_c"]
    )[0]


@_query
def json_rejects(spark, sf_dir):
    """The other temperature messages."""
    rows = feed.raw_messages(feed.events(spark, sf_dir))
    rejects = wire.decode_with_rejects(
        rows, schemas.measurement_schema("temperature"), ["panel_id", "timestamp", "temperature_c"]
    )[1]
    return rejects.select("key", F.length("value").alias("n_chars"))


@_query
def training_records(spark, sf_dir):
    """All usable training messages with their hour of day."""
    rows = training.training_records(feed.training_messages(feed.events(spark, sf_dir)), feed.no_time())
    return training.add_hour(rows)


@_query
def training_rejects(spark, sf_dir):
    return training.training_rejects(feed.training_messages(feed.events(spark, sf_dir))).select("key")


@_query
def training_window(spark, sf_dir):
    """The first 500 usable training records, as a refit takes them."""
    rows = training.training_records(feed.training_messages(feed.events(spark, sf_dir)), feed.no_time())
    return training.earliest(rows, ["timestamp", "panel_id"])


# --- tilt


def _requests(spark, sf_dir) -> DataFrame:
    return feed.prediction_requests(feed.events(spark, sf_dir))


def _light(angle: Column) -> Column:
    """Score for queries checked by SQL: light reaching a panel whose ideal tilt is known."""
    return F.col("irradiance_w_m2") * F.cos(F.radians(angle - F.col("ideal_tilt")))


@_query
def prediction_requests_valid(spark, sf_dir):
    return tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())


@_query
def prediction_requests_rejected(spark, sf_dir):
    return tilt.rejected_requests(_requests(spark, sf_dir), feed.no_time())


@_query
def tilt_candidates(spark, sf_dir):
    return tilt.candidates(_readings(spark, sf_dir)).select("panel_id", "timestamp", *training.FEATURES)


@_query
def best_tilt(spark, sf_dir):
    """Best candidate per request by known ideal tilt; half of the requests tie between two candidates."""
    requests = tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())
    chosen = tilt.best_tilt(requests, lambda angle: _light(F.lit(angle)))
    return _rounded(chosen, "predicted_power").select("event_id", "panel_id", "optimal_tilt", "predicted_power")


@_query
def best_candidates(spark, sf_dir):
    """The same choice made over written-out candidate rows."""
    requests = tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())
    scored = tilt.candidates(requests).withColumn("prediction", _light(F.col("tilt_deg")))
    chosen = tilt.best_candidates(scored, ["event_id"])
    return _rounded(chosen, "prediction").select("event_id", "panel_id", "hour", "tilt_deg", "prediction")


@_query
def top_candidates(spark, sf_dir):
    """The 25 best-scored candidates of all requests."""
    requests = tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())
    scored = _rounded(tilt.candidates(requests).withColumn("prediction", _light(F.col("tilt_deg"))), "prediction")
    return tilt.ranked_candidates(scored, 25).select("event_id", "tilt_deg", "prediction")


@_query
def control_commands(spark, sf_dir):
    requests = tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())
    chosen = tilt.best_tilt(requests, lambda angle: _light(F.lit(angle)))
    return tilt.commands(chosen, F.col("event_id").cast("string"))


@_query
def prediction_responses(spark, sf_dir):
    requests = tilt.valid_requests(_requests(spark, sf_dir), feed.no_time())
    chosen = tilt.best_tilt(requests, lambda angle: _light(F.lit(angle)))
    return _rounded(tilt.prediction_response(chosen), "predicted_power")


def _model(spark, sf_dir, **params):
    return training.fit(_enriched(spark, sf_dir), **(params or training.QUICK))


@_query
def optimal_tilt(spark, sf_dir):
    """Model fitted on the enriched readings, then the best tilt for every reading."""
    chosen = training.optimal_tilt(_readings(spark, sf_dir), _model(spark, sf_dir))
    return chosen.select(*schemas.KEYS, "irradiance_w_m2", "temperature_c", "optimal_tilt", "predicted_power")


def _on_grid(tilt_column: str) -> Column:
    """Whether a tilt the model chose is one of the candidates. SQL cannot repeat the choice itself."""
    return F.col(tilt_column).isin(*tilt.TILTS).alias("tilt_on_grid")


@_query
def optimal_tilt_starting(spark, sf_dir):
    """Best tilt for every reading by the model of the time before the first fit."""
    chosen = training.optimal_tilt(_readings(spark, sf_dir), training.starting_model())
    return _rounded(chosen, "predicted_power").select(*schemas.KEYS, "optimal_tilt", "predicted_power")


@_query
def candidate_scores_starting(spark, sf_dir):
    """Predictions of the same model for every candidate."""
    scored = training.score_trees(tilt.candidates(_readings(spark, sf_dir)), training.starting_model())
    return _rounded(scored, "prediction").select(*schemas.KEYS, "tilt_deg", "prediction")


@_query
def compiled_scores_agreement(spark, sf_dir):
    """A fitted model's predictions for every candidate, against those of its compiled trees: rows, and rows that differ
    by more than the rounding of a sum."""
    model = _model(spark, sf_dir)
    known = tilt.candidates(_readings(spark, sf_dir)).dropna(subset=training.FEATURES)
    both = training.score_trees(training.score(known, model).withColumnRenamed("prediction", "walked"), model)
    far = F.abs(F.col("prediction") - F.col("walked")) > 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col("walked")))
    return both.agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(far).alias("n_different"))


@_query
def model_commands(spark, sf_dir):
    """Control commands for all valid requests that ask for one, chosen by the model."""
    chosen = training.answer(_requests(spark, sf_dir), _model(spark, sf_dir), feed.no_time())
    rows = tilt.commands(chosen, F.col("event_id").cast("string"))
    return rows.select(
        "message_id", "panel_id", "command_type", _on_grid("target_tilt"), "target_azimuth", "reason", "timestamp"
    )


@_query
def starting_commands(spark, sf_dir):
    """Control commands for all valid requests that ask for one, chosen by the starting model."""
    chosen = training.answer(_requests(spark, sf_dir), training.starting_model(), feed.no_time())
    return tilt.commands(chosen, F.col("event_id").cast("string"))


@_query
def model_responses(spark, sf_dir):
    """Answers to all valid requests, chosen by the model."""
    chosen = training.answer(_requests(spark, sf_dir), _model(spark, sf_dir), feed.no_time())
    rows = tilt.prediction_response(chosen)
    has_power = F.col("predicted_power").isNotNull().alias("has_power")
    return rows.select("panel_id", _on_grid("optimal_tilt"), has_power, "timestamp", "kafka_sent")


@_query
def starting_responses(spark, sf_dir):
    """Answers to all valid requests, chosen by the starting model."""
    chosen = training.answer(_requests(spark, sf_dir), training.starting_model(), feed.no_time())
    return _rounded(tilt.prediction_response(chosen), "predicted_power")


@_query
def optimal_tilt_agreement(spark, sf_dir):
    """In-row choice against the best of written-out, scored candidates: readings, and readings that differ."""
    requests = _requests(spark, sf_dir).where("irradiance_w_m2 IS NOT NULL AND temperature_c IS NOT NULL")
    requests = tilt.with_defaults(requests, feed.no_time())
    model = _model(spark, sf_dir)
    chosen = training.optimal_tilt(requests, model)
    listed = tilt.best_candidates(training.score(tilt.candidates(requests), model), ["event_id"])
    far = F.abs(F.col("predicted_power") - F.col("prediction")) > 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col("prediction")))
    both = chosen.join(listed.select("event_id", "tilt_deg", "prediction"), "event_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_readings"), F.count_if((F.col("optimal_tilt") != F.col("tilt_deg")) | far).alias("n_different")
    )


@_query
def candidate_scores(spark, sf_dir):
    """Every candidate of every reading with its prediction."""
    rows = tilt.candidates(_readings(spark, sf_dir))
    scored = training.score(rows, _model(spark, sf_dir))
    return scored.select("panel_id", "timestamp", "tilt_deg", "prediction")


@_query
def retrain_status(spark, sf_dir):
    """Refit on all usable training records."""
    rows = training.training_records(feed.training_messages(feed.events(spark, sf_dir)), feed.no_time())
    return training.retrain(rows, **training.QUICK)[1]


def _known_model(spark, sf_dir):
    """A model whose predictions SQL can state: the label of its training records steps with the tilt and the hour
    alone, in whole watts, and one tree of five levels takes the steps exactly."""
    records = tilt.candidates(_readings(spark, sf_dir)).drop("power_dc_w")
    by_tilt = F.when(F.col("tilt_deg") < 22, 10).when(F.col("tilt_deg") < 42, 30).otherwise(20)
    label = by_tilt + F.when(F.hour("timestamp") < 12, 0).otherwise(F.when(F.col("tilt_deg") < 8, 40).otherwise(4))
    return training.fit(records.withColumn("power_dc_w", label.cast("double")), maxIter=1, maxDepth=5)


def _saved_and_loaded(spark, model):
    return training.load(training.save(model, session.run_dir(spark, "models"), 1))


@_query
def optimal_tilt_known(spark, sf_dir):
    """Best tilt for every reading by a model of known steps, saved and read back."""
    model = _saved_and_loaded(spark, _known_model(spark, sf_dir))
    chosen = training.optimal_tilt(_readings(spark, sf_dir), model)
    return _rounded(chosen, "predicted_power").select(*schemas.KEYS, "optimal_tilt", "predicted_power")


@_query
def candidate_scores_known(spark, sf_dir):
    """Predictions of the same model for every candidate."""
    scored = training.score(tilt.candidates(_readings(spark, sf_dir)), _known_model(spark, sf_dir))
    return _rounded(scored, "prediction").select(*schemas.KEYS, "tilt_deg", "prediction")


# --- streams, run to the end of the table


def _drained(writer, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream over everything there is and read the table it wrote."""
    base = session.run_dir(spark, name)
    query = writer.option("checkpointLocation", f"{base}/checkpoint").outputMode("append").format("parquet")
    with session.state_settings(spark):
        running = query.trigger(availableNow=True).start(f"{base}/out")
    running.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _enriched_stream(spark, sf_dir, once_each: bool = False) -> DataFrame:
    frames = feed.measurements(feed.events_stream(spark, sf_dir))
    return telemetry.enrich({kind: telemetry.watermarked(frame) for kind, frame in frames.items()}, once_each)


@_query
def stream_enriched_features(spark, sf_dir):
    # Joined readings are given out at once, so nothing comes of clearing the state when the stream has ended.
    with session.no_idle_batches(spark):
        return _drained(_enriched_stream(spark, sf_dir).writeStream, spark, "stream_enriched_features")


@_query
def stream_window_stats(spark, sf_dir):
    """Windows closed by the watermark."""
    rows = stats.window_stats(_enriched_stream(spark, sf_dir))
    return _averages(_drained(rows.writeStream, spark, "stream_window_stats"))


@_query
def stream_window_stats_by_grouping(spark, sf_dir):
    """The same windows with the five streams matched by grouping."""
    rows = stats.window_stats(_enriched_stream(spark, sf_dir, once_each=True))
    return _averages(_drained(rows.writeStream, spark, "stream_window_stats_by_grouping"))


@_query
def stream_window_stats_resent(spark, sf_dir):
    """Windows of a stream with resent messages, whose copies are counted in keyed state."""
    frames = feed.resent(feed.events_stream(spark, sf_dir))
    counted = telemetry.match_counted({kind: telemetry.watermarked(frame) for kind, frame in frames.items()})
    rows = stats.window_stats(counted, copies=telemetry.COPIES)
    return _averages(_drained(rows.writeStream, spark, "stream_window_stats_resent"))


def _closed_windows(spark, sf_dir, name) -> tuple[str, brokers.Folder]:
    """Window statistics messages made by a stream, in a folder."""
    base = session.run_dir(spark, name)
    folder = brokers.Folder(f"{base}/topics")
    enriched = _enriched_stream(spark, sf_dir, once_each=True)
    text = stats.to_messages(stats.window_stats(enriched))
    topic = schemas.TOPICS["window_stats"]
    with session.state_partitions(spark, _state_partitions(spark, sf_dir, grouping=True)):
        started = jobs.send(text, folder, topic, f"{base}/checkpoints/windows", availableNow=True)
    started.awaitTermination()
    return base, folder


def _window_drops(spark, made: brokers.Folder) -> list[DataFrame]:
    """Closed windows in three drops: every seventh one of the first comes late, and some are sent again."""
    windows = stats.from_messages(made.history(spark, schemas.TOPICS["window_stats"]))
    windows = session.materialise(windows, "windows")
    start = F.col("window_start")
    first, second = (F.lit(t).cast("timestamp") for t in WINDOW_DROPS)
    minute = F.floor(F.unix_seconds(start) / 60)
    held = (start < first) & (minute % 7 == 0)
    again = minute % 5 == 0
    return [
        windows.where((start < first) & ~held),
        windows.where(((start >= first) & (start < second)) | held | (again & (start < first))),
        windows.where((start >= second) | (again & (start < second))),
    ]


@_query
def stream_panel_changes(spark, sf_dir):
    """Keyed state over the closed windows, which come in several drops, some late and some twice."""
    base, made = _closed_windows(spark, sf_dir, "stream_panel_changes")
    folder, path = brokers.Folder(f"{base}/drops"), f"{base}/changes"
    for drop in _window_drops(spark, made):
        folder.write(stats.to_messages(drop), schemas.TOPICS["window_stats"])
        jobs.start_panel_changes(spark, folder, path, f"{base}/checkpoints", availableNow=True).awaitTermination()
    return _averages(spark.read.parquet(path))


# How late windows may come that are still put in their place.
LATENESS = "1 day"


def _late_drops(spark, made: brokers.Folder) -> list[DataFrame]:
    """Closed windows in three drops. Every third one of a drop's last hours comes with the next drop, and many are sent
    again, some of them long after they were judged."""
    windows = stats.from_messages(made.history(spark, schemas.TOPICS["window_stats"]))
    windows = session.materialise(windows, "windows")
    start, minute = F.col("window_start"), F.floor(F.unix_seconds("window_start") / 60)
    cuts = [F.lit(t).cast("timestamp") for t in WINDOW_DROPS]
    drop = F.when(start < cuts[0], 0).when(start < cuts[1], 1).otherwise(2)
    held = F.lit(False)
    for cut in cuts:
        held = held | ((start < cut) & (start >= cut - F.expr("INTERVAL 20 HOURS")) & (minute % 3 == 0))
    placed = windows.withColumn("drop", drop + F.when(held, 1).otherwise(0))
    again = placed.where(minute % 5 == 0).withColumn("drop", F.col("drop") + 1)
    sent = placed.unionAll(again)
    return [sent.where(F.col("drop") == n).drop("drop") for n in range(3)]


@_query
def stream_panel_changes_in_order(spark, sf_dir):
    """Keyed state that keeps windows until no earlier one can come: late ones are put in order, copies count once."""
    base, made = _closed_windows(spark, sf_dir, "stream_panel_changes_in_order")
    folder, path = brokers.Folder(f"{base}/drops"), f"{base}/changes"
    for drop in _late_drops(spark, made):
        folder.write(stats.to_messages(drop), schemas.TOPICS["window_stats"])
        run = jobs.start_panel_changes(spark, folder, path, f"{base}/checkpoints", lateness=LATENESS, availableNow=True)
        run.awaitTermination()
    return _averages(spark.read.parquet(path))


@_query
def stream_panel_status(spark, sf_dir):
    """Versioned status table kept by a stream over the same drops."""
    base, made = _closed_windows(spark, sf_dir, "stream_panel_status")
    folder, path = brokers.Folder(f"{base}/drops"), f"{base}/status"
    for drop in _window_drops(spark, made):
        folder.write(stats.to_messages(drop), schemas.TOPICS["window_stats"])
        jobs.start_panel_status(spark, folder, path, f"{base}/checkpoints", availableNow=True).awaitTermination()
    return _averages(tables.read_status(spark, path))


@_query
def stream_status_log(spark, sf_dir):
    """Status kept as a base and changes over the same drops, each in two micro-batches with a restart in between, and
    three new bases on the way."""
    base, made = _closed_windows(spark, sf_dir, "stream_status_log")
    folder, path = brokers.Folder(f"{base}/drops"), f"{base}/status"
    for drop, cut in zip(_window_drops(spark, made), ("2024-01-05 00:00:00", *WINDOW_DROPS), strict=True):
        older = F.col("window_start") < F.lit(cut).cast("timestamp")
        for part in (drop.where(older), drop.where(~older)):
            folder.write(stats.to_messages(part), schemas.TOPICS["window_stats"])
            started = jobs.start_status_log(
                spark, folder, path, f"{base}/checkpoints", buckets=8, compact_every=2, availableNow=True
            )
            started.awaitTermination()
    return _averages(status_log.read_status(spark, path))


@_query
def stream_faults(spark, sf_dir):
    """Fault alerts written by a stream that arrives in several micro-batches, which split hours."""
    base = session.run_dir(spark, "stream_faults")
    folder = brokers.Folder(f"{base}/topics")
    rows = feed.readings(feed.events_by_drops(spark, sf_dir, f"{base}/events")).select(*schemas.KEYS, "power_dc_w")
    jobs.start_fault_alerts(rows, folder, f"{base}/checkpoints", bucket=HOUR, availableNow=True).awaitTermination()
    alerts = folder.history(spark, schemas.TOPICS["faults"])
    details = "details STRUCT<current_power: DOUBLE, average_others: DOUBLE, deviation: DOUBLE>"
    parsed = alerts.select("key", F.from_json("value", f"panel_id STRING, timestamp STRING, {details}").alias("a"))
    return _rounded(parsed.select("key", "a.panel_id", "a.timestamp", "a.details.*"), "average_others", "deviation")


# How the message files of large topics are compressed.
PACKED = "gzip"


def _in_two_drops(spark, sf_dir, name, run, compression: str | None = None) -> brokers.Folder:
    """The topics of all readings, written in two drops, of which the second has some of the oldest messages again,
    too late by then. `run` is called after each drop, so a job starts, ends and starts again from its checkpoint."""
    base = session.run_dir(spark, name)
    topics = brokers.Folder(f"{base}/topics", compression=compression)
    oldest, old, new, newest = feed.in_drops(feed.events(spark, sf_dir), 4)
    topics.write(feed.messages(oldest.unionAll(old)))
    run(topics, base)
    topics.write(feed.messages(new.unionAll(newest).unionAll(oldest.where("event_id % 10 = 0"))))
    run(topics, base)
    return topics


@_query
def stream_job_enriched(spark, sf_dir):
    """The job of enriched readings over message topics."""
    runs = iter((nullcontext(), session.no_idle_batches(spark)))  # nothing comes after the second

    def run(topics, base):
        with next(runs):
            jobs.start_enriched(spark, topics, topics, f"{base}/checkpoints", availableNow=True).awaitTermination()

    topics = _in_two_drops(spark, sf_dir, "stream_job_enriched", run, PACKED)
    columns = "panel_id STRING, timestamp TIMESTAMP, power_ac_w DOUBLE, efficiency DOUBLE, temp_per_power DOUBLE"
    return wire.decode(topics.history(spark, schemas.TOPICS["enriched"]), columns)


@_query
def stream_job_window_stats(spark, sf_dir):
    """The job of window statistics over message topics, matched by grouping."""

    def run(topics, base):
        started = jobs.start_window_stats(spark, topics, topics, f"{base}/checkpoints", once_each=True, availableNow=True)
        started.awaitTermination()

    topics = _in_two_drops(spark, sf_dir, "stream_job_window_stats", run)
    return _averages(stats.from_messages(topics.history(spark, schemas.TOPICS["window_stats"])))


@_query
def stream_job_stats_from_enriched(spark, sf_dir):
    """The same from the topic that the job of enriched readings writes."""

    def run(topics, base):
        checkpoints, once = f"{base}/checkpoints", {"availableNow": True}
        with session.state_partitions(spark, _state_partitions(spark, sf_dir, grouping=True)):
            started = jobs.start_enriched(spark, topics, topics, checkpoints, once_each=True, **once)
        started.awaitTermination()
        jobs.start_window_stats(spark, topics, topics, checkpoints, from_enriched=True, **once).awaitTermination()

    topics = _in_two_drops(spark, sf_dir, "stream_job_stats_from_enriched", run)
    return _averages(stats.from_messages(topics.history(spark, schemas.TOPICS["window_stats"])))


@_query
def stream_job_rejects(spark, sf_dir):
    """The job that keeps unreadable messages."""
    base = session.run_dir(spark, "stream_job_rejects")
    topics = brokers.Folder(f"{base}/topics")
    for drop in feed.in_drops(feed.events(spark, sf_dir), 2):
        topics.write(feed.raw_messages(drop), schemas.TOPICS["temperature"])
        run = jobs.start_rejects(spark, topics, "temperature", topics, "rejects", f"{base}/checkpoints", availableNow=True)
        run.awaitTermination()
    return topics.history(spark, "rejects").select("key", F.length("value").alias("n_chars"))


@_query
def stream_control_commands(spark, sf_dir):
    """Commands written by a stream that scores every reading with the model."""
    base = session.run_dir(spark, "stream_control_commands")
    folder = brokers.Folder(f"{base}/topics")
    model = _model(spark, sf_dir)
    rows = feed.readings(feed.events_stream(spark, sf_dir))
    jobs.start_tilt_control(rows, lambda: model, folder, f"{base}/checkpoints", availableNow=True).awaitTermination()
    commands = folder.history(spark, schemas.TOPICS["control"])
    schema = "panel_id STRING, command_type STRING, target_tilt DOUBLE, target_azimuth DOUBLE, timestamp STRING"
    rows = commands.select("key", F.from_json("value", schema).alias("c")).select("key", "c.*")
    return rows.select("key", "panel_id", "command_type", _on_grid("target_tilt"), "target_azimuth", "timestamp")


@_query
def stream_starting_commands(spark, sf_dir):
    """Commands written by a stream that scores every reading with the starting model."""
    base = session.run_dir(spark, "stream_starting_commands")
    folder = brokers.Folder(f"{base}/topics")
    model = training.starting_model()
    rows = feed.readings(feed.events_stream(spark, sf_dir))
    jobs.start_tilt_control(rows, lambda: model, folder, f"{base}/checkpoints", availableNow=True).awaitTermination()
    commands = folder.history(spark, schemas.TOPICS["control"])
    schema = "panel_id STRING, command_type STRING, target_tilt DOUBLE, target_azimuth DOUBLE, timestamp STRING"
    rows = commands.select("key", F.from_json("value", schema).alias("c")).select("key", "c.*")
    return rows.select("key", "panel_id", "command_type", "target_tilt", "target_azimuth", "timestamp")


def _peaked() -> Column:
    """Power with one best tilt, 35 degrees in the morning and 15 later, and far less for every other."""
    angle = F.col("tilt_deg")
    morning = F.when(angle < 35, 25).when(angle == 35, 125).otherwise(50)
    later = F.when(angle < 15, 50).when(angle == 15, 150).otherwise(75)
    return F.when(F.hour("timestamp") < 12, morning).otherwise(later)


def _refit(spark, sf_dir, base) -> str:
    """Training messages written to a topic, read back as its history, and the default refit on them published."""
    topics, models = brokers.Folder(f"{base}/topics", compression=PACKED), f"{base}/models"
    topics.write(feed.labelled_messages(feed.events(spark, sf_dir), _peaked()), schemas.TOPICS["sensors"])
    model, status = training.retrain(jobs.training_history(spark, topics))
    if status.first()["status"] == "retrained":
        registry.publish(spark, model, models)
    return models


@_query
def refit_predictions(spark, sf_dir):
    """What the default refit, of fifty rounds, predicts for every candidate: to steps of 25 W, per half day and tilt. No
    single tree of its depth has all the steps of the label."""
    _, model = registry.current(spark, _refit(spark, sf_dir, session.run_dir(spark, "refit_predictions")))
    scored = training.score_trees(tilt.candidates(_readings(spark, sf_dir)), model)
    rounded = (F.round(F.col("prediction") / 25) * 25).cast("bigint")
    return scored.groupBy((F.hour("timestamp") < 12).alias("morning"), "tilt_deg").agg(
        F.count(F.lit(1)).alias("n"), F.min(rounded).alias("lowest"), F.max(rounded).alias("highest")
    )


@_query
def stream_refit_control(spark, sf_dir):
    """Commands for the first half of the readings by the starting model and, after a refit on the history of the
    training topic is published, for the second half by the refitted one, which the job follows."""
    base = session.run_dir(spark, "stream_refit_control")
    folder = brokers.Folder(f"{base}/topics", compression=PACKED)
    model = registry.follow(spark, f"{base}/models")
    for place, drop in enumerate(feed.in_drops(feed.events(spark, sf_dir), 2)):
        if place == 1:
            _refit(spark, sf_dir, base)
        drop.write.mode("append").parquet(f"{base}/events")
        rows = feed.readings(spark.readStream.schema(feed.EVENTS).parquet(f"{base}/events"))
        jobs.start_tilt_control(rows, model, folder, f"{base}/checkpoints", availableNow=True).awaitTermination()
    return wire.decode(
        folder.history(spark, schemas.TOPICS["control"]), "panel_id STRING, timestamp STRING, target_tilt DOUBLE"
    )


@_query
def stream_fanout(spark, sf_dir):
    """Readings sent as five topics by a stream, then parsed, joined and averaged per day from those topics."""
    base = session.run_dir(spark, "stream_fanout")
    folder = brokers.Folder(f"{base}/topics")
    # Dealt over the cluster first, as five messages are made of each and a file may be read by few tasks.
    rows = feed.readings(feed.events_stream(spark, sf_dir)).repartition(4 * spark.sparkContext.defaultParallelism)
    jobs.start_fan_out(rows, folder, f"{base}/checkpoints", availableNow=True).awaitTermination()
    frames = {
        kind: wire.decode(folder.history(spark, schemas.TOPICS[kind]), schemas.measurement_schema(kind))
        for kind in schemas.KINDS
    }
    return _averages(stats.window_stats(telemetry.enrich_table(frames), DAY))
