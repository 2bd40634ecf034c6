"""Choosing a tilt: requests, candidate tilts, the best of them, and control commands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import scalars, wire

# Candidate tilts, the azimuth they are tried at, request default, command texts.
LOWEST_TILT, HIGHEST_TILT, TILT_STEP = 0, 60, 5
TARGET_AZIMUTH = 180.0
DEFAULT_PANEL = "panel-1"
COMMAND_TYPE = "SET_ANGLE"
COMMAND_REASON = "Maximized power output"

TILTS = [float(t) for t in range(LOWEST_TILT, HIGHEST_TILT + 1, TILT_STEP)]


def with_defaults(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Requests with the default panel, time and send flag where these are missing."""
    time = F.current_timestamp() if now is None else now
    return requests.withColumns(
        {
            "panel_id": F.coalesce("panel_id", F.lit(DEFAULT_PANEL)),
            "timestamp": F.coalesce("timestamp", time),
            "send_to_kafka": F.coalesce("send_to_kafka", F.lit(False)),
        }
    )


def _lit() -> Column:
    """Irradiance above zero; NaN, which Spark orders above all numbers, is not."""
    return F.coalesce(F.nanvl(F.col("irradiance_w_m2"), F.lit(None)) > 0, F.lit(False))


def _answerable() -> Column:
    return _lit() & F.col("temperature_c").isNotNull()


def valid_requests(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Requests that can be answered: positive irradiance and a temperature."""
    return with_defaults(requests, now).where(_answerable())


def rejected_requests(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """The other requests, with the reason."""
    why = F.when(~_lit(), "irradiance_w_m2 must be greater than 0").otherwise("temperature_c is required")
    return with_defaults(requests, now).where(~_answerable()).withColumn("rejected_because", why)


def candidates(readings: DataFrame) -> DataFrame:
    """Every reading once per candidate tilt, at the target azimuth and with its hour of day."""
    tilts = F.sequence(F.lit(LOWEST_TILT), F.lit(HIGHEST_TILT), F.lit(TILT_STEP))
    return (
        readings.drop("tilt_deg", "azimuth_deg")
        .withColumn("hour", F.hour(schemas.EVENT_TIME))
        .withColumn("tilt_deg", F.explode(tilts.cast("array<double>")))
        .withColumn("azimuth_deg", F.lit(TARGET_AZIMUTH))
    )


def best_of(scores: list[tuple[float, Column]]) -> Column:
    """Struct `prediction`, `negative_tilt` of the best-scored tilt, the lowest one in a tie."""
    entries = [F.struct(score.alias("prediction"), F.lit(-tilt).alias("negative_tilt")) for tilt, score in scores]
    return F.array_max(F.array(*entries))


def best_tilt(readings: DataFrame, score: Callable[[float], Column]) -> DataFrame:
    """Add `optimal_tilt` and `predicted_power` by a score expression per tilt.

    The candidates of a reading are compared inside its row, so nothing is multiplied by 13 and nothing is shuffled.
    """
    return with_best(readings, [(tilt, score(tilt)) for tilt in TILTS])


def with_best(readings: DataFrame, scores: list[tuple[float, Column]], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the winner of `scores` as `optimal_tilt` and `predicted_power`; `drop` names helper columns."""
    chosen = readings.withColumn("_best", best_of(scores)).drop(*drop)
    return chosen.withColumns(
        {
            # 0.0 - x rather than -x, because the negation of 0.0 is -0.0
            "optimal_tilt": F.lit(0.0) - F.col("_best.negative_tilt"),
            "predicted_power": F.col("_best.prediction"),
        }
    ).drop("_best")


def best_candidates(scored: DataFrame, reading_key: list[str]) -> DataFrame:
    """Best row per reading out of scored `candidates` rows, the lowest tilt in a tie.

    For candidates that were written out; `reading_key` names a reading, whose group is its 13 candidates.
    """
    order = Window.partitionBy(*reading_key).orderBy(F.desc("prediction"), "tilt_deg")
    return scored.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def ranked_candidates(scored: DataFrame, limit: int) -> DataFrame:
    """The `limit` best-scored candidates of all, best first."""
    return scored.orderBy(F.desc("prediction"), "tilt_deg", *schemas.KEYS).limit(limit)


def prediction_response(chosen: DataFrame) -> DataFrame:
    """Answer to a prediction request."""
    return chosen.select(
        "panel_id",
        "optimal_tilt",
        "predicted_power",
        scalars.iso_text(F.col(schemas.EVENT_TIME)).alias("timestamp"),
        F.coalesce("send_to_kafka", F.lit(False)).alias("kafka_sent"),
    )


def commands(chosen: DataFrame, message_id: Column | None = None) -> DataFrame:
    """Control command rows for the readings that asked for one (all, without a `send_to_kafka` column).

    A reading that could not be scored has no tilt and gets no command. The id is that of `wire.message_id` unless
    `message_id` is given, so a repeated micro-batch sends its commands under the same ids.
    """
    asked = chosen.where("send_to_kafka") if "send_to_kafka" in chosen.columns else chosen
    return asked.where(F.col("optimal_tilt").isNotNull()).select(
        (wire.message_id(schemas.TOPICS["control"]) if message_id is None else message_id).alias("message_id"),
        "panel_id",
        F.lit(COMMAND_TYPE).alias("command_type"),
        F.col("optimal_tilt").alias("target_tilt"),
        F.lit(TARGET_AZIMUTH).alias("target_azimuth"),
        F.lit(COMMAND_REASON).alias("reason"),
        scalars.iso_text(F.col(schemas.EVENT_TIME)).alias("timestamp"),
    )
