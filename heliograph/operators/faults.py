"""Peer-deviation fault detection: a panel far from the mean of the panels reporting with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import scalars
from heliograph.operators import skew

# Threshold in watts and alert texts.
THRESHOLD_W = 50.0
EVENT_TYPE = "FAULT_DETECTED"
ACTION = "Inspect Panel Immediately"


def _with_peer_time(readings: DataFrame, bucket: str | None) -> DataFrame:
    time = F.window(schemas.EVENT_TIME, bucket)["start"] if bucket else F.col(schemas.EVENT_TIME)
    return readings.withColumn("peer_time", time)


def _peer_groups(rows: DataFrame, key: str = "peer_time") -> DataFrame:
    power = F.col("power_dc_w")
    return rows.groupBy(key).agg(
        F.sum(power).alias("_sum"),
        F.count(power).alias("_known"),
        F.count(F.lit(1)).alias("_rows"),
        F.max(power).alias("_high"),
        F.min(power).alias("_low"),
    )


def _deviating(peers: DataFrame, leave_one_out: bool) -> DataFrame:
    """Rows next to their group's sums, with the mean of the peers and the deviation from it."""
    power = F.col("power_dc_w")
    if leave_one_out:
        mean = F.try_divide(F.col("_sum") - power, F.col("_known") - 1)
    else:
        mean = F.try_divide(F.col("_sum"), F.col("_known"))
    return (
        peers.withColumn("avg_power", mean)
        .withColumn("deviation", F.abs(power - F.col("avg_power")))
        .drop("_sum", "_known", "_rows")
    )


def _compared(rows: DataFrame, groups: DataFrame, leave_one_out: bool) -> DataFrame:
    peers = skew.attach_group_values(rows, groups.drop("_high", "_low"), ["peer_time"], "_rows")
    return _deviating(peers, leave_one_out)


def _suspect(groups: DataFrame, leave_one_out: bool, threshold: float) -> DataFrame:
    """Groups whose extremes reach the threshold, less a margin for rounding."""
    mean = F.try_divide(F.col("_sum"), F.col("_known"))
    widest = F.greatest(F.col("_high") - mean, mean - F.col("_low"))
    if leave_one_out:
        widest = widest * F.try_divide(F.col("_known"), F.col("_known") - 1)
    margin = 1e-6 * (abs(threshold) + F.abs("_high") + F.abs("_low"))
    return groups.where(widest + margin > threshold)


def compare_with_peers(readings: DataFrame, bucket: str | None = None, leave_one_out: bool = False) -> DataFrame:
    """Add `avg_power` of the peers and the absolute `deviation` of `power_dc_w` from it.

    Peers report at the very same time, or in the same time `bucket` such as "1 hour", to which readings without a time
    do not belong. The mean includes the panel itself unless `leave_one_out`. The means are computed when this is called
    (see `skew.attach_group_values`).
    """
    rows = _with_peer_time(readings, bucket)
    return _compared(rows, _peer_groups(rows), leave_one_out)


def detect_faults(
    readings: DataFrame,
    bucket: str | None = None,
    leave_one_out: bool = False,
    threshold: float = THRESHOLD_W,
) -> DataFrame:
    """Readings that deviate from their peers by more than `threshold` watts.

    The largest deviation of a group follows from its highest and lowest power. Only groups where that reaches the
    threshold (less a margin for rounding) are looked at reading by reading.
    """
    rows = _with_peer_time(readings, bucket)
    groups = _suspect(_peer_groups(rows), leave_one_out, threshold)
    return _compared(rows, groups, leave_one_out).where(F.col("deviation") > threshold)


def detect_faults_stream(
    readings: DataFrame,
    bucket: str,
    leave_one_out: bool = False,
    threshold: float = THRESHOLD_W,
    delay: str = schemas.WATERMARK,
    spread: int = 32,
) -> DataFrame:
    """`detect_faults` over a stream, whole per `bucket`: a bucket is judged once, when the watermark has passed it.

    The sums of a bucket are partial on the map side. Its readings wait in the state of a join with them, spread over
    `spread` keys by panel, so a bucket of very many readings does not lie in one task. Readings that come after their
    bucket was closed are dropped. Rows do not depend on how the stream is cut into micro-batches.
    """
    rows = readings.withWatermark(schemas.EVENT_TIME, delay).withColumn("_bucket", F.window(schemas.EVENT_TIME, bucket))
    # The bucket is the event time from here on; a join may know only one.
    rows = rows.withColumn(schemas.EVENT_TIME, F.timestamp_micros(F.unix_micros(schemas.EVENT_TIME)))
    groups = _suspect(_peer_groups(rows, "_bucket"), leave_one_out, threshold).drop("_high", "_low")
    parts = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_part")
    copies = groups.select("_bucket", "_sum", "_known", "_rows", parts)
    parted = rows.withColumn("_part", F.pmod(F.xxhash64("panel_id"), F.lit(spread)).cast("int"))
    joined = parted.join(copies, ["_bucket", "_part"]).withColumn("peer_time", F.col("_bucket.start"))
    return _deviating(joined.drop("_bucket", "_part"), leave_one_out).where(F.col("deviation") > threshold)


def fault_summary(faults: DataFrame) -> DataFrame:
    """Number of faults, as a one-row frame."""
    return faults.agg(F.count(F.lit(1)).alias("fault_count"))


def counted(faults: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; `observation` reports their number once they have been written, without a second pass."""
    return faults.observe(observation, F.count(F.lit(1)).alias("fault_count"))


def preview(faults: DataFrame) -> DataFrame:
    """The columns a person looks at."""
    return faults.select("panel_id", "power_dc_w", "avg_power", "deviation")


def alert(threshold: float = THRESHOLD_W) -> Column:
    """Alert payload of one faulty reading, with nested details."""
    return F.struct(
        F.lit(EVENT_TYPE).alias("event_type"),
        F.col("panel_id"),
        scalars.iso_text(F.col(schemas.EVENT_TIME)).alias("timestamp"),
        F.struct(
            F.col("power_dc_w").alias("current_power"),
            F.col("avg_power").alias("average_others"),
            F.col("deviation"),
            F.lit(float(threshold)).alias("threshold"),
        ).alias("details"),
        F.lit(ACTION).alias("action_required"),
    )


def alerts(faults: DataFrame, threshold: float = THRESHOLD_W) -> DataFrame:
    """Alerts as keyed JSON messages."""
    return faults.select(F.col("panel_id").alias("key"), F.to_json(alert(threshold)).alias("value"))
