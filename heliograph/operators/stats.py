"""Tumbling-window statistics per panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions import wire

# Result column -> measure it averages.
AVERAGES = {"avg_efficiency": "efficiency", "avg_temp": "temperature_c", "avg_irradiance": "irradiance_w_m2"}


def _average(measure: str, copies: str | None) -> Column:
    if copies is None:
        return F.avg(measure)
    weight = F.col(copies).cast("double")
    seen = F.sum(F.when(F.col(measure).isNotNull(), weight))
    return F.try_divide(F.sum(F.col(measure) * weight), seen)


def window_stats(enriched: DataFrame, width: str = schemas.WINDOW, copies: str | None = None) -> DataFrame:
    """Averages per window and panel; batch or streaming. NULLs are skipped, all-NULL gives NULL.

    Partial sums are made before the shuffle, so a panel with very many readings sends one row per task and window.
    `copies` names a weight column (see `telemetry.enrich_counted`).
    """
    averages = [_average(measure, copies).alias(name) for name, measure in AVERAGES.items()]
    return (
        enriched.groupBy(F.window(schemas.EVENT_TIME, width), F.col("panel_id"))
        .agg(*averages)
        .select(
            "panel_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *AVERAGES,
        )
    )


def to_messages(stats: DataFrame) -> DataFrame:
    """Window statistics as keyed JSON messages."""
    return wire.encode(stats, key="panel_id")


def from_messages(messages: DataFrame) -> DataFrame:
    """Window statistics parsed from JSON messages; a field left out is NULL."""
    return wire.decode(messages, schemas.WINDOW_STATS)


def distinct_windows(stats: DataFrame) -> DataFrame:
    """Resent window statistics once each (batch). Copies are dropped before the shuffle where a task has several."""
    return stats.dropDuplicates()
