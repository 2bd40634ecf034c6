"""Questions about the panel status table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph import schemas
from heliograph.functions.scalars import fixed_text

# Texts of the report.
MISSING = "N/A"
UNKNOWN_REASON = "Unknown issue"


def status_response(status: DataFrame) -> DataFrame:
    """The eight columns of a status answer."""
    return status.select(*schemas.STATUS_COLUMNS)


def list_panels(status: DataFrame, skip: int = 0, limit: int = 100) -> DataFrame:
    """One page of panels in panel id order, for the first pages. Further ones are cheaper by `list_panels_after`."""
    return status_response(status).orderBy("panel_id").offset(skip).limit(limit)


def list_panels_after(status: DataFrame, after: str | None, limit: int = 100) -> DataFrame:
    """The page that follows the panel `after`, the last one of the page before; the first page for None.

    A top-k of the panels behind it: no task holds the pages that were skipped.
    """
    rest = status_response(status)
    return (rest if after is None else rest.where(F.col("panel_id") > after)).orderBy("panel_id").limit(limit)


def get_panel(status: DataFrame, panel_id: str) -> DataFrame:
    """One panel; an empty frame when it is not known."""
    return status_response(status).where(F.col("panel_id") == panel_id)


def broken_panels(status: DataFrame) -> DataFrame:
    """All broken panels."""
    return status_response(status).where("is_broken")


def fleet_statistics(status: DataFrame) -> DataFrame:
    """Counts and unweighted means over all panels in one pass; one row."""
    return status.agg(
        F.count(F.lit(1)).alias("total_panels"),
        F.count_if("is_broken").alias("broken_panels"),
        F.count_if(~F.coalesce("is_broken", F.lit(False))).alias("working_panels"),
        F.avg("avg_efficiency").alias("average_efficiency"),
        F.avg("avg_temperature").alias("average_temperature"),
    )


def _shown(name: str, places: int) -> Column:
    return F.coalesce(fixed_text(F.col(name), places, ties="up"), F.lit(MISSING))


def panel_report(status: DataFrame) -> DataFrame:
    """Status texts of all panels: rounded measures, label, and the reason where there is one."""
    return status.select(
        "panel_id",
        F.when(F.col("is_broken"), "Broken").otherwise("Working").alias("status"),
        _shown("avg_efficiency", 2).alias("efficiency"),
        _shown("avg_temperature", 1).alias("temperature"),
        _shown("avg_irradiance", 0).alias("irradiance"),
        F.when(F.col("is_broken"), F.col("reason")).alias("reason"),
    )


def broken_report(status: DataFrame) -> DataFrame:
    """Texts of the broken panels, with a stand-in for a missing reason."""
    return status.where("is_broken").select(
        "panel_id",
        "broken_since",
        F.coalesce("reason", F.lit(UNKNOWN_REASON)).alias("reason"),
        _shown("avg_efficiency", 2).alias("efficiency"),
        _shown("avg_temperature", 1).alias("temperature"),
    )


def fleet_report(status: DataFrame) -> DataFrame:
    """Texts of the fleet statistics."""
    return fleet_statistics(status).select(
        "total_panels",
        "broken_panels",
        "working_panels",
        _shown("average_efficiency", 2).alias("efficiency"),
        _shown("average_temperature", 1).alias("temperature"),
    )
