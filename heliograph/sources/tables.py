"""Panel status as a versioned table, and status read from elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliograph import schemas, session
from heliograph.operators import health

VERSION = "version"

STORED = f"{schemas.PANEL_STATUS}, {health.LAST_WINDOW} TIMESTAMP"


def empty_status(spark: SparkSession) -> DataFrame:
    """A status table without panels."""
    return spark.createDataFrame([], STORED)


def write_version(status: DataFrame, base: str, version: int) -> None:
    """Write one whole version of the status table. The version read before it is never touched."""
    stored = [*schemas.STATUS_COLUMNS, *(c for c in status.columns if c == health.LAST_WINDOW)]
    status.select(*stored).write.mode("overwrite").parquet(f"{base}/{VERSION}={version}")


def read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    """One version of the status table, with the start of each panel's last window as `last_window`."""
    return spark.read.schema(STORED).parquet(f"{base}/{VERSION}={version}")


def versions(spark: SparkSession, base: str) -> list[int]:
    """Versions that were written to the end, oldest first."""
    located, files = session.file_system(spark, base)
    if not files.exists(located):
        return []
    folders = [entry.getPath() for entry in files.listStatus(located) if entry.getPath().getName().startswith(VERSION)]
    done = [f for f in folders if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().partition("=")[2]) for f in done)


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Newest complete version."""
    found = versions(spark, base)
    return found[-1] if found else None


def forget_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Remove all but the newest `keep` complete versions."""
    for version in versions(spark, base)[:-keep]:
        session.remove(spark, f"{base}/{VERSION}={version}")


def read_status(spark: SparkSession, base: str) -> DataFrame:
    """The newest version, or an empty table, as its readers know it."""
    version = latest_version(spark, base)
    found = empty_status(spark) if version is None else read_version(spark, base, version)
    return found.select(*schemas.STATUS_COLUMNS)


def read_status_jdbc(spark: SparkSession, url: str, table: str = "panel_status", **options: str) -> DataFrame:
    """Status kept in a database; filters and columns are pushed to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*schemas.STATUS_COLUMNS)
