"""Panel status as a base and changes: a micro-batch writes the panels that it touches, not the whole table.

Below one folder lie `changes/batch=n/bucket=b`, the status of the panels that micro-batch n touched, and
`base=n/bucket=b`, the status of all panels after micro-batch n. A status is read by merging: of a panel's rows in the
newest base and in the changes after it, the one of the latest micro-batch holds. Buckets are hashes of the panel, so a
micro-batch reads the buckets of its own panels only.

A folder counts once Spark has put `_SUCCESS` into it, last of all. So a new base takes over in one step, and a base or
a change that was cut off is not there at all and is written anew when its micro-batch is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import schemas, session
from heliograph.operators import health
from heliograph.sources import tables

BUCKETS = 64
COMPACT_EVERY = 10

BATCH, BUCKET = "batch", "bucket"

STORED = f"{tables.STORED}, {BUCKET} INT"


def bucket(panel: Column, buckets: int) -> Column:
    """Bucket of a panel. The number of buckets is fixed by the first write to a folder."""
    return F.pmod(F.xxhash64(panel), F.lit(buckets)).cast("int")


def _complete(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the folders `prefix=number` that were written to the end, in order."""
    located, files = session.file_system(spark, folder)
    if not files.exists(located):
        return []
    found = [e.getPath() for e in files.listStatus(located) if e.getPath().getName().startswith(f"{prefix}=")]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def bases(spark: SparkSession, root: str) -> list[int]:
    """Micro-batches after which a base was written."""
    return _complete(spark, root, "base")


def changes(spark: SparkSession, root: str) -> list[int]:
    """Micro-batches whose changes are there."""
    return _complete(spark, f"{root}/changes", BATCH)


def read(spark: SparkSession, root: str, before: int | None = None, only: list[int] | None = None) -> DataFrame:
    """Status of every panel, with the start of its last window, after all micro-batches, or after those `before` one.

    `only` names buckets; no others are read. What is merged is the newest base and the changes since, at most as many
    as there are micro-batches between two bases.
    """
    wanted = [n for n in bases(spark, root) if before is None or n < before]
    since = [n for n in changes(spark, root) if (before is None or n < before) and (not wanted or n > wanted[-1])]
    parts = []
    if wanted:
        whole = spark.read.schema(STORED).parquet(f"{root}/base={wanted[-1]}")
        parts.append(whole.withColumn(BATCH, F.lit(wanted[-1]).cast("bigint")))
    if since:
        reader = spark.read.schema(f"{STORED}, {BATCH} BIGINT").option("basePath", f"{root}/changes")
        parts.append(reader.parquet(*[f"{root}/changes/{BATCH}={n}" for n in since]))
    if not parts:
        return tables.empty_status(spark)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if only is not None:
        rows = rows.where(F.col(BUCKET).isin(only) if only else F.lit(False))
    names = [*schemas.STATUS_COLUMNS, health.LAST_WINDOW]
    if not since:
        return rows.select(*names)
    newest = rows.groupBy(schemas.PANEL).agg(F.max_by(F.struct(*names[1:]), BATCH).alias("row"))
    return newest.select(schemas.PANEL, "row.*")


def _write(status: DataFrame, path: str, buckets: int) -> None:
    stored = status.select(*schemas.STATUS_COLUMNS, health.LAST_WINDOW, bucket(F.col(schemas.PANEL), buckets).alias(BUCKET))
    stored.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def advance(
    windows: DataFrame, root: str, batch_id: int, buckets: int = BUCKETS, clock: Column | None = None
) -> None:
    """Write what micro-batch `batch_id` changes: the status of the panels with windows in it.

    It reads only what earlier micro-batches wrote, so a repeated one gives the same rows and replaces its own. The
    rules are those of `health.advance_status`.
    """
    spark = windows.sparkSession
    with session.scratch(spark):
        own = bucket(F.col(schemas.PANEL), buckets)
        named = windows.where(F.col(schemas.PANEL).isNotNull() & (F.col(schemas.PANEL) != ""))
        seen = session.materialise(named.dropDuplicates(), "windows")
        touched = [row[0] for row in seen.select(own).distinct().collect()]  # at most as many as there are buckets
        known = read(spark, root, batch_id, touched)
        current = known.join(seen.select(schemas.PANEL).distinct(), schemas.PANEL, "left_semi")
        _write(health.advance_status(current, seen, clock), f"{root}/changes/{BATCH}={batch_id}", buckets)


def compact(spark: SparkSession, root: str, batch_id: int, buckets: int = BUCKETS, keep: int = 2) -> None:
    """Write the base after micro-batch `batch_id`, and remove what no reader needs.

    The newest `keep` bases before this one stay, with the changes after them: a reader that has just listed the folder
    finds its files, and a repeated micro-batch finds the state it began from.
    """
    if batch_id not in bases(spark, root):
        _write(read(spark, root, batch_id + 1), f"{root}/base={batch_id}", buckets)
    earlier = [n for n in bases(spark, root) if n < batch_id]
    if len(earlier) < keep:
        return
    oldest = earlier[-keep]
    for number in earlier:
        if number < oldest:
            session.remove(spark, f"{root}/base={number}")
    for number in changes(spark, root):
        if number <= oldest:
            session.remove(spark, f"{root}/changes/{BATCH}={number}")


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """The newest status, or an empty table, as its readers know it."""
    return read(spark, root).select(*schemas.STATUS_COLUMNS)
