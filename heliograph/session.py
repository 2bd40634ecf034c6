"""Session settings the transforms rely on, and the shared folder for checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Applied to any session handed to us.
# - Event times are instants, and hour-of-day and day windows are read in UTC.
# - A join whose shuffled partitions all turn out to fit is done by hashing them, without sorting; others are sorted.
# - A join side with one oversized partition is split, even where that costs another shuffle.
# - Rows that go to a few folders (topics, buckets) are written as they come, without sorting them by folder first.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 << 20),
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# State of streaming queries: kept outside the heap, one store per join side instead of two, and only what changed is
# uploaded after a micro-batch. All stores of an executor share one bound of memory, however many partitions it holds.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1500",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

DEFAULT_SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "heliograph", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; `settings` (name to value) win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by `spark.checkpoint.dir`.

    A local session without the setting gets a folder of its own. A cluster session without it is an error, because a
    folder on one machine is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="heliograph-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


# Tables made by `materialise` inside the innermost `scratch` block.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Run `df` now, into a table in the shared folder, and read that table.

    For results used more than once. The table outlives lost executors, and its size is known to the planner. It stays
    until removed; inside a `scratch` block that happens at the end of the block.
    """
    path = run_dir(df.sparkSession, name)
    made = _scratch.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were materialised inside the block, once their readers in the block are done."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            remove(spark, path)


def file_system(spark: SparkSession, path: str):
    """Hadoop path object and the file system it lies on."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder made by this library."""
    located, files = file_system(spark, path)
    files.delete(located, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Point `DataFrame.checkpoint()` and long model fits at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/rdd")


@contextmanager
def _set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def state_settings(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings for a streaming query started inside the block; the session gets its own back afterwards."""
    return _set(spark, STATE_SETTINGS)


def state_partitions(spark: SparkSession, number: int) -> AbstractContextManager[None]:
    """Streaming queries first started inside the block get this many state partitions.

    The number is fixed by the first start of a checkpoint. Outside such a block it is `spark.sql.shuffle.partitions`.
    """
    return _set(spark, {"spark.sql.shuffle.partitions": str(number)})


def uncounted_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Streaming queries started inside the block do not report their number of state rows (`numRowsTotal`), for which
    every key would be read before it is written."""
    return _set(spark, {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"})


def no_idle_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Streaming queries started inside the block make no micro-batch without rows. Such a one only clears the state of a
    query that holds nothing back, and a stream that ends has no use for that. One that is to go on from its checkpoint
    does: by it, the next micro-batch knows what comes too late."""
    return _set(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"})


def small_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Tasks of streaming queries started inside the block read 16 MB of files at most, or less where the session says
    so: what a task gathers before a shuffle goes with what it reads."""
    name = "spark.sql.files.maxPartitionBytes"
    known = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    return _set(spark, {name: f"{min(known, 16 << 20)}b"})
