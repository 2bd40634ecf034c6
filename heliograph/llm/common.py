"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Python handles this many bytes of text at a time.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have; names differ by more than case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def told_apart(docs: DataFrame, name: str, from_files: bool) -> DataFrame:
    """`docs` with a column `name` that tells its rows apart and is the same at every reading.

    The rows of a table read `from_files` have it already: file and place in it. That does not change when executors
    are lost or files are cut otherwise. Any other table is written with numbered rows.
    """
    if from_files and "_metadata" not in docs.columns:
        try:
            return docs.withColumn(name, F.struct("_metadata.file_path", "_metadata.row_index"))
        except AnalysisException:  # not from files after all
            pass
    return session.materialise(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once per row however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def by_bytes(sizes: Sequence[int], most: int = BATCH_BYTES) -> Iterator[slice]:
    """Cut a list of texts, given by their bytes, into runs of at most `most` bytes; a longer text is a run of its own."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def slices(batch: pa.RecordBatch, column: str | int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most `most` bytes of text, so that only so much of it is made Python strings at a time.

    What Arrow no longer needs is given back after every batch, as Spark keeps its Python workers for the next stages.
    """
    sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_pylist()
    for part in by_bytes(sizes, most):
        yield batch.slice(part.start, part.stop - part.start)
    pa.default_memory_pool().release_unused()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings, NULL as the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]
