"""Token counts: Arrow batches are cut by bytes, their texts encoded one by one, and only lengths come back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm import segments
from heliograph.llm.common import by_bytes, strings, table

VOCABULARY, LIMIT = "byte_bpe_50k.json", 512


def _lengths(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column("text")), pa.int64()), 0)
            for part in by_bytes(sizes.to_pylist()):
                own = batch.slice(part.start, part.stop - part.start)
                counts = [sum(len(x) for x in segments.ids(path, text)) for text in strings(own, "text")]
                some = sizes.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), some, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
                )

    return run


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: its id, bytes in UTF-8, tokens, and whether these exceed `limit`.

    No shuffle: rows are counted where they are read. A NULL or empty text has 0 bytes and 0 tokens; repeated rows and
    NULL ids stay; other columns are not read; no rows give no rows. Slices of at most 1 MiB of UTF-8, or one
    longer text, are made Python strings at a time; longer texts are encoded in pieces cut at safe boundaries. Memory is
    thus bounded by Spark's Arrow batch and one text or slice.
    """
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    counted = chosen.mapInArrow(_lengths(path), f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
