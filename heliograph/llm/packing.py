"""Best-fit packing of documents into sequences, with a certificate per partition.

Documents are dealt to partitions of a bounded number of pieces. Each is packed by best-fit decreasing and compared with
lower bounds from dual feasible functions. A partition whose bins equal its bound is proven optimal. The others exchange
their documents, by another dealing, and are packed again, for as long as that saves sequences and there are more than the
bound of all pieces. A single one exchanges with certified partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm import segments
from heliograph.llm.common import slices, strings, table

VOCABULARY, CAPACITY, END = "byte_bpe_50k.json", 2048, 0

# Pieces dealt to one partition, and how many certified partitions take part when only one has a gap.
DEALT, BESIDE = 50_000, 3

# A round of exchange goes on to the next one if it saves this share of the sequences above the bound, and one at least.
GAIN = 0.02

PIECE = ["piece", "start", "length", "ids_crc32"]
PLACED = "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, gap bigint"


def _cut(path: str, capacity: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    closing = np.array([end], dtype="<u4")

    def rows(text: str) -> Iterator[tuple[int, int, int, int]]:
        found = np.concatenate([*segments.ids(path, text), closing])
        first = len(found) % capacity or capacity
        edges = [0, *range(first, len(found) + 1, capacity)] if len(found) > capacity else [0, len(found)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            yield piece, a, b - a, zlib.crc32(found[a:b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own for whole in batches for own in slices(whole, "text")):
            at, made = [], []
            for i, text in enumerate(strings(batch, "text")):
                own = list(rows(text))
                at += [i] * len(own)
                made += own
            if made:
                piece, start, length, crc = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32())]
                    + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                    ["id", *PIECE],
                )

    return run


def cut_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end: int = END,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of at most `capacity` ids: (id, piece, start, length, ids_crc32).

    A document is its ids followed by `end`; a NULL text is the empty one, so every document has a piece. Only a longer
    document is cut; its first piece takes the remainder and all others are full.
    """
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    fields = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return chosen.mapInArrow(_cut(path, capacity, end), fields)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, by two families of dual feasible functions.

    f_e: lengths over capacity - e count as a whole bin, those below e as nothing. u_k: a length x counts as
    floor((k + 1) x / capacity) of k parts of a bin, or as x / capacity where (k + 1) x divides evenly. Whole numbers only.
    """
    return _bound(np.bincount(lengths, minlength=capacity + 1), capacity) if len(lengths) else 0


def _bound(n: np.ndarray, capacity: int) -> int:
    """`lower_bound` of `n[x]` pieces of each length x."""
    size = np.arange(capacity + 1)
    below, weight = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    e = np.arange(capacity // 2 + 1)
    large, middle = below[-1] - below[capacity - e + 1], weight[capacity - e + 1] - weight[e]
    best = int((large + -(-middle // capacity)).max())
    for k in range(1, 65):
        parts, rest = np.divmod((k + 1) * size, capacity)
        # In units of 1 / (k * capacity) of a bin.
        total = int((n * np.where(rest == 0, size * k, parts * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every length, by best-fit decreasing, and the number of bins."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, made = 0, 0  # bit r of `free`: some bin has r places left
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = free >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[left].pop()
            if not open_bins[left]:
                free &= ~(1 << left)
        else:
            left, chosen, made = capacity, made, made + 1
        bins[i], offsets[i] = chosen, capacity - left
        if left > length:
            open_bins[left - length].append(chosen)
            free |= 1 << (left - length)
    return bins, offsets, made


def _place(capacity: int, first: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, items: pa.Table) -> pa.Table:
        lengths = items["length"].to_numpy()
        bins, offsets, made = best_fit(lengths, capacity)
        # Even numbers; the odd ones are those of full pieces.
        named = ((first + key[0].as_py()) << 25) + 2 * bins
        gap = np.full(len(lengths), made - lower_bound(lengths, capacity))
        placed = items.drop_columns("part")
        for name, column in (("sequence_id", named), ("offset", offsets), ("gap", gap)):
            placed = placed.append_column(name, pa.array(column, pa.int64()))
        return placed

    return run


def _packed(items: DataFrame, n: int, first: int, capacity: int, dealt: int) -> tuple[DataFrame, int]:
    """Deal `n` pieces to partitions numbered from `first`, and pack each."""
    parts = max(1, -(-n // dealt))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(first)), F.lit(parts)).alias("part")
    kind = items.schema["id"].dataType.simpleString()
    placed = items.select("*", part).groupBy("part").applyInArrow(_place(capacity, first), f"id {kind}, {PLACED}")
    return session.materialise(placed, "packed"), parts


def pack(pieces: DataFrame, capacity: int = CAPACITY, dealt: int = DEALT, rounds: int | None = None) -> DataFrame:
    """Give every piece a sequence and an offset in it: the columns of `pieces`, sequence_id, offset, gap.

    `gap` is how many sequences the partition of the piece has above its proven lower bound; 0 certifies it. Sequences
    are without holes from 0. Equal lengths go in any order. Partitions exchange pieces for at most `rounds`, or as long
    as a round saves a share of GAIN of the sequences above the bound of all pieces; every round leaves a whole packing. `pieces` should be a written table, as it is read thrice.
    """
    full = pieces.filter(F.col("length") == capacity).select(
        "id",
        *PIECE,
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(0).cast("bigint").alias("gap"),
    )
    items = pieces.filter(F.col("length") < capacity).select("id", *PIECE)
    sizes = np.zeros(capacity + 1, np.int64)
    for length, n in items.groupBy("length").count().collect():
        sizes[length] = n
    least = _bound(sizes, capacity) if sizes.any() else 0
    packed, first = _packed(items, int(sizes.sum()), 0, capacity, dealt)
    total, part = packed.filter("offset = 0").count(), F.shiftright("sequence_id", 25)
    while total > least and rounds != 0:
        chosen = F.col("gap") > 0
        found = packed.filter(chosen).select(F.count_distinct(part)).first()[0]
        if found < 2:
            room = capacity * F.count_if(F.col("offset") == 0) - F.sum("length")
            others = packed.filter("gap = 0").groupBy(part.alias("part")).agg(room.alias("room"))
            names = [r["part"] for r in others.orderBy(F.desc("room"), "part").limit(BESIDE).collect()]
            if not found or not names:
                break
            chosen = chosen | part.isin(names)
        own = packed.filter(chosen)
        n, had = own.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        again, more = _packed(own.select("id", *PIECE), n, first, capacity, dealt)
        first += more
        saved = had - again.filter("offset = 0").count()
        if saved <= 0:
            break
        above, total = total - least, total - saved
        packed = packed.filter(~chosen).unionByName(again)
        rounds = rounds if rounds is None else rounds - 1
        if saved < GAIN * above:
            break
    return packed.unionByName(full)


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end: int = END,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Cut and pack documents. Texts are encoded once; only ids, lengths and checksums go on.

    NULL texts count as empty, repeated rows and NULL ids are packed like others, other columns are not read, and no
    rows give no rows.
    """
    pieces = session.materialise(cut_documents(docs, path, capacity, end, id_column, text_column), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_column)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
