"""Embedding whitening by a bit-sliced scatter.

Entries become whole numbers. The fit list holds each distinct vector once. Its rows are packed into bit planes, one for
each dimension and bit, 64 rows a word; the weighted counts of ones in the AND of two planes add up to exact cross-products.
These are centred as whole numbers, and only then divided and decomposed. What reaches the driver is one matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm.common import table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16

# Whole numbers are held within this; beyond it a double has no entry of its own for every whole number.
_MOST = 1 << 52

# A plane pair's weighted count stays below 2^63 up to this many bits; wider numbers are added up as Python ones.
_NARROW = 20

# An eigenvalue below this share of the largest one is nothing but rounding.
_RANK = 1e-12


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, entries as doubles) of the vectors without missing or non-finite entries, for each length in turn."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a missing entry becomes NaN
    lengths = np.diff(offsets)
    there = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
    for length in np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(there & (lengths == length))
        entries = flat[offsets[rows][:, None] + np.arange(length)]
        good = np.isfinite(entries).all(axis=1)
        if good.any():
            yield rows[good], entries[good]


def _whole(entries: np.ndarray, scale: float) -> np.ndarray:
    """Whole numbers of the entries, without the shift."""
    return np.clip(np.floor(scale * entries), -_MOST, _MOST).astype(np.int64)


def _points(scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, entries in _matrices(batch.column("vector")):
                # Copies within a batch are dropped here, the others by Spark.
                raw = {row.tobytes() for row in _whole(entries, scale).astype("<i8")}
                size = pa.array([entries.shape[1]] * len(raw), pa.int32())
                yield pa.RecordBatch.from_arrays([size, pa.array(list(raw), pa.binary())], ["length", "point"])

    return run


def _read(points: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(points.to_pylist()), "<i8").reshape(-1, length)


def scatter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products of whole-numbered `rows`, exact, as Python numbers.

    Every dimension is shifted to begin at 0 and cut into as many bit planes as it needs. The shift is undone afterwards.
    """
    n, width = rows.shape
    least = rows.min(axis=0)
    moved = (rows - least).astype(np.uint64)
    bits = [int(m).bit_length() for m in moved.max(axis=0)]
    owner = np.repeat(np.arange(width), bits)
    bit = np.concatenate([np.arange(b) for b in bits]).astype(np.uint64) if sum(bits) else np.zeros(0, np.uint64)
    planes = np.zeros((len(owner), -(-n // 64)), np.uint64)
    for k, (d, b) in enumerate(zip(owner.tolist(), bit)):
        packed = np.packbits(((moved[:, d] >> b) & np.uint64(1)).astype(np.uint8))
        planes[k].view(np.uint8)[: len(packed)] = packed
    wide = max(bits, default=0) > _NARROW
    kind = object if wide else np.int64
    weights = np.array([1 << int(b) for b in bit], kind)
    sums, cross = np.zeros(width, kind), np.zeros((width, width), kind)
    np.add.at(sums, owner, np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind) * weights)
    for k, d in enumerate(owner.tolist()):
        ones = np.bitwise_count(planes[k:] & planes[k]).sum(axis=1, dtype=np.int64).astype(kind)
        own = np.zeros(width, kind)
        np.add.at(own, owner[k:], ones * weights[k:] * weights[k])
        # Planes of one dimension meet twice, each with itself once.
        own[d] = 2 * own[d] - ones[0] * weights[k] * weights[k]
        cross[d] += own
    sums, cross, least = sums.astype(object), cross.astype(object), least.astype(object)
    upper = np.triu(cross, 1)
    cross = upper + upper.T + np.diag(np.diag(cross))
    back = np.outer(sums, least)
    return sums + n * least, cross + back + back.T + n * np.outer(least, least)


def _scattered(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(length, object), np.zeros((length, length), object)
        for batch in batches:
            if batch.num_rows:
                rows = _read(batch.column("point"), length)
                more, products = scatter(rows)
                n, sums, cross = n + len(rows), sums + more, cross + products
        if n:
            places = [(-1, -1, n), *((d, -1, s) for d, s in enumerate(sums))]
            places += [(d, e, cross[d, e]) for d in range(length) for e in range(d, length)]
            d, e, total = zip(*places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int32()), pa.array(e, pa.int32()), pa.array([str(x) for x in total])], ["d", "e", "total"]
            )

    return run


def covariance(fit: DataFrame, length: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, sums, and n times the cross-products less the products of sums: the covariance times n squared, exact.

    `fit` has distinct vectors as `point`. Tasks give one matrix each, which Spark adds up entry by entry; the driver gets
    one matrix.
    """
    sums, cross, n = np.zeros(length, object), np.zeros((length, length), object), 0
    parts = fit.select("point").mapInArrow(_scattered(length), "d int, e int, total string")
    for d, e, total in parts.groupBy("d", "e").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        if d < 0:
            n = int(total)
        elif e < 0:
            sums[d] = int(total)
        else:
            cross[d, e] = cross[e, d] = int(total)
    return n, sums, n * cross - np.outer(sums, sums)


def directions(n: int, centred: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, unit eigenvectors as columns, and the trace, of the covariance `centred / n^2`."""
    spread = np.array([[float(x) / n / n for x in row] for row in centred])
    values, vectors = np.linalg.eigh(spread)
    return values[::-1], vectors[:, ::-1], float(sum(centred.diagonal())) / n / n


def _projected(rows: np.ndarray, n: int, sums: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The centred rows along each column of `turn`. Centring is exact before it becomes a double."""
    return _centred(rows, n, sums).astype(np.float64) / n @ turn


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, in Python numbers where 64 bits may not hold it."""
    most = max(int(np.abs(rows).max(initial=0)), 1)
    if n * most < 1 << 61 and max(map(abs, sums), default=0) < 1 << 61:
        return n * rows - sums.astype(np.int64)
    return n * rows.astype(object) - sums


def _squares(centred: np.ndarray) -> list[int]:
    most = max((int(x) for x in (abs(centred.max(initial=0)), abs(centred.min(initial=0)))), default=0)
    if most * most * max(centred.shape[1], 1) < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    return [sum(int(x) ** 2 for x in row) for row in centred]


def _products(length: int, n: int, sums: np.ndarray, turn: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = turn.shape[1]
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                own = _projected(_read(batch.column("point"), length), n, sums, turn)
                total += own.T @ own
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "total"]
        )

    return run


def _whitened(
    length: int, scale: float, n: int, sums: np.ndarray, turn: np.ndarray, explained: list[float | None], error: float | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, entries in _matrices(batch.column("vector")):
                if entries.shape[1] != length:
                    continue
                whole = _whole(entries, scale)
                made = np.full((len(rows), k), np.nan)
                made[:, : turn.shape[1]] = _projected(whole, n, sums, turn)
                squares = [str(x) for x in _squares(_centred(whole, n, sums))]
                at = np.repeat(np.arange(len(rows)), k)
                many = len(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows[at])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(many, n, np.int64)),
                        pa.array(squares).take(pa.array(at)),
                        pa.array(made.ravel(), from_pandas=True),
                        pa.array(explained * len(rows), pa.float64()),
                        pa.array([error] * many, pa.float64()),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: float = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per remaining row and component: id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    An entry c counts as floor(scale * c); a shift common to all entries would change nothing in the result. Rows whose
    vector is NULL, empty or has a NULL or non-finite entry are dropped, and so are vectors of another length than the one
    that most distinct vectors have (the longer, in a tie). The fit list has each distinct vector once, so repeated rows do
    not count, but each has its rows in the result; NULL ids stay; other columns are not read; no rows give no rows.
    Entries are held within 2^52 after scaling. A component without spread (the fit list has fewer directions) has NULL as
    `whitened` and takes no part in `identity_error`; where nothing has any spread, `explained` and `identity_error` are
    NULL too. `deviation` is a decimal, `identity_error` is measured on the whitened fit list.
    """
    chosen = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    if chosen.schema["vector"].dataType.elementType.typeName() not in ("float", "double"):
        chosen = chosen.withColumn("vector", F.col("vector").cast("array<double>"))
    kind = chosen.schema["id"].dataType.simpleString()
    fields = "component int, n bigint, deviation string, whitened double, explained double, identity_error double"
    points = chosen.select("vector").mapInArrow(_points(scale), "length int, point binary").distinct()
    fit = session.materialise(points, "fit")
    most = fit.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    if most is None:
        length, n, sums, turn = 0, 0, np.zeros(0, object), np.zeros((0, 0))
        explained, error = [], None
    else:
        length = most["length"]
        fit = fit.filter(F.col("length") == length)
        n, sums, centred = covariance(fit, length)
        values, columns, trace = directions(n, centred)
        k = min(components, length)
        spread = int((values[:k] > _RANK * max(values[0], 0)).sum()) if trace > 0 else 0
        explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in values[:k]]
        turn = columns[:, :spread] / np.sqrt(values[:spread])
        error = None
        if spread:
            found = fit.select("point").mapInArrow(_products(length, n, sums, turn), "i int, j int, total double")
            cells = found.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
            error = max(abs(c["total"] / n - (c["i"] == c["j"])) for c in cells)
    made = chosen.mapInArrow(_whitened(length, scale, n, sums, turn, explained, error), f"id {kind}, {fields}")
    return made.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")).withColumnRenamed("id", id_column)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings along 16 components. `deviation` is a long (NULL where it does not fit one)."""
    made = whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
