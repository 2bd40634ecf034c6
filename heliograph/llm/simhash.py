"""SimHash near-duplicates: fingerprints, vantage-point trees over Hamming distance, and components of linked texts.

Equal fingerprints are one point. A tree of vantage points, grown on a bounded sample, cuts the points into shards by
their distance from each vantage point. A point within the link distance of a cut also goes to the shard beyond it, so
every linked pair meets in some shard. Within a shard the tree goes on, down to leaves small enough to compare all
distances; by the triangle inequality no branch that is left out can hold a linked point. A shard gives one star per
group that it finds, never all pairs, and the stars of all shards are joined into components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from heliograph import session
from heliograph.llm.common import LOWER, UPPER, fresh, slices, strings, table, told_apart
from heliograph.llm.components import components

SHINGLE, BITS, SEED = 3, 2, 42

# Points aimed at in one shard, shards at most, and sampled points per shard that the tree is grown on. The sample only
# places the cuts; any cuts give the same result.
SHARD_POINTS, SHARDS, SAMPLED = 16_384, 4096, 32

# A shard with more points than this is searched by neighbour keys instead.
SHARD_MOST = 200_000

# Leaves that are compared pair by pair.
LEAF = 256

_FOLD = bytes.maketrans((UPPER + "\t\n\x0b\x0c\r").encode(), (LOWER + " " * 5).encode())
_LANES = np.uint64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 255):  # a byte lane holds 255 ones
        block = hashes[start : start + 255]
        for bit in range(8):
            lanes = ((block >> np.uint64(bit)) & _LANES).sum(dtype=np.uint64)
            total[bit::8] += np.array([lanes], "<u8").view(np.uint8)
    return total


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The bits set in more than half of the shingles' hashes; 0 without words."""
    # White space is single bytes below 0x80, so folding and cutting bytes cuts no character.
    joined = b" ".join(text.encode().translate(_FOLD).split())
    if not joined:
        return 0
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts, ends[shingle - 1 :], strict=False)
    hashes = [digest(joined[a:b], SEED) for a, b in cuts] or [digest(joined, SEED)]
    counts = _bit_counts(np.array(hashes, np.uint64))
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own for whole in batches for own in slices(whole, "text")):
            found = np.array([fingerprint(t, shingle) for t in strings(batch, "text")], np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found.view(np.int64))], [*batch.schema.names[:-1], "point"]
            )

    return run


def fingerprints(docs: DataFrame, columns: list[str], text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The given columns and `point`: the fingerprint as a signed 64-bit number."""
    chosen = docs.select(*columns, F.col(text_column).alias("text"))
    made = StructType([*chosen.schema.fields[:-1], StructField("point", LongType())])
    return chosen.mapInArrow(_fingerprints(shingle), made)


def _distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _cut(points: np.ndarray, seed: int) -> tuple[np.uint64, int] | None:
    """A vantage point among `points` and the distance to cut at, so that the larger branch is as small as can be."""
    best = None
    for k in range(4):
        vantage = points[(seed * 7919 + k * 104_729) % len(points)]
        n = np.bincount(_distances(points, vantage), minlength=65)
        inside = np.cumsum(n)
        # Inside: up to the cut. Outside: beyond it, and the points that lie up to BITS before it.
        outside = len(points) - np.concatenate([np.zeros(BITS, np.int64), inside[:-BITS]])
        worst = np.maximum(inside, outside)
        cut = int(worst.argmin())
        if best is None or worst[cut] < best[0]:
            best = worst[cut], vantage, cut
    return None if best[0] > 0.9 * len(points) else (best[1], best[2])


def grow(sample: np.ndarray, leaves: int, seed: int = 1) -> list[tuple[int, int, int, int]]:
    """A tree as (vantage, cut, inside, outside) by node; a child below 0 is the shard -1 - child."""
    nodes: list[tuple[int, int, int, int]] = []
    made = 0

    def add(points: np.ndarray, wanted: int) -> int:
        nonlocal made
        found = _cut(points, seed + len(nodes)) if wanted > 1 and len(points) >= 16 else None
        if found is None:
            made += 1
            return -made
        at, (vantage, cut) = len(nodes), found
        nodes.append((0, 0, 0, 0))
        d = _distances(points, vantage)
        left, right = points[d <= cut], points[d > cut - BITS]
        nodes[at] = (int(vantage), cut, add(left, wanted // 2), add(right, wanted - wanted // 2))
        return at

    return nodes if add(sample, leaves) == 0 and nodes else []


def _dealt(nodes: list[tuple[int, int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("point").to_numpy(zero_copy_only=False).view(np.uint64)
            todo = [(0, points)]
            while todo:
                at, some = todo.pop()
                if at < 0:
                    shard = np.full(len(some), -1 - at, np.int32)
                    columns = [pa.array(shard), pa.array(some.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "point"])
                elif len(some):
                    vantage, cut, inside, outside = nodes[at]
                    d = _distances(some, np.uint64(vantage))
                    todo += [(inside, some[d <= cut]), (outside, some[d > cut - BITS])]

    return run


class _Groups:
    """Union of positions, each group named by its least position."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def _balls(points: np.ndarray) -> np.ndarray:
    """Each point and its 64 neighbours at one bit. Two points share one of these if and only if they link."""
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    return points[:, None] ^ flips[None, :]


def _search(points: np.ndarray) -> _Groups:
    """Groups of linked points of one shard."""
    groups, seed = _Groups(len(points)), 0
    todo = [np.arange(len(points))]
    while todo:
        some, seed = todo.pop(), seed + 1
        own = points[some]
        if len(some) <= LEAF:
            near = np.triu(np.bitwise_count(own[:, None] ^ own[None, :]) <= BITS, 1)
            a, b = np.nonzero(near)
            groups.join(some[a], some[b])
        elif found := _cut(own, seed):
            d = _distances(own, found[0])
            todo += [some[d <= found[1]], some[d > found[1] - BITS]]
        else:
            # Too dense for any cut: pairs are found by shared neighbours.
            keys = _balls(own).ravel()
            order = np.argsort(keys, kind="stable")
            same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
            groups.join(some[order[same] // 65], some[order[same + 1] // 65])
    return groups


def _stars(shard: pa.Table) -> pa.Table:
    points = np.unique(shard["point"].to_numpy())
    groups = _search(points.view(np.uint64))
    roots = np.array([groups.find(i) for i in range(len(points))], np.int64)
    linked = np.flatnonzero(roots != np.arange(len(points)))
    return pa.table({"a": points[linked], "b": points[roots[linked]]})


def _by_neighbours(points: DataFrame) -> DataFrame:
    """Links of points that share a neighbour; at most 65 points do, so no group is large."""
    one = F.lit(1).cast("bigint")
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("point").bitwiseXOR(F.call_function("shiftleft", one, k))
    )
    keyed = points.select("point", F.explode(F.concat(F.array("point"), flips)).alias("key"))
    shared = keyed.groupBy("key").agg(F.collect_list("point").alias("points")).filter(F.size("points") > 1)
    return shared.select(F.explode("points").alias("a"), F.array_min("points").alias("b")).filter("a <> b").distinct()


def links(points: DataFrame) -> DataFrame:
    """Stars (a, b) that connect the linked ones of distinct `points`, a table of one column "point"."""
    spark = points.sparkSession
    n = points.count()
    leaves = min(SHARDS, -(-n // SHARD_POINTS))
    nodes: list[tuple[int, int, int, int]] = []
    if leaves > 1:
        most = SAMPLED * leaves
        some = points.orderBy(F.xxhash64("point")).limit(most).collect()
        nodes = grow(np.array([r[0] for r in some], np.int64).view(np.uint64), leaves)
    if nodes:
        dealt = session.materialise(points.mapInArrow(_dealt(nodes), "shard int, point bigint"), "shards")
    else:
        dealt = points.select(F.lit(0).alias("shard"), "point")
    sizes = dealt.groupBy("shard").count()
    oversize = [r["shard"] for r in sizes.filter(F.col("count") > SHARD_MOST).collect()]  # at most SHARDS numbers
    fitting = dealt.filter(~F.col("shard").isin(oversize)) if oversize else dealt
    found = fitting.groupBy("shard").applyInArrow(_stars, "a bigint, b bigint")
    if oversize:
        rest = dealt.filter(F.col("shard").isin(oversize)).select("point").distinct()
        found = found.unionByName(_by_neighbours(rest))
    return found


def rooted(points: DataFrame) -> DataFrame:
    """`points` (a written table with distinct `point`) with the least point that can be reached as `root`."""
    roots = session.materialise(components(links(points.select("point"))), "roots")
    joined = points.join(roots.withColumnRenamed("node", "point"), "point", "left")
    return joined.withColumn("root", F.coalesce("root", "point"))


def simhash_groups(
    docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, fingerprint (16 hex digits), component_id (least id linked to it).

    Words are the whole of each text, lower-cased in A-Z. A text of fewer words than a shingle is one shingle; a NULL
    text or one without words has fingerprint 0, and all of these are linked. A NULL id names a component only if it
    has no other. Repeated rows stay, other columns are not read, and no rows give no rows.
    """
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marked = session.materialise(fingerprints(chosen, ["id"], "text", shingle), "fingerprints")
    points = session.materialise(marked.groupBy("point").agg(F.min("id").alias("least")), "points")
    named = session.materialise(rooted(points), "rooted")
    # Written before they are joined, so that a component with very many points or copies is split by a skew join.
    least = session.materialise(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    groups = session.materialise(named.join(least, "root").select("point", "component_id"), "groups")
    return marked.join(groups, "point").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame,
    shingle: int = SHINGLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    from_files: bool = False,
) -> DataFrame:
    """The rows of `docs`, one of each component: the least id, and of rows with this id the first row.

    All columns are kept, whatever their names. NULL ids come last. `docs` is read twice, for fingerprints and for what
    stays; unless it is a table read `from_files`, it is written first.
    """
    row = fresh(docs, "row")
    numbered = told_apart(docs, row, from_files)
    chosen = numbered.select(F.col(id_column).alias("id"), F.col(row).alias("row"), F.col(text_column).alias("text"))
    marked = fingerprints(chosen, ["id", "row"], "text", shingle)
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("best")
    points = session.materialise(marked.groupBy("point").agg(best), "points")
    kept = rooted(points).groupBy("root").agg(F.min("best").alias("best"))
    return numbered.join(kept.select(F.col("best.row").alias(row)), row, "left_semi").drop(row)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_groups(table(spark, sf_dir, "documents"))
