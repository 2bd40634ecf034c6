"""Groups that may hold a large share of all rows: finding them, and attaching group results to rows all the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph import session

# Up to this many groups are broadcast. A group is a key and a few numbers, so this is some tens of megabytes.
BROADCAST_GROUPS = 500_000

# Beyond that, a key is hot when it holds more than 1 / HOT_SHARES of all rows. Fewer than HOT_SHARES keys can do so.
HOT_SHARES = 10_000

# Looking for hot join keys: rows are counted in this many hash buckets, and a key may have this many rows, or more in a
# table with many rows per bucket.
HASH_BUCKETS = 65_536
HOT_ROWS = 1_000
BUCKET_TOLERANCE = 16


def has_hot_key(frames: list[DataFrame], keys: list[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether a single key may hold too many rows of one of the frames for a task to work through.

    Rows are counted by hash bucket of their key, mostly on the map side, so the shuffle carries a few numbers per task.
    A key has at most the rows of its bucket; if no bucket stands out, no key does. Reads the key columns only, of
    tables of any size: bytes on disk tell nothing about a key, as copies compress to nothing.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).alias("bucket")
    buckets = [frame.dropna(subset=keys).select(F.lit(n).alias("frame"), bucket) for n, frame in enumerate(frames)]
    counts = reduce(DataFrame.unionAll, buckets).groupBy("frame", "bucket").agg(F.count(F.lit(1)).alias("n"))
    per_frame = counts.groupBy("frame").agg(F.max("n").alias("fullest"), F.sum("n").alias("total")).collect()
    return any(r.fullest > max(hot_rows, BUCKET_TOLERANCE * r.total / HASH_BUCKETS) for r in per_frame)


def _same(rows: DataFrame, groups: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [rows[k].eqNullSafe(groups[f"_{k}"]) for k in keys])


def attach_group_values(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """Add the columns of `groups` (one row per key, its row count in `size`) to the rows with that key.

    Stands in for a whole-partition window function, which would bring each group into one task. The groups are
    aggregated once, into a table in the shared folder, and counted. Few groups are broadcast, and the rows are not
    shuffled. With more groups than `broadcast_groups`, rows of hot keys still meet a broadcast, of fewer than
    `HOT_SHARES` group rows, and the other rows are shuffled by key, where no key holds more than 1 / `HOT_SHARES` of
    them. NULL keys match each other, as in a window function.
    """
    key_copies = [f"_{k}" for k in keys]
    groups = session.materialise(groups.withColumnsRenamed(dict(zip(keys, key_copies))), "groups")
    n_groups, n_rows = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if n_groups <= broadcast_groups:
        return rows.join(F.broadcast(groups), _same(rows, groups, keys)).drop(*key_copies)

    is_hot = F.col(size) * HOT_SHARES > n_rows
    hot, cold = groups.where(is_hot), groups.where(~is_hot)
    on_hot = _same(rows, hot, keys)
    from_hot = rows.join(F.broadcast(hot), on_hot).drop(*key_copies)
    others = rows.join(F.broadcast(hot.select(*key_copies)), on_hot, "left_anti")
    from_cold = others.join(cold, _same(others, cold, keys)).drop(*key_copies)
    return from_hot.unionByName(from_cold)
