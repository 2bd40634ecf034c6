"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets are split further."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm.common import fresh, table

# Production size of a shard, in bytes of text.
SHARD_BYTES = 64 << 20

# Bits that one pass over the rows counts at once, and all bits of a row: 60 of its key and 60 of its number.
PASS_BITS, HASH_BITS = 12, 120


def _bits(key: Column) -> Column:
    """60 bits of a key's MD5 as a string of 0 and 1; the same in any SQL that has MD5."""
    return F.lpad(F.conv(F.substring(F.md5(key), 1, 15), 16, 2), 60, "0")


def _buckets(finest: DataFrame, below: int, deepest: int, limit: int) -> DataFrame:
    """The shard of every finest bucket: (finest, depth, n_bytes, n_rows); depth is NULL where it must be split further.

    Sums of all prefixes are made from the finest buckets, not from rows. A bucket within the limit has no descendant
    above it, so a shard is the shallowest bucket that is not oversized.
    """
    depths = F.explode(F.sequence(F.lit(below), F.lit(deepest))).alias("depth")
    each = finest.select("*", depths).withColumn("prefix", F.expr("substring(finest, 1, depth)"))
    sums = each.groupBy("prefix").agg(F.sum("n_bytes").alias("bytes"), F.sum("n_rows").alias("rows"))
    last = F.lit(deepest >= HASH_BITS) & (F.col("depth") == deepest)
    fits = (F.col("bytes") <= limit) | (F.col("rows") == 1) | last
    shallowest = F.min(F.when(fits, F.struct("depth", "bytes", "rows")))
    shard = each.select("finest", "depth", "prefix").join(sums, "prefix").groupBy("finest").agg(shallowest.alias("s"))
    return shard.select(
        "finest", F.col("s.depth").alias("depth"), F.col("s.bytes").alias("bytes"), F.col("s.rows").alias("rows")
    )


def assign(
    docs: DataFrame,
    limit: int = SHARD_BYTES,
    key_column: str = "doc_id",
    text_column: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """`columns` (all, unless given) of every row of `docs`, then n_bytes, shard, depth, shard_bytes, shard_rows.

    `shard` is a string of bits, the common prefix of its rows' hashes, and `depth` its length; the shards together are
    all rows. Only buckets above `limit` bytes of text are split on another bit. A shard is above it only if it is a
    single row. Rows are hashed by their key; rows of one key are parted by bits of their row number, after the 60 bits
    of the key. NULL keys are one key, NULL texts have no bytes, no rows give no rows. If `docs` has a column of a new
    name, the new one has underscores after its name.

    Every pass sums PASS_BITS bits on the map side and joins rows with the written sums; a bucket of very many rows is
    split by a skew join. A further pass reads only the rows of buckets that are still oversized.
    """
    own = docs.columns if columns is None else columns
    kept = docs.select(F.struct(*own).alias("kept"), F.col(key_column).alias("key"), F.col(text_column).alias("text"))
    named = kept.withColumn("row", F.monotonically_increasing_id()).select(
        "kept",
        F.concat(_bits(F.coalesce(F.col("key").cast("string"), F.lit(""))), _bits(F.col("row").cast("string"))).alias("bits"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    rows, below, located = session.materialise(named, "keyed"), 0, []
    while True:
        deepest = min(below + PASS_BITS, HASH_BITS)
        prefix = F.substring("bits", 1, deepest)
        finest = session.materialise(
            rows.groupBy(prefix.alias("finest")).agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")),
            "finest",
        )
        shards = session.materialise(_buckets(finest, below, deepest, limit), "shards")
        placed = rows.withColumn("finest", prefix).join(shards, "finest")
        located.append(placed.filter("depth IS NOT NULL"))
        if shards.filter("depth IS NULL").isEmpty():
            break
        rows = session.materialise(placed.filter("depth IS NULL").select(*named.columns), "open_rows")
        below = deepest
    result = reduce(DataFrame.unionByName, located)
    names = {n: fresh(docs.select(*own), n) for n in ("n_bytes", "shard", "depth", "shard_bytes", "shard_rows")}
    return result.select(
        "kept.*",
        F.col("n_bytes").alias(names["n_bytes"]),
        F.expr("substring(bits, 1, depth)").alias(names["shard"]),
        F.col("depth").alias(names["depth"]),
        F.col("bytes").alias(names["shard_bytes"]),
        F.col("rows").alias(names["shard_rows"]),
    )


def write_shards(
    docs: DataFrame, path: str, limit: int = SHARD_BYTES, key_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write `docs` as one Parquet folder per shard below `path`, by the column "shard"; an empty prefix is "all"."""
    placed = assign(docs, limit, key_column, text_column)
    shard = placed.columns[-4]
    folder = fresh(placed, "shard") if shard != "shard" else shard
    named = placed.withColumn(folder, F.when(F.col(shard) == "", "all").otherwise(F.concat(F.lit("b"), shard)))
    named.repartition(folder).write.partitionBy(folder).parquet(path)


# The query's shards are smaller, so that small tables are split as well.
QUERY_BYTES = 256 << 10


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, in shards of 256 KiB of text."""
    return assign(table(spark, sf_dir, "documents"), QUERY_BYTES, columns=["doc_id"])


SQL = f"""
WITH keyed AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents
),
buckets AS (
  SELECT d, substr(bits, 1, d) AS prefix, sum(n_bytes) AS bytes, count(*) AS n
  FROM keyed, range(0, 31) AS depths(d) GROUP BY ALL
),
fitting AS (SELECT * FROM buckets WHERE bytes <= {QUERY_BYTES} OR n = 1),
shallowest AS (
  SELECT k.doc_id, k.n_bytes, f.prefix AS shard, f.d AS depth, f.bytes AS shard_bytes, f.n AS shard_rows,
    row_number() OVER (PARTITION BY k.r ORDER BY f.d) AS place
  FROM keyed k JOIN fitting f ON substr(k.bits, 1, f.d) = f.prefix
)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
FROM shallowest WHERE place = 1
"""
