"""Tables laid out for paging: rows in ranges of their order, and a directory that tells which range holds which place.

A page deep in a table reads the directory and the ranges that the page lies in, and neither the rows before it nor the
names of their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RANGE_ROWS = 10_000

# A range is a folder, and folders cost the same whatever is in them. A larger table has larger ranges, not more.
MOST_RANGES = 1_000

DIRECTORY = "page_range INT, rows BIGINT, before BIGINT"


def write_pages(rows: DataFrame, path: str, order: list[str], range_rows: int = RANGE_ROWS) -> None:
    """Write `rows` in the given order to the new folder `path`, in ranges of about `range_rows` rows, or of a
    thousandth of the table where that is more.

    One shuffle deals the rows by range of their order. The bounds come from a sample and decide only how large the
    ranges are. The directory has one row per range and is written last; without it there are no pages. `rows` is read
    three times (to be counted, sampled and written), so it should be a table.
    """
    number = min(max(1, -(-rows.count() // range_rows)), MOST_RANGES)
    ranged = rows.repartitionByRange(number, *order).withColumn("page_range", F.spark_partition_id())
    ranged.sortWithinPartitions("page_range", *order).write.partitionBy("page_range").parquet(f"{path}/ranges")
    spark = rows.sparkSession
    written = spark.read.schema(StructType([*rows.schema.fields, *StructType.fromDDL("page_range INT").fields]))
    sizes = written.parquet(f"{path}/ranges").groupBy("page_range").agg(F.count(F.lit(1)).alias("rows"))
    # One row per range, so a single task adds them up.
    earlier = Window.orderBy("page_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    sizes.select("page_range", "rows", before).coalesce(1).write.parquet(f"{path}/directory")


def count_rows(spark: SparkSession, path: str) -> int:
    """Number of rows of all pages, from the directory."""
    return spark.read.schema(DIRECTORY).parquet(f"{path}/directory").agg(F.sum("rows")).first()[0] or 0


def read_page(
    spark: SparkSession, path: str, schema: StructType, order: list[str], skip: int = 0, limit: int = 100
) -> DataFrame:
    """The `limit` rows behind the first `skip` ones, in the order that the pages were written in.

    Rows that are equal in all columns of `order` have no order among each other. Behind the last row there are none.
    """
    if skip < 0 or limit < 0:
        raise ValueError("skip and limit must not be negative")
    first, behind = F.col("before"), F.col("before") + F.col("rows")
    directory = spark.read.schema(DIRECTORY).parquet(f"{path}/directory")
    # A page has few ranges, as its limit is what a caller wants to see at once.
    held = directory.where((behind > skip) & (first < skip + limit)).orderBy("page_range").collect()
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/ranges/page_range={r.page_range}" for r in held]
    return spark.read.schema(schema).parquet(*folders).orderBy(*order).offset(skip - held[0].before).limit(limit)
