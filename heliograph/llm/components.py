"""Connected components of a graph given by its edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph import session


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its larger (or smaller) neighbours to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # Edges are held with a > b, so that the small step needs one direction only.
    least = session.materialise(
        both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"
    )
    linked = both.join(least, "a")
    if large:
        moved = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is the least node that can be reached.

    Large-star and small-star steps in turn, until the edges no longer change; their number grows with the logarithm of
    the longest path, not with the path. Each step is written to the shared folder. A node with many neighbours is
    reduced on the map side; the least neighbours are written before they are joined, so that Spark can split its join.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    held, before = session.materialise(ordered, "edges"), None
    while True:
        sums = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == before:
            break
        before = tuple(sums)
        held = session.materialise(_stars(_stars(held, large=True), large=False), "edges")
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
