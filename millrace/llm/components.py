"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b): root is its component's least node.

    Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
    Beyond") in turn, until nothing changes. A step is a map-side reduced minimum for each
    node and a join, so a node with very many edges is never gathered in one place; the
    rounds grow with the logarithm of the number of nodes. Each round is written to the
    shared folder, which cuts the lineage. Loops and repeated edges do no harm; edges with
    a null end are left out; no edges give no rows.
    """
    found = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        now = found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                        F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            return found.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
        found = stored(_small_star(_large_star(found)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (both.join(least, F.col("a") == F.col("node")).where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is tied to the least of them."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    tied = (edges.join(least, F.col("a") == F.col("node")).where("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return tied.unionByName(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()
