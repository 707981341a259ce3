"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the smallest node.

    Each round folds neighbours to their minimum on the map side and joins it back, so
    no task holds all links of a node: a hot node only makes a skewed join, which
    adaptive execution splits. A round is checkpointed; the fixed point is recognised
    by the number and the hash sum of the links. Self links count as nodes of their
    own; null ends and repeated links are ignored.
    """
    present = links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    proper = F.col("a") != F.col("b")
    edges = checkpointed(
        present.filter(proper)
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = None
    while True:
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        edges = checkpointed(_small_star(_large_star(edges)))
    alone = present.filter(~proper).select("a").distinct()
    linked = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    named = linked.unionByName(roots)
    rest = alone.join(named, alone["a"] == named["node"], "left_anti")
    return named.unionByName(rest.select(F.col("a").alias("node"), F.col("a").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest of the node's neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        edges.join(least, "a")
        .filter(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()
