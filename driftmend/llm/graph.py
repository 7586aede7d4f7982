"""Connected components by alternating star contractions, each step one table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.sources.sinks import staged


def _hung_below(pairs: DataFrame) -> DataFrame:
    """Each (node, neighbour) hung below the smallest neighbour of ``node``, or ``node`` if that is smaller."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node").withColumn("least", F.least("least", "node"))


def _step(edges: DataFrame) -> DataFrame:
    """Edges (node, other) with other < node, after one large star and one small star."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    large = _hung_below(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    small = _hung_below(large.where("node > other").distinct())
    moved = small.select(F.col("other").alias("node"), F.col("least").alias("other"))
    kept = small.select("node", F.col("least").alias("other"))
    return moved.unionByName(kept).where("node > other").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node hangs below one other, which hangs below none."""
    ends = edges.select("node", F.lit(1).alias("below")).unionByName(edges.select(F.col("other").alias("node"), F.lit(0).alias("below")))
    each = ends.groupBy("node").agg(F.sum("below").alias("times"), F.min("below").alias("least"))
    return each.where("times > 1 OR (times = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Nodes are numbers; edges with a null end or equal ends count as none. A node with any number of neighbours is
    folded before its shuffle, and the join on it is split by adaptive execution. The number of steps grows with the
    logarithm of the longest chain. An empty table has no components.
    """
    current = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(),
        "edges",
    )
    while not _is_done(current):
        current = staged(_step(current), "edges")
    roots = current.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    return current.select("node", F.col("other").alias("component")).unionByName(roots)


def joined_components(found: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after ``edges`` (a, b) between nodes join components already ``found``.

    Only the components that an edge touches are worked on.
    """
    ends = [found.select(F.col("node").alias(e), F.col("component").alias(f"of_{e}")) for e in ("a", "b")]
    between = edges.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = components(between).select(F.col("node").alias("component"), F.col("component").alias("into"))
    after = found.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    fresh = moved.select(F.col("component").alias("node"), F.col("into").alias("component")).join(found, "node", "left_anti")
    return after.unionByName(fresh)
