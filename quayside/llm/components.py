"""Connected components of a graph of any size, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import discard, stored


def _smallest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every (node, other) with the smallest of the node and its others, and the table of these.

    The smallest ones are merged before their shuffle and stored, so the join has a shuffle of its own on both sides
    and adaptive execution can split the edges of a node that very many documents are linked to.
    """
    least = stored(edges.groupBy("node").agg(F.min("other").alias("least")), "least")
    return edges.join(least, "node").withColumn("least", F.least("least", "node")), least


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    joined, least = _smallest(both)
    moved = joined.where(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("node"), F.col("least").alias("other")), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    joined, least = _smallest(down)
    starred = joined.select(F.explode(F.array("other", "node")).alias("node"), F.col("least").alias("other"))
    return starred.where(F.col("node") != F.col("other")).distinct(), least


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one other, which has none itself. Then both steps change nothing any more."""
    ends = F.array(F.struct("node", F.lit(1).alias("up"), F.lit(0).alias("down")),
                   F.struct(F.col("other").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (node, other) that is not its component's smallest node itself.

    Both columns are numbers; edges have no direction, loops and repeated edges do no harm. Each round writes its edges
    to the shared folder and removes those of the round before; rounds end when stars are left, which takes about the
    logarithm of the longest path.
    """
    current = stored(edges.select("node", "other").where(F.col("node") != F.col("other")).distinct(), "edges")
    while True:
        large, least = _large_star(current)
        small, lesser = _small_star(large)
        before, current = current, stored(small, "edges")
        discard(before, least, lesser)
        if _are_stars(current):
            return current.select("node", F.col("other").alias("component"))
