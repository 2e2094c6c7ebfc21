"""Connected components of a large edge list by alternating star contraction.

Large stars link every larger neighbour of a node to the node's least neighbour; small stars do so for the smaller
ones. Each round is two sums by key, and the frame shrinks to one edge per node, until all edges are stars. Lineage is cut after every round.
Self-loops and repeated edges are fine; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node other than a root of ``edges`` (u, v)."""
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "components")
    for _ in range(MOST_ROUNDS):
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = materialize(_small_star(_large_star(edges)), "components", instead_of=edges)
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node has one edge to a root, and roots have none. One sum by node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    larger = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return larger.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge leads from a larger to a smaller node.
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    linked = edges.join(least, F.col("u") == F.col("k"))
    down = linked.select("u", F.col("m").alias("v")).unionByName(linked.select(F.col("v").alias("u"), F.col("m").alias("v")))
    return down.filter("u <> v").distinct()
