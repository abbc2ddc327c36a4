"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stash

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the least node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node (u > v) sends its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (u, v): root is the least node of its component. Loops and repeats don't matter.

    Each round ends in a table in the shared folder. Sums are made before shuffles; a node with very many neighbours is a
    skewed key of plain joins, which AQE splits. No row is collected.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = stash(edges, "edges")
    for _ in range(MOST_ROUNDS):
        # A forest of stars: no node has two parents, and no parent has one.
        parents = edges.groupBy("u").agg(F.count("*").alias("n"))
        many = parents.filter("n > 1").select("u")
        chained = edges.join(parents.select(F.col("u").alias("p")), F.col("v") == F.col("p"), "left_semi").select("u")
        if many.unionByName(chained).isEmpty():
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = stash(_small_star(_large_star(edges)), "edges")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
