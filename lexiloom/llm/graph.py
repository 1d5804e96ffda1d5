"""Connected components of an edge list, by alternating large and small stars.

Each round is two shuffles of the edges with sums per node, never a neighbour
list: a hub with a third of all edges is only a minimum and a join whose rows
are dealt over several tasks. Edges shrink to one star per component, usually in a few rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import stored
from lexiloom.operators.skew import spread_join


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reachable."""
    edges = stored(_ordered(edges))
    state = None
    for _ in range(rounds):
        edges = stored(_small_star(stored(_large_star(edges))))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return spread_join(both.where("v > u"), least, ["u"], "inner", ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = spread_join(edges, least, ["u"], "inner", ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
