"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (partial aggregation first), written to the shared folder, and a join with
it. The written table matters: both sides of the join are then plain exchanges, so AQE splits the
partition of a node with very many neighbours, which it cannot do where the join reads the aggregate's own
exchange. The edge table is written after each step. Edges only ever move to smaller nodes, and the
rounds end when a round leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the least of the node and all its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stash(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of those neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stash(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = (down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and two checksums of distinct edges; none can overflow."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(7), "u"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of any orderable type -> ``(node, root)`` for every node that has an edge;
    ``root`` is the least node of the component. Loops, repeats and NULL ends are ignored."""
    cur = stash(edges.select("u", "v").where("u != v"), "edges")
    before = None
    while True:
        state = _state(cur)
        if state == before or state[0] == 0:
            break
        before = state
        cur = stash(_small_star(stash(_large_star(cur), "edges")), "edges")
    star = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
