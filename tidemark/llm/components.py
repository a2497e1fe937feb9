"""Connected components of a graph in two columns of node ids, by large-star and small-star rounds.

A round maps every edge to the smallest known neighbour of one of its ends (aggregates and joins only, so a node with
a third of all edges is pre-aggregated and its join partition can be split). Rounds end when no edge changes; each
writes its edges to the shared checkpoint folder, which cuts the lineage. Rounds grow with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, release, splittable, splittable_on


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v). Large: each node's larger neighbours; small: its smaller ones and itself."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select("u", "v")
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(splittable(least, "u"), splittable_on(around, "u")).select("u", "v", "m")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def component_of(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges`` has long columns u and v (any order, loops allowed). Returns node, component (smallest node id) for
    every node with a smaller one in its component; nodes left out are the smallest of their own."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges, state = cut(edges), None
    for _ in range(most_rounds):
        before, edges = edges, cut(_star(_star(edges, large=True), large=False))
        release(before)
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max("u"), F.min("v")).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
