"""Connected components of an edge table, as rounds of Spark aggregates.

Alternating large-star and small-star steps (Kiveris et al., SoCC 2014):
every step replaces edges by edges to the smallest neighbour, so the table
never grows beyond the number of edges and ends as one star per component.
Each step is an aggregate (partial sums on the map side) and a join, so a
node with a third of all edges is not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component = smallest
    node reachable. ``edges`` has long columns u, v; loops are ignored."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        old, now = now, stored(_small_star(_large_star(now)), "edges")
        drop_stored(old)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
