"""Connected components of a link table by alternating large-star and small-star steps.

Every step is grouping (with map-side combining) and joins, and its result is written to the
scratch folder, so neither links nor components pass through the driver, and a lost executor
costs one step at most.  A node with very many links is split by Spark's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the least node reachable, for every node with a link to another.

    Links to itself, null ends and repeated links change nothing; no links give an empty table.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, state, step = scratch.table("links-0", edges), None, 0
    while True:
        total = F.sum(F.col("v").cast("decimal(20,0)"))  # names of 64 bits add up beyond a long
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), total).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state, step = now, step + 1
        edges = scratch.table(f"links-{step}", _small_star(_large_star(edges)))
        if step > 1:
            scratch.drop(f"links-{step - 1}")
