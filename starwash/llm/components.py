"""Connected components by alternating large-star and small-star steps.

Edges stay in Spark tables; each step is one aggregation and one join on the
node, written to the shared folder, so no component or edge list is gathered
anywhere and a lost executor costs the current step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v: connect neighbours to the least one."""
    if large:  # all neighbours; only the greater ones are moved
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # smaller neighbours are moved, and the node itself
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b; any order):
    the component is its least node. Nodes without an edge are not returned."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    pairs = save(pairs, f"{name}-edges")
    seen = None
    while True:
        pairs = save(_star(_star(pairs, True), False), name)
        # the steps have ended when the edges no longer change: every edge leads to the least node
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
