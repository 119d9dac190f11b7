"""Connected components by alternating large and small stars.

Every round is a few joins and grouped minima over the edges; nothing grows
beyond the edge count, and each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    # staged, so that the join reshuffles both sides and a skewed one can split
    least = stage(both.groupBy("u").agg(F.min("v").alias("m"))
                  .withColumn("m", F.least("u", "m")), "star-least")
    near = both.join(least, "u")
    if large:
        out = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), "m")
    else:
        out = (near.select(F.col("v").alias("u"), "m")
               .unionByName(least.select("u", "m")))
    return out.where(F.col("u") != F.col("m")).select("u", F.col("m").alias("v")).distinct()


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, root): the smallest node of each node's component.

    Only nodes with an edge to another node come back; null ends are ignored.
    """
    cur = stage(edges.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                "edges")
    mark = None
    while True:
        cur = stage(_star(stage(_star(cur, True), "large-star"), False), "small-star")
        now = cur.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == now:
            break
        mark = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
