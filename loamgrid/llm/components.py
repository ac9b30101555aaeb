"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, scratch


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge at most to a smaller one, and that one has none: then all edges lead to roots."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("node").agg(F.sum("up").alias("n"), F.max("down").alias("d")).where("n > 1 OR (n > 0 AND d > 0)").limit(1).count()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges(u, v): node, root of each node in an edge; root is the smallest node of its component.

    Loops and repeated edges change nothing; rows with a null are left out; no edges give an empty table. A node's
    neighbours are only reduced to their minimum, with partial sums in each task, and the minimum goes back by a join.
    Minima are written first, so that both sides of that join are plain exchanges: a node with very many edges is then
    split over tasks by the adaptive skew join. Rounds grow with the logarithm of the nodes.
    """
    with scratch(edges.sparkSession) as kept:
        now = cut(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        for _ in range(most_rounds):
            if _settled(now):
                break
            # large star: neighbours above a node go to the smallest of the node and its neighbours
            ends = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = cut(ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m")), "least")
            large = cut(now.join(least, "v").select("u", F.col("m").alias("v")), "large")
            # small star: a node and its smaller neighbours go to the smallest of these
            low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "low")
            small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.greatest("v", "m")).alias("u"), F.least("v", "m").alias("v"))
            now = cut(small.where("u <> v").distinct(), "edges")
        else:
            raise RuntimeError("components have not settled")
        kept.append(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
