"""Connected components by alternating large and small stars, over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node it is connected with.

    Each round hangs every larger neighbour of a node on the node's smallest neighbour, then
    every smaller one; rounds needed grow with the logarithm of the longest path.  Edges are
    rows throughout; a hub's edges are neither held as one value nor sorted in one task.
    """

    def stars(df: DataFrame) -> bool:
        """Whether each u has one v, which is nobody's u: then v, smaller than all its u, is the root."""
        ends = df.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(df.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 AND up > 0").isEmpty()

    def with_least(df: DataFrame) -> DataFrame:
        """df with m, the smallest v of each u: one row per u and task goes to the sums, then back by a join that AQE broadcasts by its measured size or splits where u is a hub."""
        return df.join(df.groupBy("u").agg(F.min("v").alias("m")), "u")

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    e = written(e, "edges")
    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both).withColumn("m", F.least("u", "m")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = with_least(written(large, "edges"))
        hung = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = least.withColumn("x", hung).select(F.col("x").alias("u"), F.col("m").alias("v"))
        own = least.filter("v != m").select("u", F.col("m").alias("v"))
        e = written(small.unionByName(own).distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
