"""Trees of bounded depth, kept as (id, parent) rows: one self-join per level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def derive(nodes: DataFrame, max_depth: int) -> DataFrame:
    """id, depth, path of every node that hangs on a root, and whether it may be expanded."""
    level = nodes.filter("parent IS NULL").select("id", F.lit(1).alias("depth"), F.col("id").alias("path"))
    levels = [level]
    for depth in range(2, max_depth + 1):
        above = levels[-1].select(F.col("id").alias("parent"), F.col("path").alias("above"))
        levels.append(nodes.join(above, "parent").select("id", F.lit(depth).alias("depth"), F.concat_ws(">", "above", "id").alias("path")))
    return reduce(DataFrame.unionByName, levels).withColumn("expandable", F.col("depth") < max_depth)


def ancestors(nodes: DataFrame, max_depth: int) -> DataFrame:
    """id with its ancestors p1, p2, ... up to the root, null beyond it."""
    edges = nodes.select("id", "parent")
    out = edges.withColumnRenamed("parent", "p1")
    for i in range(1, max_depth - 1):
        out = out.join(edges.select(F.col("id").alias(f"p{i}"), F.col("parent").alias(f"p{i + 1}")), f"p{i}", "left")
    return out.select("id", *[f"p{i}" for i in range(1, max_depth)])


def layer_counts(derived: DataFrame, max_depth: int) -> DataFrame:
    """Nodes per root and layer below it."""
    root = F.split("path", ">")[0]
    return derived.groupBy(root.alias("root")).agg(*[F.count_if(F.col("depth") == i).alias(f"layer{i}") for i in range(2, max_depth + 1)])
