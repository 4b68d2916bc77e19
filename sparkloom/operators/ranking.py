"""Ranking, budgets and state over ordered rows.

Every window is partitioned by a group, except those over one row per group, which are
sums with a cutoff.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the order, which must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(w)).filter("__place = 1").drop("__place")


def select_candidates(rows: DataFrame, budget: int) -> DataFrame:
    """One candidate per group: the best of the main flow; else, while the budget lasts, the best to explore; else the original.

    Groups draw on the budget in the order of their first candidate.
    """
    tier = F.when(F.col("flow") == "main", 0).when(F.col("flow") == "explore", 1).otherwise(2)
    ranked = rows.filter("flow <> 'reject'").withColumn("tier", tier)
    best = first_by(ranked, ["grp"], [F.col("tier"), F.desc("score"), F.desc("gain"), F.col("id")])
    first = rows.groupBy("grp").agg(F.min("id").alias("first_id"), F.count("*").alias("n"), F.count_if(F.col("flow") == "reject").alias("rejected"))
    g = first.join(best.select("grp", "id", "tier", "score"), "grp", "left")
    needs = F.coalesce((F.col("tier") == 1).cast("int"), F.lit(0))
    spent = F.sum(needs).over(Window.orderBy("first_id").rowsBetween(Window.unboundedPreceding, 0))  # one row per group
    g = g.withColumn("spent", spent)
    chosen = F.when(F.col("tier") == 0, "main").when((F.col("tier") == 1) & (F.col("spent") <= budget), "explore").otherwise("original")
    return g.select("grp", "n", "rejected", chosen.alias("chosen"), F.when(chosen != "original", F.col("id")).alias("id"))


def allocate(rows: DataFrame, key: str, desired: str, budget: int) -> DataFrame:
    """One unit each; what the budget has beyond goes to the largest desired counts first, ties in key order."""
    w = Window.orderBy(F.desc(desired), key)  # one row per key
    want = F.col(desired) - 1
    upto = F.coalesce(F.sum(want).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spare = F.lit(budget) - F.count("*").over(Window.partitionBy(F.lit(0)))
    return rows.select(key, desired, (1 + F.least(want, F.greatest(F.lit(0), spare - upto))).cast("long").alias("given"))


def deviation_from_mean(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Each value's distance from its group's mean, and its class (an exact zero is near the mean)."""
    gap = F.round(F.col(value) - F.avg(value).over(Window.partitionBy(group)), 6) + F.lit(0.0)  # no negative zero
    kind = F.when(gap > 0, "high").when(gap < 0, "low").otherwise("near_mean")
    return rows.withColumns({"advantage": gap, "kind": kind})


def streaks(rows: DataFrame, key: str, order: str, hit: Column) -> DataFrame:
    """The running length of the current streak of hits, reset by a miss."""
    w = Window.partitionBy(key).orderBy(order)
    h = rows.withColumn("__hit", hit.cast("int")).withColumn("__island", F.sum(1 - F.col("__hit")).over(w))
    run = F.sum("__hit").over(Window.partitionBy(key, "__island").orderBy(order))
    return h.withColumn("streak", run).drop("__hit", "__island")


def claim_window(plan: DataFrame, key: str, order: str, pending: Column, slots: Column) -> DataFrame:
    """The first pending entries in plan order, as many as there are slots."""
    w = Window.partitionBy(key).orderBy(order)
    return plan.filter(pending).withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= slots)


def repeats_in_order(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """How often a row's key came before it: first accepted, second retried, later exhausted."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("long")
    verdict = F.when(place == 1, "accepted").when(place == 2, "retry").otherwise("exhausted")
    return rows.withColumns({"place": place, "verdict": verdict})


def top_k(rows: DataFrame, score: Column, tie: str, k: int) -> DataFrame:
    return rows.withColumn("hits", score).orderBy(F.desc("hits"), tie).limit(k)


def reallocate(spend: DataFrame, key: str, low: Column, amount: str) -> DataFrame:
    """Take the amount from low-yield rows and give the sum to the best other row (largest count, then key)."""
    marked = spend.withColumn("low", low)
    freed = F.sum(F.when(F.col("low"), F.col(amount)).otherwise(0)).over(Window.partitionBy(F.lit(0)))
    place = F.row_number().over(Window.orderBy(F.col("low"), F.desc(amount), key))  # one row per operator
    after = F.when(F.col("low"), F.lit(0)).when(place == 1, F.col(amount) + freed).otherwise(F.col(amount))
    return marked.select(key, F.col(amount).alias("before"), after.cast("long").alias("after"))
