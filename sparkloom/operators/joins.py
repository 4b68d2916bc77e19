"""Joins of records with earlier rounds, memories, reviews and routes.

Theta joins are rewritten as equi-joins plus a filter, so no plan holds a nested loop over
two large sides; sides are deduplicated before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per non-blank key: the last in the order.  An aggregation with map-side partials, no sort."""
    rest = [c for c in rows.columns if c not in (key, order)]
    kept = rows.filter(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    g = kept.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__last")) if rest else kept.groupBy(key).agg(F.max(order).alias(order))
    return g.select(key, *[F.col(f"__last.{c}").alias(c) for c in rest]) if rest else g


def before_after(now: DataFrame, before: DataFrame, key: str, order: str) -> DataFrame:
    """Left join of the current rows to the last earlier row of their key."""
    return now.join(last_wins(before, key, order), key, "left")


def aligned(left: DataFrame, right: DataFrame, keys: Sequence[str], title: str) -> DataFrame:
    """Full outer join on a canonical title (case, quotes and white space folded); both sides mark what has no partner."""
    canonical = F.lower(F.trim(F.regexp_replace(F.translate(F.col(title), "“”‘’", "\"\"''"), r"(?U)\s+", " ")))
    a = left.withColumn("__title", canonical).withColumnRenamed(title, "left_title")
    b = right.withColumn("__title", canonical).withColumnRenamed(title, "right_title")
    return a.join(b, [*keys, "__title"], "full_outer").drop("__title")


def signature_similarity(rows: DataFrame, memory: DataFrame, fields: Sequence[str], least: float = 0.75) -> DataFrame:
    """Pairs whose share of equal fields, of those non-blank on both sides, is at least so much.

    Two rows that share so many fields agree on some pair of them when there are four fields
    and three must match, so pairs of fields (not single, low-cardinality ones) are joined on.
    """
    need = -(-int(least * 100) * len(fields) // 100)
    width = max(1, len(fields) - 2) if need >= len(fields) - 1 else 1

    def keyed(df: DataFrame, row: str) -> DataFrame:
        from itertools import combinations

        keys = [F.when(F.concat(*[F.col(f) for f in c]).isNotNull(), F.xxhash64(F.lit(i), *c)) for i, c in enumerate(combinations(fields, width))]
        return df.select(F.col("id").alias(row), F.struct(*fields).alias(f"{row}_sig"), F.explode(F.array_compact(F.array(*keys))).alias("k"))

    pairs = keyed(rows, "a").join(keyed(memory, "b"), "k").select("a", "b", "a_sig", "b_sig").distinct()
    both = [F.col(f"a_sig.{f}").isNotNull() & F.col(f"b_sig.{f}").isNotNull() for f in fields]
    same = [(F.col(f"a_sig.{f}") == F.col(f"b_sig.{f}")) & b for f, b in zip(fields, both)]
    total = lambda cs: sum((F.coalesce(c, F.lit(False)).cast("int") for c in cs[1:]), F.coalesce(cs[0], F.lit(False)).cast("int"))
    share = F.try_divide(total(same), total(both))
    return pairs.select("a", "b", share.alias("share")).filter(F.col("share") >= least)


def recent_failures(rows: DataFrame, log: DataFrame, keys: Sequence[str], span: int) -> DataFrame:
    """Failures of the same keys within the last `span` rounds, and what the count asks for; a null round passes."""
    near = F.col("round").isNull() | F.col("now").isNull() | ((F.col("now") - F.col("round")).between(0, span))
    joined = rows.join(log, list(keys)).filter(near)
    g = joined.groupBy("id").agg(F.count("*").alias("failures"))
    advice = F.when(F.col("failures") >= 3, "avoid").when(F.col("failures") == 2, "downrank").otherwise("warn")
    return g.withColumn("advice", advice)


def holdout(effects: DataFrame, candidates: DataFrame, operator: str, root: str) -> DataFrame:
    """Effects whose operator a candidate lists and whose root is not among the candidate's sources.

    candidates: candidate, operators (array), roots (array).
    """
    ops = candidates.select("candidate", F.explode(F.array_distinct("operators")).alias(operator))
    own = candidates.select("candidate", F.explode(F.array_distinct("roots")).alias(root))
    return effects.join(ops, operator).join(own, ["candidate", root], "left_anti")


def induced(rows: DataFrame, keys: Sequence[str], scope: Sequence[str], label: str, root: str, least_roots: int = 2) -> DataFrame:
    """Groups by keys and label with enough distinct roots and a counterexample (another label in the same scope)."""
    g = rows.groupBy(*keys, label).agg(F.count("*").alias("support"), F.count_distinct(root).alias("roots"))
    s = rows.groupBy(*scope).agg(F.count("*").alias("scope_rows"))
    own = rows.groupBy(*scope, label).agg(F.count("*").alias("own_rows"))
    j = g.join(s, list(scope)).join(own, [*scope, label])
    against = F.col("scope_rows") - F.col("own_rows")
    accepted = (F.col("roots") >= least_roots) & (against >= 1)
    return j.select(*keys, label, "support", "roots", against.alias("counterexamples"), accepted.alias("accepted"))


def wildcard_join(routes: DataFrame, cards: DataFrame, scope: str) -> DataFrame:
    """Routes with the cards of their scope or of every scope: an equi-join and a union instead of a nested loop."""
    blank = F.col(scope).isNull() | (F.col(scope) == "")
    exact = routes.join(cards.filter(~blank), scope)
    anywhere = cards.filter(blank).drop(scope).withColumn("__any", F.lit(1))
    # Cards without a scope are few and all routes get all of them: joined on a constant, as an array of one row.
    listed = anywhere.groupBy("__any").agg(F.collect_list(F.struct(*[c for c in anywhere.columns if c != "__any"])).alias("__cards"))
    every = routes.withColumn("__any", F.lit(1)).join(listed, "__any").withColumn("__card", F.explode("__cards"))
    names = [c for c in cards.columns if c != scope]
    every = every.select(*routes.columns, *[F.col(f"__card.{c}").alias(c) for c in names])
    return exact.select(*routes.columns, *names).unionByName(every)


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("only", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("only", F.lit("right")))


def conflicts(rows: DataFrame, frozen: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Rows that differ from their frozen counterpart in any field, nulls equal to nulls."""
    f = frozen.select(key, *[F.col(c).alias(f"__f_{c}") for c in fields])
    bad: Column = F.lit(False)
    for c in fields:
        bad = bad | ~F.col(c).eqNullSafe(F.col(f"__f_{c}"))
    return rows.join(f, key).filter(bad).select(*rows.columns)


def cached_or_fallback(requests: DataFrame, cache: DataFrame, key: str, fallback: Column) -> DataFrame:
    """Requests answered from the cache's last success, else by the deterministic fallback."""
    return requests.join(cache.withColumnRenamed("answer", "__hit"), key, "left").select(
        *requests.columns, F.coalesce("__hit", fallback).alias("answer"), F.when(F.col("__hit").isNull(), "fallback").otherwise("cache").alias("answered_by")
    )
