"""Routes and rankings of rewrite operators: list algebra over a handful of names per record.

Lists are bounded by the registry of operators, so they stay arrays of a row; every function is a
projection but for the joins with statistics, which are one row per operator and value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(x: Column) -> Column:
    """The list without repetitions and nulls, in order of first appearance."""
    return F.array_distinct(F.array_compact(x))


def without(x: Column, gone: Column) -> Column:
    return F.filter(x, lambda v: ~F.array_contains(gone, v))


INEFFECTIVE = ("full_score_no_drop", "no_clear_effect", "needs_manual_review", "repeated_pattern", "score_increased")
REROUTES = ("continue_with_new_operator", "local_tree_search_needed", "rollback_and_reroute")


def build_routes(rows: DataFrame, rules: Sequence[tuple[Column, Sequence[str]]], default: Sequence[str], modes: Mapping[str, Sequence[str]], missing_slot: Mapping[str, Column]) -> DataFrame:
    """The route of every record.

    rules are keyword rules, first match wins; each gives a primary operator and its backups.
    rows have memory_operator, previous_operator, previous_effect, stop_status, full_score,
    recommended (a list), mode, high_value and full_rounds.  Memory promotes its operator over the
    primary, which becomes the last backup; the previous operator is avoided where it had no effect
    or a reroute was asked for; recommended operators come first; operators whose contract does not
    support the mode, or whose authoritative slot is missing, are excluded with that reason.
    Adds primary, backups, avoid, excluded ('operator=reason'), no_safe_operator, tree_search.
    """
    names = lambda x: F.array(*[F.lit(n) for n in x])
    base = names(default)
    for condition, found in reversed(rules):
        base = F.when(condition, names(found)).otherwise(base)
    df = rows.withColumn("__base", base)
    memory = F.col("memory_operator")
    promoted = F.concat(F.array(memory), F.slice("__base", 2, 99), F.slice("__base", 1, 1))
    df = df.withColumn("__list", F.when(memory.isNotNull(), unique(promoted)).otherwise(F.col("__base")))
    blocked = F.col("full_score") | F.col("previous_effect").isin(*INEFFECTIVE) | F.col("stop_status").isin(*REROUTES)
    df = df.withColumn("avoid", F.when(F.col("previous_operator").isNotNull() & F.coalesce(blocked, F.lit(False)), F.array("previous_operator")).otherwise(F.expr("cast(array() AS array<string>)")))
    df = df.withColumn("__list", without(unique(F.concat(F.coalesce("recommended", F.expr("cast(array() AS array<string>)")), F.col("__list"))), F.col("avoid")))
    known = sorted(modes)
    why = F.lit(None).cast("string")
    supported, slot = F.lit(False), F.lit(False)

    def reason(op: Column) -> Column:
        nonlocal why
        out = F.lit(None).cast("string")
        for name in known:
            gone = F.when(~F.col("mode").isin(*modes[name]), "mode_not_supported")
            if name in missing_slot:
                gone = gone.when(missing_slot[name], "authoritative_slot_missing")
            out = F.when(op == name, gone).otherwise(out)
        return out

    df = df.withColumn("__why", F.transform("__list", lambda op: F.struct(op.alias("op"), reason(op).alias("why"))))
    safe = F.transform(F.filter("__why", lambda x: x["why"].isNull()), lambda x: x["op"])
    excluded = F.transform(F.filter("__why", lambda x: x["why"].isNotNull()), lambda x: F.concat(x["op"], F.lit("="), x["why"]))
    df = df.withColumns({"__safe": safe, "excluded": excluded})
    return df.withColumns(
        {
            "primary": F.get("__safe", F.lit(0)),
            "backups": F.slice("__safe", 2, 99),
            "no_safe_operator": F.size("__safe") == 0,
            "tree_search": F.col("high_value") | (F.col("full_rounds") >= 2),
        }
    ).drop("__base", "__list", "__why", "__safe")


def yield_score(hits: Column, attempts: Column, errors: Column, seconds: Column, explore: float) -> Column:
    """Smoothed hit rate (a uniform prior) with an exploration bonus, less errors, per second."""
    bonus = F.lit(float(explore)) / F.sqrt(attempts + 1)
    rate = F.least(F.lit(1.0), F.greatest(F.lit(0.0), errors))
    return ((hits + 1) / (attempts + 2) + bonus) * (1 - rate) / F.greatest(F.lit(1e-6), seconds)


def matching_stats(wanted: DataFrame, grouped: DataFrame, overall: DataFrame) -> DataFrame:
    """Statistics for (grp, operator): of the group rows that match the one with the most attempts, else the operator's overall row.

    grouped: grp, operator, attempts, hits, errors, seconds; overall: the same without grp.
    """
    figures = ["attempts", "hits", "errors", "seconds"]
    best = grouped.groupBy("grp", "operator").agg(F.max_by(F.struct(*figures), "attempts").alias("__own"))
    rest = overall.select("operator", F.struct(*figures).alias("__all"))
    joined = wanted.join(best, ["grp", "operator"], "left").join(rest, "operator", "left").withColumn("__s", F.coalesce("__own", "__all"))
    zero = {"attempts": F.lit(0), "hits": F.lit(0), "errors": F.lit(0.0), "seconds": F.lit(1.0)}
    return joined.select(*wanted.columns, *[F.coalesce(F.col(f"__s.{c}"), zero[c]).alias(c) for c in figures])


def rank_operators(stats: DataFrame, explore: float = 0.1) -> DataFrame:
    """(grp, ranked): a group's operators, the protected ones first, the others by yield, with periodic exploration.

    stats: grp, operator, place (order of selection), protected (order among the protected, else
    null), attempts, hits, errors, seconds.  Of the unprotected, every round(1/explore)-th position
    takes the least tried operator that is left, all others the one with the best score; ties go
    to the earlier place.
    """
    period = max(1, round(1 / explore)) if explore > 0 else 0
    score = yield_score(F.col("hits"), F.col("attempts"), F.col("errors"), F.col("seconds"), max(0.0, explore))
    s = stats.withColumn("__score", score)
    free = F.col("protected").isNull()
    in_order = lambda *keys: F.transform(F.sort_array(F.collect_list(F.when(free, F.struct(*keys, "operator")))), lambda x: x["operator"])
    g = s.groupBy("grp").agg(
        F.transform(F.sort_array(F.collect_list(F.when(~free, F.struct("protected", "operator")))), lambda x: x["operator"]).alias("__first"),
        in_order((-F.col("__score")).alias("s"), "place").alias("__by_score"),
        in_order("attempts", "place").alias("__by_tries"),
    )
    turn = f"IF(p % {period} = 0, __by_tries, __by_score)" if period else "__by_score"
    pick = f"get(filter({turn}, o -> NOT array_contains(ranked, o)), 0)"
    order = f"aggregate(filter(sequence(1, size(__by_score) + 1), p -> p <= size(__by_score)), cast(array() AS array<string>), (ranked, p) -> array_append(ranked, {pick}))"
    return g.select("grp", F.concat(F.col("__first"), F.expr(order)).alias("ranked"))
