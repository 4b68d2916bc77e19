"""Evidence checks, cards compiled from facts, gain gates and proposals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import clamp, first_match, reasons


def first_present(json: Column, paths: Sequence[str]) -> Column:
    """The value at the first path that exists, even if it is null there (an absent key is not a null one)."""
    keys = F.json_object_keys(json)
    out = None
    for p in paths:
        here, value = F.array_contains(keys, p), F.get_json_object(json, f"$.{p}")
        out = F.when(here, value) if out is None else out.when(here, value)
    return out


def missing_parts(**parts: Column) -> Column:
    """Names of the parts that are null or blank."""
    return reasons([(p.isNull() | (F.trim(p.cast("string")) == ""), name) for name, p in parts.items()])


def dangling(rows: DataFrame, key: str, used: str, known: str) -> DataFrame:
    """Ids that a record's evidence names but the record does not have."""
    lost = F.array_sort(F.array_except(used, known))
    return rows.select(key, F.array_join(lost, ",").alias("dangling"), (F.size(lost) == 0).alias("valid"))


def compiled_cards(facts: DataFrame, keys: Sequence[str], experiment: str, sample: str, increased: Column, least: int = 3) -> DataFrame:
    """Per group: distinct experiments and samples, share increased, and the status they earn."""
    g = facts.groupBy(*keys).agg(
        F.count("*").alias("facts"), F.count_distinct(experiment).alias("experiments"), F.count_distinct(sample).alias("samples"), F.round(F.avg(increased.cast("int")), 4).alias("increased")
    )
    few = (F.col("experiments") < 2) | (F.col("samples") < least)
    return g.withColumn("status", first_match([(few, "provisional"), (F.col("increased") >= 0.6, "active"), (F.col("increased") <= 0.4, "negative")], "mixed"))


def upserted_cards(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Insert, update with the next version, keep, or retire a card, by its key and content."""
    o, n = old.select(key, F.col(value).alias("__old"), F.col("version").alias("__v")), new.select(key, F.col(value).alias("__new"))
    gone, fresh = F.col("__new").isNull(), F.col("__old").isNull()
    same = F.col("__new") == F.col("__old")
    state = F.when(gone, "retired").when(fresh, "inserted").when(same, "kept").otherwise("updated")
    version = F.when(fresh, 1).when(gone | same, F.col("__v")).otherwise(F.col("__v") + 1)
    return o.join(n, key, "full_outer").select(key, version.cast("long").alias("version"), state.alias("state"))


def normalised_gain(rows: DataFrame, dimensions: dict[str, tuple[str, float]], hard: dict[str, float], passed: float = 0.75, borderline: float = 0.65) -> DataFrame:
    """A weighted sum over clamped dimensions; a hard minimum that is missed fails the row whatever the sum."""
    total = F.lit(0.0)
    for column, weight in dimensions.values():
        total = total + weight * clamp(F.col(column))
    below = reasons([(clamp(F.col(dimensions[d][0])) < m, d) for d, m in hard.items()])
    label = first_match([(F.size(below) > 0, "fail"), (F.col("gain") >= passed, "pass"), (F.col("gain") >= borderline, "borderline")], "fail")
    return rows.withColumn("gain", F.round(total, 6)).withColumns({"label": label, "below": F.array_join(below, ",")})


def gate(rows: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """All reject reasons in order; the first sets the type; rows without any pass."""
    r = reasons(checks)
    return rows.withColumns({"reject_type": F.get(r, F.lit(0)), "n_reasons": F.size(r).cast("long"), "passed": F.size(r) == 0})


def proposals(labelled: DataFrame, label: str, levels: dict[str, str]) -> DataFrame:
    """Labels folded into levels, with a strength by how often a level occurs."""
    level = F.coalesce(*[F.when(F.col(label) == k, F.lit(v)) for k, v in levels.items()], F.lit("none"))
    g = labelled.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.count_distinct(label).alias("labels"))
    return g.withColumn("strength", first_match([(F.col("n") >= 3, "strong"), (F.col("n") >= 2, "medium")], "weak"))


def projected(rows: DataFrame, allowed: Sequence[str], masked: Sequence[str]) -> DataFrame:
    """Allow-listed columns only; those with a secret's name are masked."""
    return rows.select(*[F.lit("***").alias(c) if any(m in c for m in masked) else F.col(c) for c in rows.columns if c in allowed])
