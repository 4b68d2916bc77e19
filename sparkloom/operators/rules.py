"""Ordered decision tables, eligibility and record checks, as chains of conditions.

A rule table is data: a list of (condition, result), first match wins; every operator is a
projection, so it adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    out = None
    for condition, result in rules:
        out = F.when(condition, F.lit(result)) if out is None else out.when(condition, F.lit(result))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def reasons(rules: Sequence[tuple[Column, str]]) -> Column:
    """All matching results, in the order of the rules."""
    return F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in rules]), lambda x: x.isNotNull())


def effect_labels(pairs: DataFrame, full: float = 0.99, drop: float = 0.15, review: float = 0.05, increase: float = 0.05) -> DataFrame:
    """Change between rounds, and its label; change is rounded to four places before it meets a threshold."""
    delta = F.round(F.col("after") - F.col("before"), 4)
    rules = [
        (F.col("before").isNull() | F.col("after").isNull(), "missing"),
        (F.col("after") >= full, "full"),
        (-delta >= drop, "dropped"),
        (-delta >= review, "slight_drop"),
        (delta >= increase, "increased"),
    ]
    return pairs.withColumns({"delta": delta, "label": first_match(rules, "flat")})


def admission(summary: DataFrame, high: float = 0.8, low: float = 0.6, wide: float = 0.4) -> DataFrame:
    """A class and a budget of extra trials from a trial summary, with the reasons for extra trials."""
    rules = [
        (F.col("low") >= 0.999, "stable_full"),
        (F.col("median") >= high, "stable_high"),
        (F.col("high") >= high, "unstable_high"),
        (F.col("spread") >= wide, "volatile"),
        (F.col("p75") >= low, "middle"),
    ]
    extra = reasons([(F.col("spread") >= wide, "wide"), ((F.col("n_high") > 0) & (F.col("median") < high), "split"), (F.col("n") < 3, "few")])
    budget = F.least(F.lit(2), F.size(extra))
    return summary.select("sample", first_match(rules, "low").alias("class"), F.concat_ws(",", extra).alias("extra_reasons"), budget.cast("long").alias("extra_trials"))


def five_way_action(rows: DataFrame, score: str, stopped: Column, high: float = 0.8, low: float = 0.6) -> DataFrame:
    """An action and its reason, from the stop flag and the score."""
    s = F.col(score)
    text = F.when(s.isNull(), "no score").otherwise(F.format_string("score=%.4f", s))
    rules = [(stopped, "stop"), (s.isNull(), "review"), (s >= high, "rewrite"), (s <= low, "keep")]
    return rows.withColumns({"action": first_match(rules, "retry"), "reason": text})


def candidate_flow(rows: DataFrame) -> DataFrame:
    """Which of four flows a candidate goes to; exploration flows have their score capped."""
    q, t, g = F.col("quality"), F.col("toxic"), F.col("gain")
    flow = first_match([(t == 1, "reject"), ((q == 1) & (g >= 40), "main"), (q == 1, "explore"), (g >= 60, "explore")], "fallback")
    return rows.withColumn("flow", flow)


def candidate_score(rows: DataFrame) -> DataFrame:
    """A weighted sum of gain and quality with penalties, cap for exploration, floor 0; rejected rows get a sentinel."""
    raw = 0.45 * F.col("gain") / 96 + 0.35 * F.col("quality") - 0.2 * F.col("toxic")
    capped = F.when(F.col("flow") == "explore", F.least(raw, F.lit(0.6))).otherwise(raw)
    score = F.when(F.col("flow") == "reject", F.lit(-1000.0)).otherwise(F.greatest(F.lit(0.0), F.round(capped, 8)))
    return rows.withColumn("score", score)


def clamp(x: Column, default: float = 0.0) -> Column:
    """x in [0, 1]; null and NaN become the default before Spark's ordering of NaN can matter."""
    return F.when(x.isNull() | F.isnan(x), F.lit(default)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)))


def in_unit(x: Column) -> Column:
    """x if it lies in [0, 1], else null."""
    return F.when(x.between(0.0, 1.0), x)


def resolved_rate(given: Column, awarded: Column, possible: Column, stable: Column, variant: str) -> Column:
    """The score rate of a record.

    strict: the given rate if in [0, 1], else the clamped ratio, else the stable score;
    loose: the ratio unclamped, else the given rate; stable_first: the stable score first;
    ratio: the clamped ratio only, null without possible points.
    """
    ratio = F.when(possible > 0, awarded / possible)
    clamped = F.when(ratio.isNotNull(), clamp(ratio))
    return {
        "strict": F.coalesce(in_unit(given), clamped, in_unit(stable)),
        "loose": F.coalesce(ratio, given),
        "stable_first": F.coalesce(in_unit(stable), in_unit(given), clamped),
        "ratio": clamped,
    }[variant]


def clean(x: Column) -> Column:
    """Text without Unicode white space at its ends; null is empty."""
    return F.coalesce(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""), F.lit(""))


def identity(*fields: Column, text: Column) -> Column:
    """The first non-blank id, else a prefix of the text's digest."""
    return F.coalesce(*[F.nullif(clean(f), F.lit("")) for f in fields], F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 16))


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """Whether any literal term is a substring; one pass per term, inside code generation."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


def validate(rows: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """The first failing path of every record, null if it is valid."""
    return rows.withColumn("invalid", F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(path)) for path, ok in checks]))


def scope_matches(wanted: Column, actual: Column, wildcard: str | None = None) -> Column:
    """A blank scope matches all, others ignoring case; with a wildcard, that word on either side, too."""
    match = wanted.isNull() | (wanted == "") | (F.lower(wanted) == F.lower(actual))
    if wildcard is not None:
        match = match | (wanted == wildcard) | actual.isNull() | (actual == "") | (actual == wildcard)
    return match


def with_snapshot(rows: DataFrame, fields: Sequence[str], replaced: dict[str, Column], version_of: str) -> DataFrame:
    """Replace fields, keep their old values in one struct, and stamp the version of the new text."""
    old = F.struct(*[F.col(f).alias(f) for f in fields])
    out = rows.withColumn("snapshot", old).withColumns(replaced)
    return out.withColumn("version", F.concat(F.lit("qv_"), F.substring(F.sha2(F.col(version_of), 256), 1, 16)))


def restored(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Put the snapshot's values back; a null in the snapshot deletes the live value."""
    has = F.col("snapshot").isNotNull()
    return rows.withColumns({f: F.when(has, F.col(f"snapshot.{f}")).otherwise(F.col(f)) for f in fields}).drop("snapshot", "version")


def version_mismatch(expected: Column, *versions: Column) -> Column:
    """Whether any version differs from the expected one; rows without an expected version are exempt."""
    bad = F.lit(False)
    for v in versions:
        bad = bad | ~expected.eqNullSafe(v)
    return expected.isNotNull() & bad


def branch_status(pairs: DataFrame) -> DataFrame:
    """A branch's status from child and parent rates, its change and its duration where that is not negative."""
    delta = F.round(F.col("child") - F.col("parent"), 4)
    rules = [(F.col("child").isNull() | F.col("parent").isNull(), "branch_error"), (delta < 0, "decreased"), (delta > 0, "increased")]
    return pairs.withColumns({"delta": delta, "status": first_match(rules, "unchanged"), "review": F.coalesce(F.abs(delta) < 0.02, F.lit(True))})


def reference_issues(text: Column, allowed: Column, forbidden: Sequence[str], cited: str = r"\[(\d+)\]") -> Column:
    """Issues of an answer: empty, forbidden words, no citation although ids exist, a citation outside them."""
    ids = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(cited), F.lit(1)))
    empty = clean(text) == ""
    return reasons(
        [
            (empty, "empty"),
            (contains_any(F.coalesce(text, F.lit("")), forbidden), "forbidden_word"),
            (~empty & (F.size(allowed) > 0) & (F.size(ids) == 0), "no_citation"),
            (F.size(F.array_except(ids, allowed)) > 0, "citation_outside"),
        ]
    )
