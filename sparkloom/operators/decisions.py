"""Decisions of a reviewing agent: the next action, budget proposals, observations, gain-gate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import first_match, reasons

#: (result, action, terminal reason, whether a person must look at it); the order is that of the rules.
ACTIONS = (
    ("manifest_corrupted", "blocked", "manifest_corrupted", True),
    ("fatal_failure", "blocked", "unrecoverable_tool_failure", True),
    ("retryable_failure", "suspend", "retryable_tool_failure", False),
    ("damaged", "blocked", "artifact_blocked", True),
    ("report_review", "stop_and_report", "manual_review_required", True),
    ("report_only", "stop_and_report", "review_completed", False),
    ("score_increased", "stop_and_report", "manual_review_required", True),
    ("not_applicable", "stop_and_report", "manual_review_required", True),
    ("replan", "replan", None, False),
    ("budget_exhausted", "stop_and_report", "budget_exhausted", False),
    ("target_reached", "stop_and_report", "manual_review_required", True),
    ("no_pending_review", "stop_and_report", "manual_review_required", True),
    ("no_pending", "stop_and_report", "no_pending_branches", False),
    ("otherwise", "stop_and_report", "manual_review_required", True),
)


def next_action(rows: DataFrame) -> DataFrame:
    """rows with cause, action, terminal_reason and needs_person, by the first rule that holds.

    rows have the booleans manifest_corrupted, fatal_failure, retryable_failure, damaged,
    report_only, has_evidence, replan, budget_exhausted, target_reached and the counts
    score_increased, not_applicable, boundary_candidates, pending.
    """
    c = F.col
    cause = first_match(
        [
            (c("manifest_corrupted"), "manifest_corrupted"),
            (c("fatal_failure"), "fatal_failure"),
            (c("retryable_failure"), "retryable_failure"),
            (c("damaged"), "damaged"),
            (c("report_only") & c("has_evidence"), "report_review"),
            (c("report_only"), "report_only"),
            (c("score_increased") > 0, "score_increased"),
            (c("not_applicable") > 0, "not_applicable"),
            (c("replan"), "replan"),
            (c("budget_exhausted"), "budget_exhausted"),
            (c("target_reached"), "target_reached"),
            ((c("pending") == 0) & (c("boundary_candidates") > 0), "no_pending_review"),
            (c("pending") == 0, "no_pending"),
        ],
        "otherwise",
    )
    entry = lambda i: F.create_map(*[F.lit(x) for a in ACTIONS for x in (a[0], a[i])])
    df = rows.withColumn("cause", cause)
    return df.withColumns({"action": entry(1)[c("cause")], "terminal_reason": entry(2)[c("cause")], "needs_person": entry(3)[c("cause")]})


BUDGET_KINDS = ("generation", "scoring", "repeat_scoring", "vertical_depth")
PROTECTED = ("search_state", "operator_plan", "vertical_search_state", "memory", "score_rate")


def budget_decisions(changes: DataFrame, ledger: DataFrame, eligible: DataFrame, kinds: Sequence[str] = BUDGET_KINDS) -> DataFrame:
    """(proposal, status, rejections, reviews): whether a proposal to move budget may be carried out.

    changes: proposal, idx, target, kind, action, before, after, evidence, operator_gained, required;
    ledger: kind, target, remaining (what is allocated now); eligible: target (candidates that
    passed validation).  A change must name a configured kind and target outside the protected
    state, state the remaining allocation as it is, and raise or lower it as it says; scoring may
    not be added to candidates that did not pass nor taken where it is required, nor any budget be
    added to an operator whose scores rose.  The sum of every kind must stay the same, and an
    operator must be left with budget.  A change without evidence needs a person.
    """
    now = ledger.groupBy("kind", "target").agg(F.sum("remaining").alias("remaining"))
    c = F.col
    j = changes.join(now, ["kind", "target"], "left").join(eligible.select("target", F.lit(True).alias("__ok")).distinct(), "target", "left")
    protected = F.lit(False)
    for m in PROTECTED:
        protected = protected | F.contains(F.lower("target"), F.lit(m))
    configured = c("kind").isin(*kinds) & (F.coalesce("target", F.lit("")) != "")
    amounts = c("action").isin("increase", "reduce") & (c("before") >= 0) & (c("after") >= 0)
    held = F.coalesce("remaining", F.lit(0.0))
    up, down = c("action") == "increase", c("action") == "reduce"
    hard = reasons(
        [
            (~F.coalesce(configured, F.lit(False)), "unconfigured_target_or_kind"),
            (protected, "targets_protected_state"),
            (~F.coalesce(amounts, F.lit(False)), "invalid_action_or_amount"),
            (amounts & (F.abs(held - c("before")) > 1e-9), "does_not_match_remaining"),
            (amounts & up & (c("after") <= c("before")), "increase_must_raise"),
            (amounts & down & (c("after") >= c("before")), "reduce_must_lower"),
            (amounts & up & c("operator_gained"), "continues_score_increased_path"),
            (amounts & up & c("kind").isin("scoring", "repeat_scoring") & c("__ok").isNull(), "adds_scoring_to_unvalidated"),
            (amounts & down & (c("kind") == "scoring") & c("required"), "removes_required_scoring"),
        ]
    )
    # A change that names nothing configured, or no amount, moves nothing; of several for a target the last holds.
    moves = configured & amounts
    j = j.withColumns({"__hard": F.when(~F.coalesce(configured, F.lit(False)), F.array(F.lit("unconfigured_target_or_kind"))).otherwise(hard), "__moves": F.coalesce(moves, F.lit(False))})
    delta = j.filter("__moves").groupBy("proposal", "kind", "target").agg(F.max_by("after", "idx").alias("after"), F.first(held).alias("was"))
    sums = delta.groupBy("proposal", "kind").agg(F.sum(c("after") - c("was")).alias("moved")).groupBy("proposal").agg(F.sort_array(F.collect_list(F.when(F.abs("moved") > 1e-9, F.concat(F.lit("not_conserved_"), "kind")))).alias("__sums"))
    is_operator = c("target").startswith("operator:")
    funded = now.filter(is_operator).agg(F.count_if(c("remaining") > 0).alias("__funded"), F.count("*").alias("__allocated"))
    lost = delta.filter(is_operator).groupBy("proposal").agg(F.sum((c("after") > 0).cast("int") - (c("was") > 0).cast("int")).alias("__change"))
    per = j.groupBy("proposal").agg(
        F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("idx", "__hard"))), lambda x: x["__hard"]))).alias("__hard"),
        F.max(c("__moves") & ~c("evidence")).alias("__bare"),
    )
    per = per.join(sums, "proposal", "left").join(lost, "proposal", "left").join(F.broadcast(funded), F.lit(True))  # funded is one row
    none = F.expr("cast(array() AS array<string>)")
    hard = F.concat("__hard", F.coalesce("__sums", none))
    review = reasons([(F.coalesce("__bare", F.lit(False)), "no_evidence"), ((c("__allocated") > 0) & (c("__funded") + F.coalesce("__change", F.lit(0)) <= 0), "eliminates_all_operators")])
    status = F.when(F.size("rejections") > 0, "rejected").when(F.size("reviews") > 0, "needs_human_review").otherwise("approved")
    return per.select("proposal", hard.alias("rejections"), review.alias("reviews")).withColumn("status", status)


#: kind: (severity, recommended actions, asks for a new plan, for a person)
OBSERVATIONS = {
    "score_decreased": ("info", "report", False, False),
    "score_unchanged": ("info", "report", True, False),
    "score_increased": ("warning", "report,manual_review", False, True),
    "not_applicable": ("warning", "report", False, False),
    "candidate_invalid": ("warning", "report", False, False),
    "boundary_candidate_found": ("info", "report", False, False),
}


def observations(rows: DataFrame, key: str, exhausted: Column, manifest: Column) -> DataFrame:
    """(key, kind, count, severity, actions, replan, person): a row per non-zero count of OBSERVATIONS, one for an exhausted budget
    and one for a manifest that is 'damaged' or has parts 'missing'; a row pipeline_completed where there is nothing else."""
    made = lambda kind, n, severity, actions, replan, person: F.struct(F.lit(kind).alias("kind"), n.cast("long").alias("count"), F.lit(severity).alias("severity"), F.lit(actions).alias("actions"), F.lit(replan).alias("replan"), F.lit(person).alias("person"))
    none = F.lit(None)
    found = [F.when(F.col(k) > 0, made(k, F.col(k), *v)) for k, v in OBSERVATIONS.items()]
    found.append(F.when(exhausted, made("budget_warning", none, "warning", "stop_and_report", False, False)))
    found.append(F.when(manifest == "damaged", made("manifest_corrupted", none, "error", "block_and_report", False, True)).when(manifest == "missing", made("artifact_missing", none, "warning", "report", False, False)))
    df = rows.withColumn("__o", F.array_compact(F.array(*found)))
    fallback = F.array(made("pipeline_completed", none, "info", "", False, False))
    return df.select(key, F.explode(F.when(F.size("__o") > 0, F.col("__o")).otherwise(fallback)).alias("o")).select(key, "o.*")


DIMENSIONS = ("axis_consistency", "no_leakage", "competitive_judgment", "anti_clarity_trap", "answerability", "format_complexity")


def gain_gate_rows(rows: DataFrame, evolved: Column, error: Column, label: Column, passed: Column, scores: dict[str, Column]) -> DataFrame:
    """rows with gate_label, gate_passed, one score per dimension and, for what failed, retry_strategy.

    What was not rewritten passes with all ones; an error of the validator gives zeros and asks for
    a person; other rows keep their label and scores.
    """
    failed = F.coalesce(error != "", F.lit(False))
    gate_label = F.when(~evolved, "not_applicable").when(failed, "needs_manual_review").otherwise(label)
    gate_passed = F.when(~evolved, True).when(failed, False).otherwise(passed)
    each = {d: F.when(~evolved, 1.0).when(failed, 0.0).otherwise(scores[d]) for d in DIMENSIONS}
    df = rows.withColumns({"gate_label": gate_label, "gate_passed": gate_passed, **each})
    strategy = F.when(F.col("gate_label").isin("leakage_or_simplification", "axis_shift"), "switch_operator_family").otherwise("retry_with_backup_operator")
    return df.withColumn("retry_strategy", F.when(~F.col("gate_passed"), strategy))
