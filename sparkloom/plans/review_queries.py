"""Whole operators over the driver's tables: contracts, facts, leaks, routes, rankings, decisions, search state, artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import facts
from ..operators import decisions, routing, schema, search_state, stats
from ..sources import manifest
from ..sources.scratch import shared_path
from .catalog import query
from .tables import table

# F8

EVENT_SCHEMA = {
    "type": "object",
    "required": ["id", "kind"],
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "kind": {"type": "string", "enum": ["view", "click", "purchase", "login"]},
        "score": {"type": ["number", "null"], "minimum": 0, "maximum": 20},
        "tags": {"type": "array", "items": {"$ref": "tag"}},
        "props": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 89}}},
    },
}
EVENT_REFS = {"tag": {"type": "string", "minLength": 2}}
_JSON = """concat('{{"id": ', CASE WHEN event_id % 17 = 0 THEN 'true' ELSE cast(event_id AS {string}) END, CASE WHEN event_id % 13 = 0 THEN '' ELSE concat(', "kind": "', event_type, '"') END,
  ', "score": ', CASE WHEN event_id % 11 = 0 THEN 'null' ELSE cast(event_id % 23 AS {string}) END, ', "tags": ["ab", ', CASE event_id % 19 WHEN 0 THEN '5' WHEN 1 THEN '"x"' ELSE '"xyz"' END, ']',
  ', "props": {{', CASE WHEN event_id % 29 = 0 THEN '' ELSE concat('"k": ', cast(event_id % 97 AS {string})) END, '}}, "more": 1', CASE WHEN event_id % 31 = 0 THEN '' ELSE '}}' END)"""


@query("f8_schema_validation", """SELECT event_id, CASE WHEN event_id % 31 = 0 THEN '$ parse' WHEN event_id % 13 = 0 THEN '$.kind required' WHEN event_id % 17 = 0 THEN '$.id type'
  WHEN event_type NOT IN ('view', 'click', 'purchase', 'login') THEN '$.kind enum' WHEN event_id % 11 <> 0 AND event_id % 23 > 20 THEN '$.score maximum'
  WHEN event_id % 19 = 0 THEN '$.tags[1] type' WHEN event_id % 19 = 1 THEN '$.tags[1] minLength' WHEN event_id % 29 = 0 THEN '$.props.k required' WHEN event_id % 97 > 89 THEN '$.props.k maximum' END AS invalid FROM events""")
def schema_validation(spark, d):
    rows = table(spark, d, "events").select("event_id", F.expr(_JSON.format(string="string")).alias("j"))
    return schema.validate_json(rows, "j", EVENT_SCHEMA, EVENT_REFS).select("event_id", "invalid")


# X3, X4

_OLD = """concat('“', o_orderstatus, 'x”支付', o_orderkey % 50, '元。', CASE WHEN o_orderkey % 3 = 0 THEN '不得转让合同，' ELSE '' END, CASE WHEN o_orderkey % 4 = 0 THEN '是否成立？' ELSE '' END)"""
_NEW = """concat('“', CASE WHEN o_orderkey % 5 = 0 THEN 'Zx' ELSE concat(o_orderstatus, 'x') END, '”支付', CASE WHEN o_orderkey % 7 = 0 THEN 51 ELSE o_orderkey % 50 END, ' 元。',
  CASE WHEN o_orderkey % 9 = 0 THEN '可以 转让合同，' WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN '不得转让合同，' ELSE '' END, CASE WHEN o_orderkey % 8 = 0 THEN '已查明。' ELSE '' END,
  CASE WHEN o_orderkey % 11 = 0 THEN '仅限本案。' ELSE '' END)"""


@query("x3_fact_diff", """WITH t AS (SELECT o_orderkey AS k, o_orderstatus || 'x' AS entity FROM orders),
f AS (SELECT k, list_filter([CASE WHEN k % 7 = 0 THEN 'numeric_fact_added_or_conflicted' END, CASE WHEN k % 5 = 0 THEN 'explicit_entity_replaced' END, CASE WHEN k % 9 = 0 THEN 'text_level_reversal' END,
  CASE WHEN k % 8 = 0 THEN 'new_deterministic_evidence_result' END], lambda x: x IS NOT NULL) AS fatal,
  list_filter([CASE WHEN k % 11 = 0 THEN 'scenario_narrowing_warning' END,
  CASE WHEN k % 3 = 0 AND NOT (k % 9 <> 0 AND k % 2 = 0) AND k % 11 <> 0 THEN 'deleted_key_restriction_warning' END], lambda x: x IS NOT NULL) AS warnings, entity FROM t)
SELECT k AS o_orderkey, array_to_string(fatal, ',') AS fatal, array_to_string(warnings, ',') AS warnings, len(fatal) = 0 AS passed, CASE WHEN k % 7 = 0 THEN '51元' ELSE '' END AS added_numbers,
  CASE WHEN k % 5 = 0 THEN entity ELSE '' END AS removed FROM f""")
def fact_diff(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.expr(_OLD).alias("old"), F.expr(_NEW).alias("new"))
    r = facts.fact_check(rows, "old", "new")
    joined = lambda c: F.array_join(c, ",")
    return r.select("o_orderkey", joined("fatal").alias("fatal"), joined("warnings").alias("warnings"), "passed", joined("added_numbers").alias("added_numbers"), joined("removed_entities").alias("removed"))


_LEAKY = """concat(p_name, '。\n', CASE WHEN p_partkey % 2 = 0 THEN 'A. 初步结果\n' ELSE 'A. 普通结果\n' END, CASE WHEN p_partkey % 3 = 0 THEN 'B. 已查明\n' ELSE 'B. 线索\n' END,
  CASE WHEN p_partkey % 5 = 0 THEN '请说明结论边界和评分标准。' ELSE '' END, CASE WHEN p_partkey % 7 = 0 THEN '这是一个很长的重复的句子内容。这是一个 很长的重复的句子内容！' ELSE '' END, CASE WHEN p_partkey % 11 = 0 THEN '由此可知' ELSE '' END)"""


@query("x4_surface_leaks", """WITH t AS (SELECT p_partkey AS k FROM part),
l AS (SELECT k, list_filter([CASE WHEN k % 5 = 0 THEN 'boundary_language_leak' END, CASE WHEN k % 5 = 0 THEN 'rubric_axis_leak' END, CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN 'safe_option_leak' END], lambda x: x IS NOT NULL) AS types FROM t)
SELECT k AS p_partkey, array_to_string(types, ',') AS leak_types, (2 * (k % 5 = 0)::INT + (k % 2 = 0 AND k % 3 = 0)::INT)::BIGINT AS n_evidence, CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN 'safe_option_leak:A. 初步结果' END AS option,
  array_to_string(list_filter([CASE WHEN k % 7 = 0 THEN 'semantic_redundancy' END, CASE WHEN k % 7 = 0 THEN 'shared_context_repeated' END, CASE WHEN k % 11 = 0 THEN 'answer_hint_expansion' END, CASE WHEN len(types) > 0 THEN 'surface_leak' END], lambda x: x IS NOT NULL), ',') AS failures FROM l""")
def surface_leaks(spark, d):
    r = facts.leaks(table(spark, d, "part").select("p_partkey", F.expr(_LEAKY).alias("text")), "text")
    option = F.get(F.filter("leak_evidence", lambda x: x.startswith("safe_option_leak")), F.lit(0))
    return r.select("p_partkey", F.array_join("leak_types", ",").alias("leak_types"), F.size("leak_evidence").cast("long").alias("n_evidence"), option.alias("option"), F.array_join("failures", ",").alias("failures"))


# A1

_EFFECT = """nullif(concat('c', user_id % 3), 'c1') AS core_capability, concat('o', user_id % 2) AS overscore_cause, concat('f', day(ts) % 2) AS failure_mode, event_type AS operator,
  CASE WHEN event_id % 21 <> 5 THEN (event_id % 21 - 10) / 100.0{d} END AS delta, CASE WHEN event_id % 4 = 0 THEN 'effective_boundary_probe' ELSE 'flat' END AS effect_label, nullif(event_id % 6, 3) <> 0 AS complexity_passed,
  CASE event_id % 9 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS risk, CASE event_id % 14 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' WHEN 2 THEN ' ' END AS review_status,
  CASE WHEN event_id % 15 <> 0 THEN event_id % 40 END AS char_delta, nullif(event_id % 3, 1) = 0 AS boundary_hit, event_id % 5 = 0 AS score_increased, event_id % 7 = 0 AS is_full_score, event_id % 8 = 0 AS repeated_pattern,
  event_id % 10 = 0 AS redundancy, event_id % 11 = 0 AS repeated_context, event_id % 12 = 0 AS answer_hint, event_id % 13 = 0 AS surface_leak"""


@query("a1_effect_matrix", f"""WITH e AS (SELECT event_id, coalesce(core_capability, '') AS core_capability, * EXCLUDE (event_id, core_capability) FROM (SELECT event_id, {_EFFECT.format(d='::DOUBLE')} FROM events)),
g AS (SELECT core_capability, overscore_cause, failure_mode, operator, count(*) AS n, round(avg(coalesce(delta, 0)), 6) AS mean_delta, count(*) FILTER (boundary_hit) AS boundary_hits, round(count(*) FILTER (boundary_hit) / count(*), 6) AS hit_rate,
  count(*) FILTER (score_increased) AS score_increases, count(*) FILTER (is_full_score) AS full_scores, count(*) FILTER (repeated_pattern) AS repeated_patterns, count(*) FILTER (redundancy) AS redundancies,
  count(*) FILTER (repeated_context) AS repeated_contexts, count(*) FILTER (answer_hint) AS answer_hints, count(*) FILTER (surface_leak) AS surface_leaks, count(*) FILTER (effect_label = 'effective_boundary_probe') AS effective_probes,
  count(*) FILTER (NOT coalesce(complexity_passed, false)) AS invalid_complexities, count(*) FILTER (risk IN ('medium', 'high')) AS semantic_risks, round(avg(char_delta), 6) AS mean_char_delta,
  count(*) FILTER (surface_leak) AS leak_a, count(*) FILTER (event_id % 26 = 0) AS leak_b, count(*) FILTER (event_id % 14 = 0) AS r1, count(*) FILTER (event_id % 14 = 1) AS r2, count(*) FILTER (event_id % 14 > 1) AS r0 FROM e GROUP BY ALL)
SELECT * EXCLUDE (leak_a, leak_b, r0, r1, r2), array_to_string(list_filter([CASE WHEN leak_a > 0 THEN 'axis:' || leak_a END, CASE WHEN leak_b > 0 THEN 'path:' || leak_b END], lambda x: x IS NOT NULL), ',') AS leak_type_counts,
  array_to_string(list_filter([CASE WHEN r1 > 0 THEN 'approved:' || r1 END, CASE WHEN r0 > 0 THEN 'not_reviewed:' || r0 END, CASE WHEN r2 > 0 THEN 'rejected:' || r2 END], lambda x: x IS NOT NULL), ',') AS review_counts FROM g""")
def effect_matrix(spark, d):
    e = table(spark, d, "events").selectExpr("event_id", *_split(_EFFECT.format(d="D")))
    types = F.when(F.col("surface_leak"), F.when(F.col("event_id") % 26 == 0, F.array(F.lit("axis"), F.lit("path"))).otherwise(F.array(F.lit("axis"))))
    m = stats.full_effect_matrix(e.withColumn("leak_types", types))
    return m.withColumns({c: F.round(c, 6) for c in ("mean_delta", "hit_rate", "mean_char_delta")})


# D9, W10

_MODES = {"secrets": ("en", "de", "fr", "es"), "contacts": ("en", "de"), "tables": ("en", "fr"), "prose": ("en", "de", "es")}
_INPUTS = """doc_id, text, CASE WHEN doc_id % 7 = 0 THEN 'tables' WHEN doc_id % 11 = 0 THEN 'secrets' END AS memory_operator, CASE WHEN doc_id % 3 = 0 THEN 'contacts' WHEN doc_id % 3 = 1 THEN 'prose' END AS previous_operator,
  CASE WHEN doc_id % 4 = 0 THEN 'no_clear_effect' ELSE 'effective' END AS previous_effect, CASE WHEN doc_id % 9 = 0 THEN 'rollback_and_reroute' ELSE '' END AS stop_status, doc_id % 13 = 0 AS full_score, lang AS mode, source IS NULL AS no_source,
  doc_id % 17 = 0 AS high_value, doc_id % 4 AS full_rounds"""


@query("d9_rule_route", f"""WITH i AS (SELECT {_INPUTS}, CASE WHEN doc_id % 5 = 0 THEN ['prose', 'contacts'] ELSE []::VARCHAR[] END AS recommended,
  CASE WHEN contains(text, 'token') THEN ['secrets', 'contacts', 'tables'] WHEN contains(text, '@') THEN ['contacts', 'secrets'] WHEN contains(text, ' | ') THEN ['tables', 'contacts'] ELSE ['prose', 'tables'] END AS base FROM documents),
m AS (SELECT *, recommended || CASE WHEN memory_operator IS NULL THEN base ELSE [memory_operator] || base[2:] || base[1:1] END AS l,
  CASE WHEN previous_operator IS NOT NULL AND (full_score OR previous_effect = 'no_clear_effect' OR stop_status <> '') THEN [previous_operator] ELSE []::VARCHAR[] END AS avoid FROM i),
u AS (SELECT *, list_filter(list_filter(l, lambda x, i: list_position(l, x) = i), lambda x: NOT list_contains(avoid, x)) AS ordered FROM m),
w AS (SELECT *, list_transform(ordered, lambda x: CASE WHEN x = 'contacts' AND NOT coalesce(mode IN ('en', 'de'), true) OR x = 'tables' AND NOT coalesce(mode IN ('en', 'fr'), true) OR x = 'prose' AND NOT coalesce(mode IN ('en', 'de', 'es'), true)
  OR x = 'secrets' AND NOT coalesce(mode IN ('en', 'de', 'fr', 'es'), true) THEN x || '=mode_not_supported' WHEN x = 'tables' AND NOT coalesce(contains(text, ' | '), false) OR x = 'secrets' AND no_source THEN x || '=authoritative_slot_missing' END) AS why FROM u),
s AS (SELECT *, list_filter(ordered, lambda x, i: why[i] IS NULL) AS safe, list_filter(why, lambda x: x IS NOT NULL) AS excluded FROM w)
SELECT doc_id, safe[1] AS "primary", array_to_string(safe[2:], ',') AS backups, array_to_string(avoid, ',') AS avoid, array_to_string(excluded, ',') AS excluded, len(safe) = 0 AS no_safe_operator, high_value OR full_rounds >= 2 AS tree_search FROM s""")
def rule_route(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "source").selectExpr(*_split(_INPUTS))
    rows = rows.withColumn("recommended", F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("prose"), F.lit("contacts"))))
    has = lambda x: F.contains("text", F.lit(x))
    rules = [(has("token"), ("secrets", "contacts", "tables")), (has("@"), ("contacts", "secrets")), (has(" | "), ("tables", "contacts"))]
    slots = {"tables": ~F.coalesce(has(" | "), F.lit(False)), "secrets": F.col("no_source")}
    r = routing.build_routes(rows, rules, ("prose", "tables"), _MODES, slots)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return r.select("doc_id", "primary", joined("backups"), joined("avoid"), joined("excluded"), "no_safe_operator", "tree_search")


def _split(columns: str) -> list[str]:
    """The expressions of a select list without commas inside their parentheses."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@query("w10_yield_ranking", """WITH RECURSIVE e AS (SELECT user_id % 4 AS grp, event_type || '-' || (user_id % 5) AS operator, value, user_id FROM events),
wanted AS (SELECT grp, operator, row_number() OVER (PARTITION BY grp ORDER BY operator) AS place FROM (SELECT DISTINCT grp, operator FROM e)),
own AS (SELECT grp, operator, count(*) AS attempts, count(*) FILTER (value > 10) AS hits, count(*) FILTER (user_id % 3 = 0) / count(*) AS errors, round(avg(value), 2) AS seconds FROM e WHERE grp < 2 GROUP BY ALL),
overall AS (SELECT operator, count(*) AS attempts, count(*) FILTER (value > 10) AS hits, count(*) FILTER (user_id % 3 = 0) / count(*) AS errors, round(avg(value), 2) AS seconds FROM e GROUP BY ALL),
s AS (SELECT w.grp, w.operator, w.place, CASE w.place WHEN 3 THEN 0 WHEN 2 THEN 1 END AS protected, coalesce(o.attempts, a.attempts) AS attempts,
  CASE WHEN o.operator IS NULL THEN a.hits ELSE o.hits END AS hits, CASE WHEN o.operator IS NULL THEN a.errors ELSE o.errors END AS errors, CASE WHEN o.operator IS NULL THEN a.seconds ELSE o.seconds END AS seconds
  FROM wanted w LEFT JOIN own o ON w.grp = o.grp AND w.operator = o.operator JOIN overall a ON w.operator = a.operator),
y AS (SELECT *, ((hits + 1) / (attempts + 2) + 0.3::DOUBLE / sqrt(attempts + 1)) * (1 - least(1.0::DOUBLE, errors)) / greatest(0.000001::DOUBLE, seconds) AS score FROM s),
g AS (SELECT grp, list(operator ORDER BY protected) FILTER (protected IS NOT NULL) AS first, list(operator ORDER BY score DESC, place) FILTER (protected IS NULL) AS by_score, list(operator ORDER BY attempts, place) FILTER (protected IS NULL) AS by_tries FROM y GROUP BY grp),
r AS (SELECT grp, first, by_score, by_tries, []::VARCHAR[] AS ranked FROM g
  UNION ALL SELECT grp, first, by_score, by_tries, ranked || list_filter(CASE WHEN (len(ranked) + 1) % 3 = 0 THEN by_tries ELSE by_score END, lambda x: NOT list_contains(ranked, x))[1:1] FROM r WHERE len(ranked) < len(by_score))
SELECT grp, array_to_string(first || ranked, ',') AS ranked FROM r WHERE len(ranked) = len(by_score)""")
def yield_ranking(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 4).alias("grp"), F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("operator"), "value", "user_id")
    figures = [F.count("*").alias("attempts"), F.count_if(F.col("value") > 10).alias("hits"), (F.count_if(F.col("user_id") % 3 == 0) / F.count("*")).alias("errors"), F.round(F.avg("value"), 2).alias("seconds")]
    from pyspark.sql import Window

    wanted = e.select("grp", "operator").distinct().withColumn("place", F.row_number().over(Window.partitionBy("grp").orderBy("operator")))
    wanted = wanted.withColumn("protected", F.when(F.col("place") == 3, 0).when(F.col("place") == 2, 1))
    s = routing.matching_stats(wanted, e.filter("grp < 2").groupBy("grp", "operator").agg(*figures), e.groupBy("operator").agg(*figures))
    return routing.rank_operators(s, 0.3).select("grp", F.array_join("ranked", ",").alias("ranked"))


# D12, D16, D17

_FLAGS = """o_orderkey AS k, o_orderkey % 37 = 0 AS manifest_corrupted, o_orderkey % 31 = 0 AS fatal_failure, o_orderkey % 29 = 0 AS retryable_failure, o_orderkey % 23 = 0 AS damaged, o_orderkey % 19 = 0 AS report_only, o_orderkey % 2 = 0 AS has_evidence,
  o_orderkey % 17 = 0 AS replan, o_orderkey % 13 = 0 AS budget_exhausted, o_orderkey % 11 = 0 AS target_reached, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END AS score_increased, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS not_applicable,
  o_orderkey % 3 AS boundary_candidates, o_orderkey % 4 AS pending"""


@query("d12_next_action", f"""WITH f AS (SELECT {_FLAGS} FROM orders), c AS (SELECT k, CASE WHEN manifest_corrupted THEN 'manifest_corrupted' WHEN fatal_failure THEN 'fatal_failure' WHEN retryable_failure THEN 'retryable_failure' WHEN damaged THEN 'damaged'
  WHEN report_only THEN CASE WHEN has_evidence THEN 'report_review' ELSE 'report_only' END WHEN score_increased > 0 THEN 'score_increased' WHEN not_applicable > 0 THEN 'not_applicable' WHEN replan THEN 'replan' WHEN budget_exhausted THEN 'budget_exhausted'
  WHEN target_reached THEN 'target_reached' WHEN pending = 0 THEN CASE WHEN boundary_candidates > 0 THEN 'no_pending_review' ELSE 'no_pending' END ELSE 'otherwise' END AS cause FROM f)
SELECT k, cause, CASE WHEN cause IN ('manifest_corrupted', 'fatal_failure', 'damaged') THEN 'blocked' WHEN cause = 'retryable_failure' THEN 'suspend' WHEN cause = 'replan' THEN 'replan' ELSE 'stop_and_report' END AS action,
  CASE cause WHEN 'manifest_corrupted' THEN 'manifest_corrupted' WHEN 'fatal_failure' THEN 'unrecoverable_tool_failure' WHEN 'retryable_failure' THEN 'retryable_tool_failure' WHEN 'damaged' THEN 'artifact_blocked' WHEN 'report_only' THEN 'review_completed'
    WHEN 'replan' THEN NULL WHEN 'budget_exhausted' THEN 'budget_exhausted' WHEN 'no_pending' THEN 'no_pending_branches' ELSE 'manual_review_required' END AS terminal_reason,
  cause NOT IN ('retryable_failure', 'report_only', 'replan', 'budget_exhausted', 'no_pending') AS needs_person FROM c""")
def next_action(spark, d):
    rows = table(spark, d, "orders").selectExpr(*_split(_FLAGS))
    return decisions.next_action(rows).select("k", "cause", "action", "terminal_reason", "needs_person")


_CHANGES = """o_orderkey AS proposal, 0 AS idx, concat('operator:', o_orderkey % 4) AS target, CASE WHEN o_orderkey % 13 = 0 THEN 'other' ELSE 'generation' END AS kind, 'reduce' AS action, 10.0{d} AS before, CASE WHEN o_orderkey % 11 = 0 THEN 10.0{d} ELSE 4.0{d} END AS after,
  o_orderkey % 5 <> 0 AS evidence, false AS operator_gained, false AS required"""
_CHANGES_2 = """o_orderkey AS proposal, 1 AS idx, concat('operator:', (o_orderkey + 1) % 4) AS target, 'generation' AS kind, 'increase' AS action, CASE WHEN o_orderkey % 7 = 0 THEN 9.0{d} ELSE 10.0{d} END AS before,
  CASE WHEN o_orderkey % 3 = 0 THEN 17.0{d} ELSE 16.0{d} END AS after, true AS evidence, o_orderkey % 17 = 0 AS operator_gained, false AS required"""


@query("d12_budget_decisions", """WITH p AS (SELECT o_orderkey AS k, o_orderkey % 13 = 0 AS other, o_orderkey % 11 = 0 AS flat, o_orderkey % 3 = 0 AS more FROM orders),
m AS (SELECT *, (CASE WHEN other THEN 0 WHEN flat THEN 0 ELSE -6 END) + (CASE WHEN more THEN 7 ELSE 6 END) AS moved FROM p)
SELECT k AS proposal, array_to_string(list_filter([CASE WHEN other THEN 'unconfigured_target_or_kind' END, CASE WHEN flat AND NOT other THEN 'reduce_must_lower' END, CASE WHEN k % 7 = 0 THEN 'does_not_match_remaining' END,
  CASE WHEN k % 17 = 0 THEN 'continues_score_increased_path' END, CASE WHEN moved <> 0 THEN 'not_conserved_generation' END], lambda x: x IS NOT NULL), ',') AS rejections,
  CASE WHEN k % 5 = 0 AND NOT other THEN 'no_evidence' ELSE '' END AS reviews,
  CASE WHEN other OR flat OR k % 7 = 0 OR k % 17 = 0 OR moved <> 0 THEN 'rejected' WHEN k % 5 = 0 THEN 'needs_human_review' ELSE 'approved' END AS status FROM m""")
def budget_decisions(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    changes = o.selectExpr(*_split(_CHANGES.format(d="D"))).unionByName(o.selectExpr(*_split(_CHANGES_2.format(d="D"))))
    ledger = spark.createDataFrame([("generation", f"operator:{i}", 10.0) for i in range(4)], "kind string, target string, remaining double")
    r = decisions.budget_decisions(changes, ledger, spark.createDataFrame([], "target string"))
    return r.select("proposal", F.array_join("rejections", ",").alias("rejections"), F.array_join("reviews", ",").alias("reviews"), "status")


@query("d16_observations", """WITH o AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS score_decreased, count(*) FILTER (event_type = 'view' AND value > 30) AS score_unchanged, count(*) FILTER (event_type = 'error' AND value > 20) AS score_increased,
  count(*) FILTER (value > 60) AS not_applicable, count(*) FILTER (value > 90) AS candidate_invalid, count(*) FILTER (event_type = 'purchase' AND value > 40) AS boundary_candidate_found FROM events GROUP BY user_id),
r AS (SELECT user_id, 'score_decreased' AS kind, score_decreased AS count, 'info' AS severity, 'report' AS actions, false AS replan, false AS person FROM o WHERE score_decreased > 0
  UNION ALL SELECT user_id, 'score_unchanged', score_unchanged, 'info', 'report', true, false FROM o WHERE score_unchanged > 0 UNION ALL SELECT user_id, 'score_increased', score_increased, 'warning', 'report,manual_review', false, true FROM o WHERE score_increased > 0
  UNION ALL SELECT user_id, 'not_applicable', not_applicable, 'warning', 'report', false, false FROM o WHERE not_applicable > 0 UNION ALL SELECT user_id, 'candidate_invalid', candidate_invalid, 'warning', 'report', false, false FROM o WHERE candidate_invalid > 0
  UNION ALL SELECT user_id, 'boundary_candidate_found', boundary_candidate_found, 'info', 'report', false, false FROM o WHERE boundary_candidate_found > 0 UNION ALL SELECT user_id, 'budget_warning', NULL, 'warning', 'stop_and_report', false, false FROM o WHERE user_id % 5 = 0
  UNION ALL SELECT user_id, 'manifest_corrupted', NULL, 'error', 'block_and_report', false, true FROM o WHERE user_id % 7 = 0 UNION ALL SELECT user_id, 'artifact_missing', NULL, 'warning', 'report', false, false FROM o WHERE user_id % 7 = 1)
SELECT * FROM r UNION ALL SELECT user_id, 'pipeline_completed', NULL, 'info', '', false, false FROM o WHERE user_id NOT IN (SELECT user_id FROM r)""")
def observations(spark, d):
    t, v = F.col("event_type"), F.col("value")
    counts = {"score_decreased": t == "click", "score_unchanged": (t == "view") & (v > 30), "score_increased": (t == "error") & (v > 20), "not_applicable": v > 60, "candidate_invalid": v > 90, "boundary_candidate_found": (t == "purchase") & (v > 40)}
    g = table(spark, d, "events").groupBy("user_id").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    state = F.when(F.col("user_id") % 7 == 0, "damaged").when(F.col("user_id") % 7 == 1, "missing").otherwise("ok")
    return decisions.observations(g, "user_id", F.col("user_id") % 5 == 0, state)


@query("d17_gain_gate_rows", """WITH g AS (SELECT doc_id, doc_id % 5 <> 0 AS evolved, doc_id % 7 = 0 AS failed, CASE doc_id % 4 WHEN 0 THEN 'axis_shift' WHEN 1 THEN 'clear_gain' ELSE 'weak_gain' END AS label, doc_id % 4 = 1 AS passed, (doc_id % 10) / 10.0::DOUBLE AS s FROM documents),
r AS (SELECT doc_id, CASE WHEN NOT evolved THEN 'not_applicable' WHEN failed THEN 'needs_manual_review' ELSE label END AS gate_label, CASE WHEN NOT evolved THEN true WHEN failed THEN false ELSE passed END AS gate_passed, CASE WHEN NOT evolved THEN 1.0 WHEN failed THEN 0.0 ELSE s END AS score FROM g)
SELECT doc_id, gate_label, gate_passed, score AS no_leakage, score AS answerability, CASE WHEN NOT gate_passed THEN CASE WHEN gate_label = 'axis_shift' THEN 'switch_operator_family' ELSE 'retry_with_backup_operator' END END AS retry_strategy FROM r""")
def gain_gate(spark, d):
    k = F.col("doc_id")
    label = F.when(k % 4 == 0, "axis_shift").when(k % 4 == 1, "clear_gain").otherwise("weak_gain")
    scores = {x: (k % 10) / 10.0 for x in decisions.DIMENSIONS}
    r = decisions.gain_gate_rows(table(spark, d, "documents").select("doc_id"), k % 5 != 0, F.when(k % 7 == 0, "timeout").otherwise(""), label, k % 4 == 1, scores)
    return r.select("doc_id", "gate_label", "gate_passed", "no_leakage", "answerability", "retry_strategy")


# W17, W18, T1, T3, T5, G1, G3


@query("w17_search_refresh", """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE l_linenumber % 4 WHEN 0 THEN CASE WHEN l_orderkey % 3 = 0 THEN 'pending' ELSE 'no_score_change' END WHEN 1 THEN CASE WHEN l_orderkey % 5 = 0 THEN 'running' ELSE 'boundary_candidate' END ELSE 'score_increased' END AS st
  FROM lineitem GROUP BY ALL), p AS (SELECT k, count(*) FILTER (st = 'pending') AS pending, coalesce(string_agg('op' || n, ',' ORDER BY n) FILTER (st <> 'pending'), '') AS attempted, coalesce(string_agg('b' || n, ',' ORDER BY n) FILTER (st = 'running'), '') AS in_flight,
  count(*) FILTER (st = 'boundary_candidate') AS c FROM l GROUP BY k), f AS (SELECT *, k % 7 <> 0 AND c >= 2 AS reached, in_flight = '' AS idle, pending = 0 AND in_flight = '' AS done FROM p)
SELECT k, attempted, in_flight, CASE WHEN reached AND idle THEN 'completed' WHEN reached THEN 'running' WHEN done THEN 'completed' ELSE 'running' END AS status,
  CASE WHEN reached THEN 'boundary_target_reached' WHEN done THEN CASE WHEN k % 2 = 0 THEN 'operator_space_exhausted' ELSE 'candidate_list_exhausted' END END AS reason, CASE WHEN done THEN 'complete' WHEN reached THEN 'partial' ELSE 'none' END AS coverage FROM f""")
def search_refresh(spark, d):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    st = F.when(n % 4 == 0, F.when(k % 3 == 0, "pending").otherwise("no_score_change")).when(n % 4 == 1, F.when(k % 5 == 0, "running").otherwise("boundary_candidate")).otherwise("score_increased")
    lines = table(spark, d, "lineitem").select(k.alias("k"), n.alias("n"), st.alias("st")).distinct()
    entry = F.struct("n", F.concat(F.lit("op"), "n").alias("operator"), F.concat(F.lit("b"), "n").alias("branch"), F.col("st").alias("status"))
    s = lines.groupBy("k").agg(F.sort_array(F.collect_list(entry)).alias("plan"), F.count_if(F.col("st") == "boundary_candidate").alias("candidates"))  # a plan has one entry an operator
    s = s.select("k", "plan", "candidates", F.lit(2).alias("target"), (F.col("k") % 7 == 0).alias("live"), (F.col("k") % 2 == 0).alias("forced"), F.lit("running").alias("status"), F.lit("none").alias("coverage"), F.lit(None).cast("string").alias("reason"))
    r = search_state.refresh(s)
    return r.select("k", F.array_join("attempted", ",").alias("attempted"), F.array_join("in_flight", ",").alias("in_flight"), "status", "reason", "coverage")


@query("w18_checkpoint_recovery", """WITH c AS (SELECT user_id, arg_max(event_id, event_id) AS last, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS v FROM events WHERE user_id % 6 <> 0 GROUP BY user_id), u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, CASE WHEN c.user_id IS NULL THEN 'new' WHEN t = 'error' AND v > 5 THEN 'running' WHEN t IN ('error', 'view') THEN 'partial' ELSE 'completed' END AS status,
  CASE WHEN c.user_id IS NULL OR t = 'error' AND v > 5 THEN NULL WHEN t = 'error' THEN 'boundary_target_reached' WHEN t = 'view' THEN 'candidate_list_exhausted' ELSE 'operator_space_exhausted' END AS reason, c.user_id IS NOT NULL AND t = 'error' AND v > 5 AS resumed FROM u LEFT JOIN c USING (user_id)""")
def checkpoint_recovery(spark, d):
    e, t, v = table(spark, d, "events"), F.col("event_type"), F.col("value")
    digest = F.sha2(F.concat(F.lit("in-"), F.col("user_id").cast("string")), 256)
    status = F.when(t.isin("error", "view"), "partial").otherwise("completed")
    reason = F.when((t == "error") & (v > 5), "timeout").when(t == "error", "boundary_target_reached").when(t == "view", "candidate_list_exhausted").otherwise("operator_space_exhausted")
    log = e.filter("user_id % 6 <> 0").select("user_id", F.col("event_id").alias("seq"), digest.alias("input_digest"), status.alias("status"), reason.alias("reason"))
    return search_state.recover(e.select("user_id").distinct(), log, "user_id", "seq", digest)


@query("t1_fair_dispatch", """WITH t AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS turn FROM events)
SELECT event_id, turn, (row_number() OVER (ORDER BY turn, user_id) - 1) // 20 AS wave, (event_id * 2 + 1) AS result FROM t""")
def fair_dispatch(spark, d):
    waves = search_state.fair_waves(table(spark, d, "events").select("event_id", "user_id"), "user_id", "event_id", 20)

    def worker(frame):
        return frame[["event_id", "turn", "wave"]].assign(result=frame["event_id"] * 2 + 1)

    return search_state.bounded_map(waves, worker, "event_id long, turn long, wave long, result long", 8)


@query("t3_wave_scheduler", """WITH p AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events),
h AS (SELECT user_id, min(place) FILTER (value > 30) AS first_hit, count(*) AS n FROM p GROUP BY user_id)
SELECT user_id, least(n, 6, 2 * ceil(coalesce(first_hit, 99) / 2))::BIGINT AS done, coalesce(first_hit <= 6, false) AS hit FROM h""")
def wave_scheduler(spark, d):
    """Two branches of a sample at a time, until one of them hits; three waves at most."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    plan = table(spark, d, "events").select("user_id", place.alias("place"), "value")
    state = plan.groupBy("user_id").agg(F.max("place").alias("n")).select("user_id", F.lit(0).cast("long").alias("done"), F.lit(False).alias("hit"), F.col("n").cast("long").alias("n"))

    def claim(s):
        return s.filter("NOT hit AND done < n").join(plan, "user_id").filter("place > done AND place <= done + 2").select("user_id", "value")

    def merge(s, results):
        return s.join(results, "user_id", "left").select("user_id", (F.col("done") + F.coalesce("ran", F.lit(0))).alias("done"), (F.col("hit") | F.coalesce("found", F.lit(False))).alias("hit"), "n")

    last, _ = search_state.run_waves(state, claim, lambda c: c.groupBy("user_id").agg(F.count("*").alias("ran"), F.max(F.col("value") > 30).alias("found")), merge, 3)
    return last.select("user_id", "done", "hit")


@query("t5_retention", """WITH l AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY ALL), b AS (SELECT user_id FROM events GROUP BY user_id HAVING bool_or(event_type = 'purchase'))
SELECT * FROM l WHERE user_id NOT IN (SELECT user_id FROM b) OR event_type IN ('purchase', 'error')""")
def retention(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "event_id")
    return search_state.retain_only(e, "user_id", "event_type", "event_id", ["purchase", "error"], "purchase")


@query("g1_g3_stage_handlers", """SELECT event_type, count(*) AS n, max(CASE event_type WHEN 'view' THEN 'observe' WHEN 'click' THEN 'engage' WHEN 'purchase' THEN 'convert' END) AS policy, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 5 END)::BIGINT AS weight FROM events WHERE value > 1 GROUP BY ALL""")
def stage_handlers(spark, d):
    registry = [("view", "observe", 1), ("click", "engage", 2), ("purchase", "convert", 5)]
    handlers = [
        lambda df: df.filter("value > 1"),
        lambda df: search_state.with_registry(df, "event_type", registry, "event_type string, policy string, weight int"),
        lambda df: df.groupBy("event_type").agg(F.count("*").alias("n"), F.max("policy").alias("policy"), F.sum("weight").alias("weight")),
    ]
    return search_state.through(table(spark, d, "events"), handlers)


# S4, S5, S7, S8, S14, S18


@query("s4_s5_json_sink", "SELECT p_partkey, p_name, p_size FROM part")
def json_sink(spark, d):
    """A plain JSON sink, written once more over itself: readers see whole output or none."""
    rows, path = table(spark, d, "part").select("p_partkey", "p_name", "p_size"), shared_path(spark, "sink")
    for _ in range(2):
        rows.write.mode("overwrite").json(path)
    return spark.read.schema(rows.schema).json(path)


@query("s7_publish_once", "SELECT o_orderkey, o_orderstatus, 3 AS round FROM orders")
def publish_once(spark, d):
    path, rows = shared_path(spark, "published"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    manifest.publish(rows, path, "orders", {"a": 1}, rows, stamp={"round": 3})
    manifest.publish(rows.limit(0), path, "orders", {"a": 1}, rows, stamp={"round": 3})  # a valid table is left as it is
    return manifest.copy_published(spark, path, shared_path(spark, "copied"), "orders")


_CASES = ("ok", "output_missing", "manifest_missing_or_invalid", "manifest_version_mismatch", "stage_mismatch", "manifest_config_digest_mismatch", "artifact_metadata_missing", "artifact_size_mismatch", "artifact_parse_failed", "artifact_digest_mismatch",
          "artifact_record_count_mismatch", "input_metadata_missing", "input_digest_mismatch", "config_digest_mismatch", "sidecar_path_missing", "sidecar_missing", "sidecar_size_mismatch", "sidecar_digest_mismatch")


@query("s8_manifest", f"SELECT * FROM (VALUES {', '.join(f'({i}, {str(not i).lower()}, {c!r})' for i, c in enumerate(_CASES))}) AS v(n, valid, reason)")
def manifest_validation(spark, d):
    """A table is published with a sidecar, then spoilt in every way that validation tells apart."""
    from pyspark.sql import Row

    rows, path, side = table(spark, d, "supplier").select("s_suppkey", "s_name"), shared_path(spark, "artifact"), shared_path(spark, "side")
    rows.limit(3).coalesce(1).write.parquet(side)
    manifest.publish(rows, path, "suppliers", {"a": 1}, rows, [side])
    junk = shared_path(spark, "junk.parquet")
    rows.select("s_name").write.text(junk)
    good = manifest.read_manifest(spark, path)
    artifact, sidecar = good.artifact.asDict(), good.sidecars[0].asDict()

    def checked(at=path, stage="suppliers", want=None, source=None, **changed):
        m = good.asDict() | changed
        spark.createDataFrame([Row(**m)], manifest._MANIFEST).coalesce(1).write.mode("overwrite").json(f"{at}.manifest")
        return manifest.validate(spark, at, stage, want or {"a": 1}, rows if source is None else source)

    found = [
        checked(),
        manifest.validate(spark, shared_path(spark, "nothing")),
        manifest.validate(spark, side),
        checked(version=2),
        checked(stage="other"),
        checked(config='{"a": 2}'),
        checked(artifact=None),
        checked(artifact=artifact | {"bytes": 1}),
        checked(at=junk, artifact=artifact | {"bytes": manifest._bytes(spark, junk)}),
        checked(artifact=artifact | {"digest": "0"}),
        checked(artifact=artifact | {"records": 1}),
        checked(input_sha256=None),
        checked(source=rows.limit(0)),
        checked(want={"a": 3}),
        checked(sidecars=[sidecar | {"path": None}]),
        checked(sidecars=[sidecar | {"path": f"{side}-gone"}]),
        checked(sidecars=[sidecar | {"bytes": 1}]),
        checked(sidecars=[sidecar | {"digest": "0"}]),
    ]
    return spark.createDataFrame([(i, ok, why) for i, (ok, why) in enumerate(found)], "n int, valid boolean, reason string")


@query("s14_snapshot", """SELECT (SELECT count(*) FROM part WHERE p_size % 3 <> 0) AS cards, 'global_memory' AS mode, true AS stable, true AS changes""")
def snapshot(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("version"), F.when(F.col("p_size") % 3 != 0, "active").otherwise("retired").alias("status"))
    one = lambda df: manifest.snapshot_id(df, "p_partkey", "version", "status")
    # The card with the smallest key of those that count gets a new version; a retired one would change nothing.
    least = p.filter("status = 'active'").agg(F.min("p_partkey").alias("least"))
    bumped = p.join(F.broadcast(least), F.lit(True)).withColumn("version", F.col("version") + F.when(F.col("p_partkey").eqNullSafe(F.col("least")), 3).otherwise(0))  # one row
    first, again, later = one(p), one(p.repartition(3)), one(bumped)
    j = first.join(again.select(F.col("snapshot").alias("s2")), F.lit(True)).join(later.select(F.col("snapshot").alias("s3")), F.lit(True))  # one row each
    return j.select("cards", "mode", (F.col("snapshot") == F.col("s2")).alias("stable"), (F.col("snapshot") != F.col("s3")).alias("changes"))


@query("s18_event_log", "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS written FROM events")
def event_log(spark, d):
    e, path = table(spark, d, "events").select("event_id", "event_type"), shared_path(spark, "log")
    manifest.append_events(e.filter("event_id % 2 = 0"), path)
    return manifest.append_events(e, path).select("event_id", "event_type", F.col("written").cast("int").alias("written"))
