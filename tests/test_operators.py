"""Small cases, computed by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import facts, text
from sparkloom.operators import decisions, joins, ranking, routing, rules, schema, search_state, stats, tree
from sparkloom.sources import manifest, records
from sparkloom.sources.scratch import shared_path
from sparkloom.streaming import events


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_trial_summary_interpolates_and_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 1, 0.2), (1, 2, 0.4), (1, 3, 1.0)], "sample long, trial int, score double")
    r = stats.trial_summary(df).first()
    assert (r.n, r.median, r.p75, r.n_full, r.n_high) == (3, 0.4, 0.7, 1, 1)
    assert r.std == pytest.approx(0.339935, abs=1e-6)
    assert r.admission == pytest.approx(0.67)


def test_percentile_by_index_rounds_half_to_even(spark):
    df = spark.createDataFrame([([10, 20, 30, 40],)], "v array<int>")
    r = df.select(stats.index_percentile(F.col("v"), 0.5, True).alias("a"), stats.index_percentile(F.col("v"), 0.9, False).alias("b")).first()
    assert (r.a, r.b) == (30, 30)


def test_last_wins_drops_blank_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (" ", 3, "z"), (None, 4, "w")], "key string, seq int, v string")
    assert rows(joins.last_wins(df, "key", "seq")) == [("a", "y")]


def test_wildcard_cards_meet_all_routes(spark):
    routes = spark.createDataFrame([(1, "x"), (2, None)], "id int, scope string")
    cards = spark.createDataFrame([("any", ""), ("of_x", "x")], "card string, scope string")
    assert sorted((r.id, r.card) for r in joins.wildcard_join(routes, cards, "scope").collect()) == [(1, "any"), (1, "of_x"), (2, "any")]


def test_similarity_needs_three_of_four_fields(spark):
    schema = "id int, f1 string, f2 string, f3 string, f4 string"
    a = spark.createDataFrame([(1, "a", "b", "c", "d")], schema)
    b = spark.createDataFrame([(2, "a", "b", "c", "x"), (3, "a", "b", "y", "x"), (4, "a", "b", None, None)], schema)
    assert rows(joins.signature_similarity(a, b, ["f1", "f2", "f3", "f4"])) == [(1, 2, 0.75), (1, 4, 1.0)]


def test_exploration_budget_is_spent_in_group_order(spark):
    schema = "grp string, id int, flow string, score double, gain int"
    df = spark.createDataFrame([("a", 1, "explore", 0.5, 1), ("b", 2, "explore", 0.9, 1), ("c", 3, "main", 0.1, 1), ("d", 4, "reject", -1000.0, 1)], schema)
    got = {r.grp: (r.chosen, r.id) for r in ranking.select_candidates(df, 1).collect()}
    assert got == {"a": ("explore", 1), "b": ("original", None), "c": ("main", 3), "d": ("original", None)}


def test_clamp_keeps_nan_out(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,), (-1.0,), (0.25,)], "x double")
    assert [r[0] for r in df.select(rules.clamp(F.col("x"))).collect()] == [0.0, 0.0, 1.0, 0.0, 0.25]


def test_snapshot_round_trip(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, t string, u string")
    changed = rules.with_snapshot(df, ["t", "u"], {"t": F.lit("b"), "u": F.lit("c")}, "t")
    assert changed.first().version.startswith("qv_")
    assert rows(rules.restored(changed, ["t", "u"]).select("id", "t")) == [(1, "a")]
    assert rules.restored(changed, ["t", "u"]).first().u is None


def test_long_runs_and_refusals(spark):
    df = spark.createDataFrame([("x" * 50,), ("As an AI I cannot",)], "t string")
    got = [r[0] for r in text.quality_codes(df, "t").select("codes").collect()]
    assert got == [["long_run"], ["refusal", "too_short"]]


def test_tree_stops_at_the_depth_limit(spark):
    df = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a"), ("c", "b")], "id string, parent string")
    assert [r.id for r in tree.derive(df, 3).orderBy("depth").collect()] == ["r", "a", "b"]


def test_strict_json_raises_and_optional_reads_empty(spark):
    path = shared_path(spark, "bad")
    spark.createDataFrame([('{"k": 1}',), ("{",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        records.read_json(spark, path, "k long").collect()
    assert records.read_json(spark, path, "k long", strict=False).count() == 2
    assert records.read_optional(spark, path + "-none", T.StructType([T.StructField("k", T.LongType())])).count() == 0


def test_stream_merge_is_idempotent(spark):
    source, target = shared_path(spark, "in"), shared_path(spark, "out")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    df.coalesce(1).write.parquet(source)
    for i in range(2):  # a second run with a fresh checkpoint replays everything
        events.merged(events.event_stream(spark, source, "*.parquet", df.schema), target, "id", shared_path(spark, f"check{i}"))
    assert [r.id for r in spark.read.parquet(target).orderBy("id").collect()] == [1, 2]


def test_the_first_error_of_nested_records(spark):
    node = {"type": "object", "required": ["name"], "properties": {"name": {"type": "string", "minLength": 1}, "next": {"type": ["array", "null"], "items": {"$ref": "leaf"}}}}
    refs = {"leaf": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "on": {"type": "boolean"}}}}
    cases = {
        '{"name": "a", "next": [{"v": 1}, {"v": 2, "on": true}], "extra": {}}': None,
        '{"name": "a", "next": null}': None,
        '{"name": "a", "next": [{"v": 1}, {"on": true}]}': "$.next[1].v required",
        '{"name": "a", "next": [{"v": true}]}': "$.next[0].v type",
        '{"name": "a", "next": [{"v": 1.5}]}': "$.next[0].v type",
        '{"name": "a", "next": [{"v": 1, "on": 1}, 5]}': "$.next[0].on type",
        '{"name": ""}': "$.name minLength",
        '{"name": null}': "$.name type",
        "[]": "$ type",
        "{": "$ parse",
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string")
    assert {r.j: r.invalid for r in schema.validate_json(df, "j", node, refs).collect()} == cases


def test_rank_keeps_the_protected_first_and_explores_in_turn(spark):
    rows = [("g", f"o{i}", i, 0 if i == 4 else None, *x) for i, x in enumerate([(10, 9, 0.0, 1.0), (10, 9, 0.0, 2.0), (10, 9, 1.0, 1.0), (0, 0, 0.0, 1.0), (5, 0, 0.0, 1.0), (10, 0, 0.0, 1.0)])]
    df = spark.createDataFrame(rows, "grp string, operator string, place int, protected int, attempts int, hits int, errors double, seconds double")
    assert routing.rank_operators(df, 0).first().ranked == ["o4", "o0", "o3", "o1", "o5", "o2"]
    assert routing.rank_operators(df, 0.5).first().ranked == ["o4", "o3", "o0", "o1", "o2", "o5"]


def test_a_group_row_is_preferred_to_the_overall_one(spark):
    figures = "attempts int, hits int, errors double, seconds double"
    grouped = spark.createDataFrame([("g", "a", 1, 1, 0.0, 1.0), ("g", "a", 7, 2, 0.0, 1.0)], f"grp string, operator string, {figures}")
    overall = spark.createDataFrame([("a", 99, 0, 0.0, 1.0), ("b", 50, 0, 0.0, 1.0)], f"operator string, {figures}")
    wanted = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "c")], "grp string, operator string")
    assert {r.operator: r.attempts for r in routing.matching_stats(wanted, grouped, overall).collect()} == {"a": 7, "b": 50, "c": 0}


def test_fact_check(spark):
    cases = [
        ("付100元", "付100 元", [], []),
        ("付100元", "付200元", ["numeric_fact_added_or_conflicted"], []),
        ("由“甲方”付", "由“乙方”付", ["explicit_entity_replaced"], []),
        ("由“甲方”付", "由“甲方”和“乙方”付", [], []),
        ("不得转让。", "可以转让。", ["text_level_reversal"], ["deleted_key_restriction_warning"]),
        ("能否成立？", "已查明，能否成立？", ["new_deterministic_evidence_result"], []),
        ("a", "仅限 b", [], ["scenario_narrowing_warning"]),
        (None, None, [], []),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(cases)], "i int, old string, new string")
    got = {r.i: (r.fatal, r.warnings) for r in facts.fact_check(df, "old", "new").collect()}
    assert got == {i: (f, w) for i, (_, _, f, w) in enumerate(cases)}
    assert all(r.passed for r in facts.fact_check(df, "old", "new", F.lit(False)).collect())


def test_surface_leaks(spark):
    cases = [
        ("A. 疑似\nB. 已查明\nC. x", ["safe_option_leak"], "safe_option_leak:A. 疑似"),
        ("A. 疑似\nB. 线索\nC. 已查明", [], None),
        ("A. 疑似已查明", [], None),
        ("写明得分点，先判断", ["rubric_axis_leak", "reasoning_path_leak"], "rubric_axis_leak:得分点"),
        (None, [], None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string")
    got = {r.i: (r.leak_types, r.leak_evidence[0] if r.leak_evidence else None) for r in facts.leaks(df, "t").collect()}
    assert got == {i: (k, e) for i, (_, k, e) in enumerate(cases)}


def test_a_checkpoint_of_another_input_raises(spark):
    inputs = spark.createDataFrame([("a", "x")], "key string, text string")
    log = spark.createDataFrame([("a", 1, "old", "partial", "timeout"), ("a", 2, "other", "partial", "timeout")], "key string, seq int, input_digest string, status string, reason string")
    assert search_state.recover(inputs, log, "key", "seq", F.lit("other")).first().status == "running"
    with pytest.raises(Exception, match="another input"):
        search_state.recover(inputs, log, "key", "seq", F.lit("old")).collect()


def test_budget_must_leave_an_operator(spark):
    ledger = spark.createDataFrame([("scoring", "operator:a", 2.0), ("scoring", "pool", 0.0)], "kind string, target string, remaining double")
    fields = "proposal int, idx int, target string, kind string, action string, before double, after double, evidence boolean, operator_gained boolean, required boolean"
    rows = [(1, 0, "operator:a", "scoring", "reduce", 2.0, 0.0, True, False, False), (1, 1, "pool", "scoring", "increase", 0.0, 2.0, True, False, False), (2, 0, "operator:a", "scoring", "reduce", 2.0, 1.0, True, False, True), (3, 0, "memory", "scoring", "increase", 0.0, 1.0, True, False, False)]
    eligible = spark.createDataFrame([("pool",)], "target string")
    got = {r.proposal: (r.status, r.rejections, r.reviews) for r in decisions.budget_decisions(spark.createDataFrame(rows, fields), ledger, eligible).collect()}
    assert got[1] == ("needs_human_review", [], ["eliminates_all_operators"])
    assert got[2] == ("rejected", ["removes_required_scoring", "not_conserved_scoring"], [])
    assert got[3] == ("rejected", ["targets_protected_state", "adds_scoring_to_unvalidated", "not_conserved_scoring"], [])


def test_waves_stop_when_nothing_is_claimed(spark):
    state = spark.createDataFrame([(1, 3), (2, 1)], "k int, left int")
    merge = lambda s, r: s.join(r, "k", "left").selectExpr("k", "left - coalesce(ran, 0) AS left")
    last, n = search_state.run_waves(state, lambda s: s.filter("left > 0"), lambda c: c.selectExpr("k", "1 AS ran"), merge, 9)
    assert n == 3 and rows(last) == [(1, 0), (2, 0)]


def test_publishing_twice_leaves_the_first(spark):
    path = shared_path(spark, "artifact")
    df = spark.range(5)
    manifest.publish(df, path, "s", {"a": 1}, stamp={"round": 2})
    assert rows(manifest.publish(spark.range(9), path, "s", {"a": 1}, stamp={"round": 2})) == [(i, 2) for i in range(5)]
    assert manifest.publish(spark.range(9), path, "s", {"a": 2}).count() == 9


@pytest.mark.parametrize("parts", [[(1, 3), (2, 4)], [(61, 4), (62, 3)], [(1, None), (2, 4), (2, 4)], [(None, 4)]])
def test_snapshot_query_changes_a_card_that_counts(spark, parts):
    from sparkloom.plans import catalog

    d = shared_path(spark, "parts")
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{d}/part.parquet")
    cards = sum(size is not None and size % 3 != 0 for _, size in parts)
    assert rows(catalog.QUERIES["s14_snapshot"](spark, d)) == [(cards, "global_memory", True, True)]
