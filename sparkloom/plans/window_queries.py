"""Ranking, budget and state operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking, rules, stats
from .catalog import query
from .tables import CANDIDATES_SQL, ROUNDS_SQL, TRIALS_SQL, candidates, rounds, table, trials

FLOW_SQL = f"""{CANDIDATES_SQL}, f AS (SELECT *, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 AND gain >= 40 THEN 'main' WHEN quality = 1 THEN 'explore' WHEN gain >= 60 THEN 'explore' ELSE 'fallback' END AS flow FROM candidates),
s AS (SELECT *, CASE WHEN flow = 'reject' THEN -1000.0 ELSE greatest(0.0, round(CASE WHEN flow = 'explore' THEN least(0.45 * gain::DOUBLE / 96 + 0.35::DOUBLE * quality - 0.2::DOUBLE * toxic, 0.6) ELSE 0.45::DOUBLE * gain / 96 + 0.35::DOUBLE * quality - 0.2::DOUBLE * toxic END, 8)) END::DOUBLE AS score FROM f)"""


def scored(spark, d):
    return rules.candidate_score(rules.candidate_flow(candidates(spark, d)))


@query("d4_d5_candidate_flow", f"WITH {FLOW_SQL} SELECT grp, id, flow, score FROM s")
def candidate_flow(spark, d):
    return scored(spark, d).select("grp", "id", "flow", "score")


@query("w1_w2_selection_with_budget", f"""WITH {FLOW_SQL}, r AS (SELECT *, CASE flow WHEN 'main' THEN 0 WHEN 'explore' THEN 1 ELSE 2 END AS tier FROM s WHERE flow <> 'reject'),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY tier, score DESC, gain DESC, id) AS place FROM r) WHERE place = 1),
g AS (SELECT grp, min(id) AS first_id, count(*) AS n, count(*) FILTER (flow = 'reject') AS rejected FROM s GROUP BY grp),
j AS (SELECT g.*, b.id, b.tier, sum(coalesce((b.tier = 1)::INT, 0)) OVER (ORDER BY first_id) AS spent FROM g LEFT JOIN b USING (grp)),
c AS (SELECT *, CASE WHEN tier = 0 THEN 'main' WHEN tier = 1 AND spent <= 5 THEN 'explore' ELSE 'original' END AS chosen FROM j)
SELECT grp, n, rejected, chosen, CASE WHEN chosen <> 'original' THEN id END AS id FROM c""")
def selection(spark, d):
    return ranking.select_candidates(scored(spark, d), 5)


@query("w3_greedy_allocation", """WITH p AS (SELECT c_nationkey AS nation, 1 + count(*) % 9 AS desired FROM customer GROUP BY ALL),
o AS (SELECT *, coalesce(sum(desired - 1) OVER (ORDER BY desired DESC, nation ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto, count(*) OVER () AS n FROM p)
SELECT nation, desired, (1 + least(desired - 1, greatest(0, 60 - n - upto)))::BIGINT AS given FROM o""")
def greedy_allocation(spark, d):
    p = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg((1 + F.count("*") % 9).alias("desired"))
    return ranking.allocate(p, "nation", "desired", 60)


@query("w4_best_of_trials", f"""WITH {TRIALS_SQL}, m AS (SELECT sample, avg(trial) AS middle, median(score) AS median FROM trials GROUP BY sample)
SELECT sample, arg_min(trial, (abs(score - median), abs(trial - middle), trial)) AS best FROM trials JOIN m USING (sample) GROUP BY sample""")
def best_of_trials(spark, d):
    t = trials(spark, d)
    m = t.groupBy("sample").agg(F.avg("trial").alias("middle"), F.median("score").alias("median"))
    order = F.struct(F.abs(F.col("score") - F.col("median")), F.abs(F.col("trial") - F.col("middle")), "trial")
    return t.join(m, "sample").groupBy("sample").agg(F.min_by("trial", order).alias("best"))


@query("w5_deviation_from_mean", f"""WITH {TRIALS_SQL}, g AS (SELECT *, round(score - avg(score) OVER (PARTITION BY sample), 6) + 0.0 AS advantage FROM trials)
SELECT *, CASE WHEN advantage > 0 THEN 'high' WHEN advantage < 0 THEN 'low' ELSE 'near_mean' END AS kind FROM g""")
def deviation(spark, d):
    return ranking.deviation_from_mean(trials(spark, d), "sample", "score")


@query("w6_streaks", """WITH h AS (SELECT user_id, event_id, (event_type <> 'error')::INT AS hit FROM events),
i AS (SELECT *, sum(1 - hit) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM h)
SELECT user_id, event_id, (sum(hit) OVER (PARTITION BY user_id, island ORDER BY event_id))::BIGINT AS streak FROM i""")
def streaks(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return ranking.streaks(e, "user_id", "event_id", F.col("event_type") != "error").drop("event_type")


@query("w7_claim_window", """SELECT * FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'view') WHERE place <= least(3, 1 + user_id % 4)""")
def claim_window(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return ranking.claim_window(e, "user_id", "event_id", F.col("event_type") == "view", F.least(F.lit(3), 1 + F.col("user_id") % 4)).drop("event_type")


@query("w8_frontier_claim", """SELECT n_regionkey AS region, arg_min(c_custkey, (c_nationkey, c_acctbal, c_custkey)) AS claimed FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY ALL""")
def frontier_claim(spark, d):
    c = table(spark, d, "customer").filter("c_acctbal > 0").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy(F.col("n_regionkey").alias("region")).agg(F.min_by("c_custkey", F.struct("c_nationkey", "c_acctbal", "c_custkey")).alias("claimed"))


@query("w9_repeats_in_order", """WITH p AS (SELECT doc_id, lang, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS hash FROM documents),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang, hash ORDER BY doc_id) AS place FROM p)
SELECT doc_id, lang, place, CASE place WHEN 1 THEN 'accepted' WHEN 2 THEN 'retry' ELSE 'exhausted' END AS verdict FROM r""")
def repeats_in_order(spark, d):
    p = table(spark, d, "documents").select("doc_id", "lang", F.sha2(F.trim(F.regexp_replace("text", r"[\t\n\f\r ]+", " ")), 256).alias("hash"))
    return ranking.repeats_in_order(p, ["lang", "hash"], "doc_id").drop("hash")


@query("w11_top_k_retrieval", """SELECT doc_id, contains(text, 'the')::INT + contains(text, 'ing')::INT + contains(text, 'des')::INT + contains(text, 'und')::INT AS hits FROM documents ORDER BY hits DESC, doc_id LIMIT 20""")
def top_k(spark, d):
    score = sum((F.contains("text", F.lit(t)).cast("int") for t in ("ing", "des", "und")), F.contains(F.col("text"), F.lit("the")).cast("int"))
    return ranking.top_k(table(spark, d, "documents"), score, "doc_id", 20).select("doc_id", "hits")


@query("w12_first_wins_order", """SELECT user_id, first_id, kinds FROM (SELECT user_id, min(event_id) AS first_id, string_agg(event_type, '>' ORDER BY e) AS kinds
  FROM (SELECT user_id, event_type, min(event_id) AS e, min(event_id) AS event_id FROM events GROUP BY user_id, event_type) GROUP BY user_id)""")
def first_wins_order(spark, d):
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("e"))  # at most one row per kind
    order = F.sort_array(F.collect_list(F.struct("e", "event_type")))
    return first.groupBy("user_id").agg(F.min("e").alias("first_id"), order.alias("o")).select("user_id", "first_id", F.array_join(F.col("o.event_type"), ">").alias("kinds"))


@query("w13_reallocation", """WITH s AS (SELECT p_brand AS brand, count(*) AS spent, avg(p_size) < 25 AS low FROM part GROUP BY ALL),
r AS (SELECT *, sum(CASE WHEN low THEN spent ELSE 0 END) OVER () AS freed, row_number() OVER (ORDER BY low, spent DESC, brand) AS place FROM s)
SELECT brand, spent AS before, (CASE WHEN low THEN 0 WHEN place = 1 THEN spent + freed ELSE spent END)::BIGINT AS after FROM r""")
def reallocation(spark, d):
    s = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("spent"), (F.avg("p_size") < 25).alias("is_low"))
    return ranking.reallocate(s, "brand", F.col("is_low"), "spent")


ADMISSION_SQL = f"""{TRIALS_SQL}, g AS (SELECT sample, count(*) AS n, median(score) AS median, min(score) AS low, max(score) AS high, round(quantile_cont(score, 0.75), 6) AS p75,
  round(max(score) - min(score), 6) AS spread, count(*) FILTER (score >= 0.8) AS n_high FROM trials GROUP BY sample),
a AS (SELECT sample, CASE WHEN low >= 0.999 THEN 'stable_full' WHEN median >= 0.8 THEN 'stable_high' WHEN high >= 0.8 THEN 'unstable_high' WHEN spread >= 0.4 THEN 'volatile' WHEN p75 >= 0.6 THEN 'middle' ELSE 'low' END AS class,
  list_filter([CASE WHEN spread >= 0.4 THEN 'wide' END, CASE WHEN n_high > 0 AND median < 0.8 THEN 'split' END, CASE WHEN n < 3 THEN 'few' END], lambda x: x IS NOT NULL) AS r FROM g)"""


@query("d2_admission", f"WITH {ADMISSION_SQL} SELECT sample, class, array_to_string(r, ',') AS extra_reasons, least(2, len(r))::BIGINT AS extra_trials FROM a")
def admission(spark, d):
    return rules.admission(stats.trial_summary(trials(spark, d)))


@query("w14_adaptive_trials", f"""WITH {TRIALS_SQL}, f AS (SELECT sample, max(score) - min(score) >= 0.4 AS more FROM trials WHERE trial <= 3 GROUP BY sample)
SELECT sample, count(*) AS used, round(avg(score), 6) AS mean FROM trials LEFT JOIN f USING (sample) WHERE trial <= 3 OR (trial <= 5 AND more) GROUP BY sample""")
def adaptive_trials(spark, d):
    t = trials(spark, d)
    first = t.filter("trial <= 3").groupBy("sample").agg((F.max("score") - F.min("score") >= 0.4).alias("more"))
    used = t.join(first, "sample", "left").filter((F.col("trial") <= 3) | ((F.col("trial") <= 5) & F.col("more")))
    return used.groupBy("sample").agg(F.count("*").alias("used"), F.round(F.avg("score"), 6).alias("mean"))


@query("w15_bounded_retries", """WITH a AS (SELECT user_id, event_id, event_type = 'error' AS failed, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM events),
ok AS (SELECT user_id, min(attempt) AS won FROM a WHERE NOT failed AND attempt <= 3 GROUP BY user_id)
SELECT a.user_id, attempt AS attempts, NOT failed AS passed FROM a LEFT JOIN ok USING (user_id) WHERE attempt = coalesce(won, least(3, (SELECT count(*) FROM events e WHERE e.user_id = a.user_id)))""")
def bounded_retries(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("failed"))
    from pyspark.sql import Window

    a = e.withColumn("attempt", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")).filter("attempt <= 3")
    g = a.groupBy("user_id").agg(F.min(F.when(~F.col("failed"), F.col("attempt"))).alias("won"), F.max("attempt").alias("last"))
    return g.select("user_id", F.coalesce("won", "last").alias("attempts"), F.col("won").isNotNull().alias("passed"))


@query("w16_remaining_slots", """SELECT o_orderkey, least(5 - o_orderkey % 7, 3 - o_orderkey % 4) AS slots, CASE WHEN o_totalprice > 150000 THEN 'request' WHEN o_orderkey % 5 = 0 THEN 'evaluation' WHEN o_orderstatus = 'P' THEN 'timeout' END AS reason FROM orders""")
def remaining_slots(spark, d):
    k = F.col("o_orderkey")
    reason = F.when(F.col("o_totalprice") > 150000, "request").when(k % 5 == 0, "evaluation").when(F.col("o_orderstatus") == "P", "timeout")
    return table(spark, d, "orders").select("o_orderkey", F.least(5 - k % 7, 3 - k % 4).alias("slots"), reason.alias("reason"))


@query("d3_effect_label", f"""WITH {ROUNDS_SQL} SELECT key, strategy, round(after - before, 4) AS delta, CASE WHEN before IS NULL OR after IS NULL THEN 'missing' WHEN after >= 0.99 THEN 'full' WHEN round(before - after, 4) >= 0.15 THEN 'dropped'
  WHEN round(before - after, 4) >= 0.05 THEN 'slight_drop' WHEN round(after - before, 4) >= 0.05 THEN 'increased' ELSE 'flat' END AS label FROM rounds""")
def effect_label(spark, d):
    return rules.effect_labels(rounds(spark, d)).select("key", "strategy", "delta", "label")
