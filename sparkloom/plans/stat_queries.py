"""Statistics operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules, stats
from .catalog import query
from .tables import JUDGEMENTS_SQL, ROUNDS_SQL, TRIALS_SQL, judgements, rounds, table, trials

LABEL_SQL = """CASE WHEN before IS NULL OR after IS NULL THEN 'missing' WHEN after >= 0.99 THEN 'full' WHEN round(before - after, 4) >= 0.15 THEN 'dropped'
  WHEN round(before - after, 4) >= 0.05 THEN 'slight_drop' WHEN round(after - before, 4) >= 0.05 THEN 'increased' ELSE 'flat' END"""


@query("a3_trial_summary", f"""WITH {TRIALS_SQL}, g AS (SELECT sample, count(*) AS n, round(avg(score), 6) AS mean, median(score) AS median, round(stddev_pop(score), 6) AS std,
  min(score) AS low, max(score) AS high, round(quantile_cont(score, 0.75), 6) AS p75, count(*) FILTER (score >= 0.999) AS n_full, count(*) FILTER (score >= 0.8) AS n_high
  FROM trials GROUP BY sample) SELECT *, round(high - low, 6) AS spread, round(greatest(median, p75 - 0.03), 6) AS admission FROM g""")
def trial_summary(spark, d):
    return stats.trial_summary(trials(spark, d))


@query("a4_item_stability", f"""WITH {TRIALS_SQL} SELECT trial AS position, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std,
  count(*) FILTER (score >= 0.5) AS hits, count(*) FILTER (score < 0.5) AS misses FROM trials GROUP BY trial""")
def item_stability(spark, d):
    return stats.item_stability(trials(spark, d))


@query("a5_stability_report", f"""WITH {TRIALS_SQL}, g AS (SELECT sample, median(score) AS m, max(score) AS h, avg(score) AS a FROM trials GROUP BY sample)
SELECT m >= 0.8 AS legacy, h >= 0.8 AS stable, count(*) AS n, round(avg(abs(h - a)), 6) AS mean_shift, round(max(abs(h - a)), 6) AS max_shift FROM g GROUP BY ALL""")
def stability_report(spark, d):
    g = trials(spark, d).groupBy("sample").agg(F.median("score").alias("m"), F.max("score").alias("h"), F.avg("score").alias("a"))
    shift = F.abs(F.col("h") - F.col("a"))
    return g.groupBy((F.col("m") >= 0.8).alias("legacy"), (F.col("h") >= 0.8).alias("stable")).agg(
        F.count("*").alias("n"), F.round(F.avg(shift), 6).alias("mean_shift"), F.round(F.max(shift), 6).alias("max_shift")
    )


@query("a6_representative_trial", f"""WITH {TRIALS_SQL}, m AS (SELECT sample, median(score) AS median FROM trials GROUP BY sample)
SELECT sample, m.median, arg_min(trial, (abs(score - m.median), trial)) AS representative FROM trials JOIN m USING (sample) GROUP BY ALL""")
def representative_trial(spark, d):
    return stats.representative_trial(trials(spark, d))


@query("a7_pooled_judgements", f"""WITH {JUDGEMENTS_SQL}, t AS (SELECT sample, trial, sum(awarded) AS a, sum(possible) AS p, count(*) AS c FROM judgements GROUP BY ALL),
s AS (SELECT sample, sum(c)::BIGINT AS judgements, sum(a) / sum(p) AS mean FROM t GROUP BY ALL)
SELECT sample, judgements, round(mean, 6) AS pooled_mean, arg_min(trial, (round(abs(a / p - mean), 9), trial)) AS representative FROM t JOIN s USING (sample) GROUP BY ALL""")
def pooled_judgements(spark, d):
    return stats.pooled_judgements(judgements(spark, d))


@query("a8_judge_spread", f"""WITH {JUDGEMENTS_SQL} SELECT sample, trial, count(*) AS repeats, round(avg(awarded / possible), 6) AS mean, min(awarded / possible) AS low,
  max(awarded / possible) AS high, round(max(awarded / possible) - min(awarded / possible), 6) AS spread FROM judgements GROUP BY ALL""")
def judge_spread(spark, d):
    return stats.judge_spread(judgements(spark, d))


@query("a9_gap_percentile", f"""WITH {TRIALS_SQL}, g AS (SELECT trial % 3 AS kind, list(round(score, 4) ORDER BY score) AS v FROM trials GROUP BY ALL)
SELECT kind, len(v) AS n, v[floor(0.9 * (len(v) - 1))::INT + 1] AS p90 FROM g""")
def gap_percentile(spark, d):
    g = trials(spark, d).groupBy((F.col("trial") % 3).alias("kind")).agg(F.collect_list(F.round("score", 4)).alias("v"))
    return g.select("kind", F.size("v").cast("long").alias("n"), stats.index_percentile(F.col("v"), 0.9, False).alias("p90"))


@query("a10_yield_statistics", """WITH l AS (SELECT event_type AS operator, value > 10 AS hit, event_type = 'error' AS error, value AS seconds, (user_id % 4)::VARCHAR AS a, (user_id % 3)::VARCHAR AS b FROM events),
u AS (SELECT 'all' AS field, 'all' AS value, * FROM l UNION ALL SELECT 'a', a, * FROM l UNION ALL SELECT 'b', b, * FROM l)
SELECT field, value, operator, count(*) AS attempts, count(*) FILTER (hit) AS hits, count(*) FILTER (error) AS errors, round(sum(seconds), 2) AS seconds,
  round(count(*) FILTER (hit) * 3600.0 / round(sum(seconds), 2), 4) AS hits_per_hour FROM u GROUP BY ALL""")
def yield_statistics(spark, d):
    e = table(spark, d, "events").select(
        F.col("event_type").alias("operator"), (F.col("value") > 10).alias("hit"), (F.col("event_type") == "error").alias("error"), F.col("value").alias("seconds"),
        (F.col("user_id") % 4).cast("string").alias("a"), (F.col("user_id") % 3).cast("string").alias("b"),
    )
    return stats.yield_statistics(e, ["a", "b"])


@query("a11_repeat_medians", """WITH r AS (SELECT (user_id % 8) AS run, CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'optimised' END AS side, round(sum(value), 2) AS total, round(max(value), 2) AS longest FROM events GROUP BY ALL),
u AS (SELECT run, side, 'total' AS metric, total AS reading FROM r UNION ALL SELECT run, side, 'longest', longest FROM r)
SELECT metric, count(*) AS readings, round(median(CASE WHEN side = 'baseline' THEN reading END), 4) AS baseline, round(median(CASE WHEN side <> 'baseline' THEN reading END), 4) AS optimised,
  round(min(reading), 4) AS low, round(max(reading), 4) AS high, round(round(median(CASE WHEN side = 'baseline' THEN reading END), 4) / round(median(CASE WHEN side <> 'baseline' THEN reading END), 4), 4) AS speedup
FROM u GROUP BY metric HAVING count(*) >= 6""")
def repeat_medians(spark, d):
    side = F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("optimised")
    r = table(spark, d, "events").groupBy((F.col("user_id") % 8).alias("run"), side.alias("side")).agg(F.round(F.sum("value"), 2).alias("total"), F.round(F.max("value"), 2).alias("longest"))
    return stats.repeat_medians(r, "run", "side")


ROLLUP_SQL = """SELECT user_id, CASE WHEN max(ts) FILTER (event_type = 'purchase') >= min(ts) FILTER (event_type = 'click') THEN
  date_sub('second', min(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase')) END AS latency,
  count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY user_id"""


@query("a12_event_rollup", ROLLUP_SQL)
def event_rollup(spark, d):
    return stats.event_rollup(table(spark, d, "events"), "user_id", "click", "purchase")


@query("a12_latency_percentiles", f"""WITH r AS ({ROLLUP_SQL}), v AS (SELECT list(latency ORDER BY latency) FILTER (latency IS NOT NULL) AS v FROM r)
SELECT len(v) AS n, v[round_even((len(v) - 1) * 0.5, 0)::INT + 1] AS p50, v[round_even((len(v) - 1) * 0.95, 0)::INT + 1] AS p95 FROM v""")
def latency_percentiles(spark, d):
    return stats.latency_percentiles(stats.event_rollup(table(spark, d, "events"), "user_id", "click", "purchase"))


@query("a13_pair_order", """WITH p AS (SELECT a.event_type AS x, b.event_type AS y, a.value < b.value AS hit FROM events a JOIN events b ON a.event_id + 1 = b.event_id),
o AS (SELECT x, y, count(*) AS n, count(*) FILTER (hit) AS hits FROM p GROUP BY ALL)
SELECT concat_ws('>', o.x, o.y) AS pair, concat_ws('+', least(o.x, o.y), greatest(o.x, o.y)) AS unordered, o.n, round(o.hits / o.n, 4) AS hit_rate, r.n AS reverse_n
FROM o LEFT JOIN o r ON r.x = o.y AND r.y = o.x""")
def pair_order(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    after = e.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("y"), F.col("value").alias("v"))
    o = e.withColumnRenamed("event_type", "x").join(after, "event_id").groupBy("x", "y").agg(F.count("*").alias("n"), F.count_if(F.col("value") < F.col("v")).alias("hits"))
    r = o.select(F.col("y").alias("x"), F.col("x").alias("y"), F.col("n").alias("reverse_n"))
    return o.join(r, ["x", "y"], "left").select(
        F.concat_ws(">", "x", "y").alias("pair"), F.concat_ws("+", F.least("x", "y"), F.greatest("x", "y")).alias("unordered"), "n", F.round(F.col("hits") / F.col("n"), 4).alias("hit_rate"), "reverse_n"
    )


@query("a14_top_reasons", """SELECT p_brand, p_type, n, place FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS place
  FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)) WHERE place <= 5""")
def top_reasons(spark, d):
    return stats.top_reasons(table(spark, d, "part"), "p_brand", "p_type")


@query("a15_selection_report", """SELECT count(*) AS n, count(*) FILTER (quality = 1) AS selected, round(count(*) FILTER (quality = 1) / count(*), 4) AS selected_rate,
  round(count(*) FILTER (toxic = 1) / count(*), 4) AS rejected_rate FROM labels""")
def selection_report(spark, d):
    n = F.count("*")
    return table(spark, d, "labels").agg(
        n.alias("n"), F.count_if(F.col("quality") == 1).alias("selected"),
        F.round(F.count_if(F.col("quality") == 1) / n, 4).alias("selected_rate"), F.round(F.count_if(F.col("toxic") == 1) / n, 4).alias("rejected_rate"),
    )


@query("a16_histogram", """SELECT concat_ws('+', o_orderstatus, o_orderpriority) AS bucket, count(*) AS n FROM orders GROUP BY ALL""")
def histogram(spark, d):
    return stats.histogram(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@query("a18_evidence_metrics", f"""WITH {ROUNDS_SQL} SELECT strategy, count(*) AS n, count(*) FILTER (before IS NOT NULL AND after IS NOT NULL) AS paired,
  round(avg(coalesce(nullif(before, 0), after)), 4) AS mean_either FROM rounds GROUP BY strategy""")
def evidence_metrics(spark, d):
    either = F.coalesce(F.nullif(F.col("before"), F.lit(0.0)), F.col("after"))
    return rounds(spark, d).groupBy("strategy").agg(
        F.count("*").alias("n"), F.count_if(F.col("before").isNotNull() & F.col("after").isNotNull()).alias("paired"), F.round(F.avg(either), 4).alias("mean_either")
    )


@query("a19_status_crosstab", """WITH g AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY ALL)
SELECT *, CASE greatest("F", "O", "P") WHEN "F" THEN 'F' WHEN "O" THEN 'O' ELSE 'P' END AS mode FROM g""")
def status_crosstab(spark, d):
    return stats.status_crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("a21_unstable_groups", """SELECT user_id, n, kinds FROM (SELECT user_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, list(DISTINCT event_type) AS k FROM events GROUP BY user_id)
WHERE list_contains(k, 'error') AND list_contains(k, 'purchase')""")
def unstable_groups(spark, d):
    return stats.unstable_groups(table(spark, d, "events"), ["user_id"], "event_type", ("error", "purchase"))


@query("a22_merged_counts", """WITH a AS (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL), b AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY ALL)
SELECT coalesce(a.nation, b.nation) AS nation, CASE WHEN coalesce(a.n, 0) > 0 THEN a.n ELSE coalesce(b.n, 0) END AS n FROM a FULL JOIN b ON a.nation = b.nation""")
def merged_counts(spark, d):
    a = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    return stats.merged_counts(a, b, ["nation"])


@query("a23_round_metrics", """WITH s AS (SELECT date_trunc('day', ts) AS round, value / 20 AS score, event_type = 'purchase' AS effective, event_type <> 'error' AS continued FROM events),
g AS (SELECT round, round(avg(score), 4) AS mean, count(*) FILTER (effective) AS effective, count(*) FILTER (continued) AS continued FROM s GROUP BY s.round),
f AS (SELECT *, coalesce((abs(mean - lag(mean) OVER (ORDER BY round)) < 0.01)::INT, 0) AS flat FROM g),
i AS (SELECT *, sum(1 - flat) OVER (ORDER BY round) AS island FROM f)
SELECT round, mean, effective, continued, (sum(flat) OVER (PARTITION BY island ORDER BY round))::BIGINT AS flat_rounds, mean < 0.5 AS stop FROM i""")
def round_metrics(spark, d):
    e = table(spark, d, "events")
    s = e.select(F.date_trunc("day", "ts").alias("round"), (F.col("value") / 20).alias("score"), (F.col("event_type") == "purchase").alias("effective"), (F.col("event_type") != "error").alias("continued"))
    return stats.round_metrics(s, "round")


@query("a25_micro_average", f"""WITH {JUDGEMENTS_SQL} SELECT sample, round(sum(awarded) / sum(possible), 6) AS rate, count(*) AS n FROM judgements GROUP BY sample""")
def micro_average(spark, d):
    return stats.micro_average(judgements(spark, d), "sample", "awarded", "possible")


@query("a27_stage_metrics", """SELECT event_type AS stage, count(*) AS processed, count(*) FILTER (value IS NULL) AS hits, greatest(0.000001, round(sum(value), 6)) AS seconds FROM events GROUP BY ALL""")
def stage_metrics(spark, d):
    g = table(spark, d, "events").groupBy(F.col("event_type").alias("stage"))
    return g.agg(F.count("*").alias("processed"), F.count_if(F.col("value").isNull()).alias("hits"), F.greatest(F.lit(0.000001), F.round(F.sum("value"), 6)).alias("seconds"))
