"""Decision tables, field resolution and record checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from .catalog import query
from .tables import table


@query("d1_five_way_action", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'stop' WHEN s IS NULL THEN 'review' WHEN s >= 0.8 THEN 'rewrite' WHEN s <= 0.6 THEN 'keep' ELSE 'retry' END AS action,
  coalesce('score=' || printf('%.4f', s), 'no score') AS reason FROM (SELECT *, nullif(o_orderkey % 101, 7) / 100.0::DOUBLE AS s FROM orders)""")
def five_way_action(spark, d):
    o = table(spark, d, "orders").withColumn("s", F.nullif(F.col("o_orderkey") % 101, F.lit(7)) / 100.0)
    return rules.five_way_action(o, "s", F.col("o_orderstatus") == "F").select("o_orderkey", "action", "reason")


@query("f1_score_rates", """WITH r AS (SELECT l_orderkey, l_linenumber, max(l_tax) * 20 AS given, sum(l_quantity) AS awarded, sum(l_quantity - 10) AS possible, CASE WHEN min(l_discount) > 0.02 THEN min(l_discount) * 9 END AS stable FROM lineitem GROUP BY ALL),
c AS (SELECT *, CASE WHEN possible > 0 THEN awarded / possible END AS ratio, CASE WHEN given BETWEEN 0 AND 1 THEN given END AS g, CASE WHEN stable BETWEEN 0 AND 1 THEN stable END AS s FROM r)
SELECT l_orderkey, l_linenumber, round(coalesce(g, least(1, greatest(0, ratio)), s), 6) AS strict, round(coalesce(ratio, given), 6) AS loose,
  round(coalesce(s, g, CASE WHEN ratio IS NOT NULL THEN least(1, greatest(0, ratio)) END), 6) AS stable_first, round(CASE WHEN ratio IS NOT NULL THEN least(1, greatest(0, ratio)) END, 6) AS ratio FROM c""".replace("coalesce(g, least(1, greatest(0, ratio)), s)", "coalesce(g, CASE WHEN ratio IS NOT NULL THEN least(1, greatest(0, ratio)) END, s)"))
def score_rates(spark, d):
    r = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        (F.max("l_tax") * 20).alias("given"), F.sum("l_quantity").alias("awarded"), F.sum(F.col("l_quantity") - 10).alias("possible"), F.min("l_discount").alias("m")
    )
    stable = F.when(F.col("m") > 0.02, F.col("m") * 9)
    names = ("strict", "loose", "stable_first", "ratio")
    return r.select("l_orderkey", "l_linenumber", *[F.round(rules.resolved_rate(F.col("given"), F.col("awarded"), F.col("possible"), stable, v), 6).alias(v) for v in names])


@query("f2_score_coercion", """SELECT event_id, CASE WHEN value / 50 BETWEEN 0 AND 1 THEN value / 50 END AS in_unit, least(1, greatest(0, value / 50 - 0.1)) AS clamped FROM events""")
def score_coercion(spark, d):
    v = F.col("value") / 50
    return table(spark, d, "events").select("event_id", rules.in_unit(v).alias("in_unit"), rules.clamp(v - 0.1).alias("clamped"))


@query("f3_clean_text", r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(coalesce(' ' || chr(9) || text || chr(10), ''), '^[\s]+', ''), '[\s]+$', '')) AS h FROM documents""")
def clean_text(spark, d):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("\n"))
    return table(spark, d, "documents").select("doc_id", F.sha2(rules.clean(padded), 256).alias("h"))


@query("f4_identity_keys", """SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN 'id-' || doc_id END, CASE WHEN doc_id % 5 = 0 THEN source END, substring(sha256(text), 1, 16)) AS key FROM documents""")
def identity_keys(spark, d):
    k = F.col("doc_id")
    first, second = F.when(k % 3 == 0, F.concat(F.lit("id-"), k.cast("string"))), F.when(k % 5 == 0, F.col("source")).otherwise(F.lit("  "))
    return table(spark, d, "documents").select("doc_id", rules.identity(first, second, text=F.col("text")).alias("key"))


@query("f9_contract_survivors", """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS seen FROM lineitem)
SELECT l_orderkey, count(*) FILTER (seen > 1) AS duplicates, count(*) FILTER (seen = 1 AND l_quantity < 5) AS invalid, array_to_string(list(l_linenumber ORDER BY l_quantity, l_linenumber) FILTER (seen = 1 AND l_quantity >= 5), ',') AS survivors FROM c GROUP BY l_orderkey""")
def contract_survivors(spark, d):
    first = F.min_by(F.col("l_quantity"), F.struct("l_partkey", "l_suppkey", "l_quantity"))
    per = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(first.alias("q"), (F.count("*") - 1).alias("more"))
    kept = F.sort_array(F.collect_list(F.when(F.col("q") >= 5, F.struct("q", "l_linenumber"))))
    g = per.groupBy("l_orderkey").agg(F.sum("more").alias("duplicates"), F.count_if(F.col("q") < 5).alias("invalid"), kept.alias("k"))
    text = F.array_join(F.transform("k", lambda x: x["l_linenumber"].cast("string")), ",")
    return g.select("l_orderkey", "duplicates", "invalid", F.when(F.size("k") > 0, text).alias("survivors"))


@query("f13_eligibility", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'too_large' WHEN p_type = 'ECONOMY' THEN 'excluded_type' WHEN p_retailprice > 1500 THEN 'too_expensive' END AS reason FROM part""")
def eligibility(spark, d):
    r = [(F.col("p_size") > 40, "too_large"), (F.col("p_type") == "ECONOMY", "excluded_type"), (F.col("p_retailprice") > 1500, "too_expensive")]
    return table(spark, d, "part").select("p_partkey", F.nullif(rules.first_match(r, ""), F.lit("")).alias("reason"))


@query("f14_snapshot", """SELECT doc_id, lang AS old_lang, 'x' AS lang, 'qv_' || substring(sha256(source || '!'), 1, 16) AS version FROM documents""")
def snapshot(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    s = rules.with_snapshot(docs, ["lang", "source"], {"lang": F.lit("x"), "source": F.concat("source", F.lit("!"))}, "source")
    return s.select("doc_id", F.col("snapshot.lang").alias("old_lang"), "lang", "version")


@query("f15_restore", "SELECT doc_id, lang, source FROM documents")
def restore(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return rules.restored(rules.with_snapshot(docs, ["lang", "source"], {"lang": F.lit(None).cast("string"), "source": F.lit("new")}, "source"), ["lang", "source"])


@query("f16_version_check", """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'N' AND (l_returnflag IS DISTINCT FROM l_linestatus OR l_returnflag IS DISTINCT FROM 'F')""")
def version_check(spark, d):
    expected = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return table(spark, d, "lineitem").filter(rules.version_mismatch(expected, F.col("l_linestatus"), F.lit("F"))).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("d8_next_states", """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'retry' ELSE 'continue' END AS status, CASE event_type WHEN 'purchase' THEN 'archive' WHEN 'error' THEN 'inspect' WHEN 'view' THEN 'observe' END AS hint FROM events""")
def next_states(spark, d):
    t = F.col("event_type")
    hints = spark.createDataFrame([("purchase", "archive"), ("error", "inspect"), ("view", "observe")], "event_type string, hint string")  # a fixed table
    status = rules.first_match([(t == "purchase", "done"), (t == "error", "retry")], "continue")
    return table(spark, d, "events").join(F.broadcast(hints), "event_type", "left").select("event_id", status.alias("status"), "hint")


@query("d10_behaviour_labels", """SELECT l_orderkey, array_to_string(CASE WHEN max(l_tax) > 0.07 THEN ['blocked'] ELSE list_filter([CASE WHEN max(l_quantity) - min(l_quantity) > 30 THEN 'disputed' END, CASE WHEN max(l_discount) > 0.08 THEN 'penalised' END, CASE WHEN count(*) < 3 THEN 'sparse' END], lambda x: x IS NOT NULL) END, ',') AS labels FROM lineitem GROUP BY l_orderkey""")
def behaviour_labels(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_tax").alias("t"), (F.max("l_quantity") - F.min("l_quantity")).alias("r"), F.max("l_discount").alias("x"), F.count("*").alias("n"))
    content = rules.reasons([(F.col("r") > 30, "disputed"), (F.col("x") > 0.08, "penalised"), (F.col("n") < 3, "sparse")])
    labels = F.when(F.col("t") > 0.07, F.array(F.lit("blocked"))).otherwise(content)
    return g.select("l_orderkey", F.array_join(labels, ",").alias("labels"))
