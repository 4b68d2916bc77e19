"""Evidence operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, rules
from .catalog import query
from .tables import ROUNDS_SQL, rounds, table


@query("f5_first_present", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS found FROM events")
def first_present(spark, d):
    j = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"a":null,'), F.expr("substring(props, 2)"))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", evidence.first_present(j, ["a", "k"]).alias("found"))


@query("f6_missing_parts", """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'rubric' END, CASE WHEN o_orderkey % 5 = 0 THEN 'answer' END], lambda x: x IS NOT NULL), ',') AS missing FROM orders""")
def missing_parts(spark, d):
    k = F.col("o_orderkey")
    parts = evidence.missing_parts(rubric=F.when(k % 3 != 0, F.col("o_orderstatus")), answer=F.when(k % 5 == 0, "  ").otherwise("x"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(parts, ",").alias("missing"))


@query("f10_dangling_evidence", """WITH g AS (SELECT l_orderkey, list(DISTINCT l_linenumber) AS known, list(DISTINCT l_linenumber + l_partkey % 2) AS used FROM lineitem GROUP BY ALL),
x AS (SELECT l_orderkey, list_sort(list_filter(used, lambda u: NOT list_contains(known, u))) AS lost FROM g) SELECT l_orderkey, array_to_string(lost, ',') AS dangling, len(lost) = 0 AS valid FROM x""")
def dangling(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("known"), F.collect_set((F.col("l_linenumber") + F.col("l_partkey") % 2).cast("int")).alias("used"))
    return evidence.dangling(g, "l_orderkey", "used", "known")


@query("a20_compiled_cards", """WITH g AS (SELECT p_brand, p_type, count(*) AS facts, count(DISTINCT p_size) AS experiments, count(DISTINCT p_name) AS samples, round(avg((p_retailprice > 1000)::INT), 4) AS increased FROM part GROUP BY ALL)
SELECT *, CASE WHEN experiments < 2 OR samples < 3 THEN 'provisional' WHEN increased >= 0.6 THEN 'active' WHEN increased <= 0.4 THEN 'negative' ELSE 'mixed' END AS status FROM g""")
def compiled_cards(spark, d):
    return evidence.compiled_cards(table(spark, d, "part"), ["p_brand", "p_type"], "p_size", "p_name", F.col("p_retailprice") > 1000)


@query("a20_upserted_cards", """WITH o AS (SELECT c_nationkey AS card, count(*) AS v, 3 AS version FROM customer WHERE c_nationkey < 20 GROUP BY ALL), n AS (SELECT c_nationkey AS card, count(*) FILTER (c_nationkey % 2 = 0 OR c_acctbal > 0) AS v FROM customer WHERE c_nationkey > 3 GROUP BY ALL)
SELECT coalesce(o.card, n.card) AS card, CASE WHEN o.card IS NULL THEN 1 WHEN n.card IS NULL OR o.v = n.v THEN 3 ELSE 4 END::BIGINT AS version, CASE WHEN n.card IS NULL THEN 'retired' WHEN o.card IS NULL THEN 'inserted' WHEN o.v = n.v THEN 'kept' ELSE 'updated' END AS state FROM o FULL JOIN n USING (card)""")
def upserted_cards(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_nationkey", "card")
    old = c.filter("card < 20").groupBy("card").agg(F.count("*").alias("v")).withColumn("version", F.lit(3))
    new = c.filter("card > 3").groupBy("card").agg(F.count_if((F.col("card") % 2 == 0) | (F.col("c_acctbal") > 0)).alias("v"))
    return evidence.upserted_cards(old, new, "card", "v")


@query("a24_search_summary", """SELECT l_orderkey % 20 AS parent, count(DISTINCT l_orderkey) AS branches, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R' OR l_tax > 0.07) AS failed, date_diff('day', min(l_shipdate), max(l_shipdate)) AS days FROM lineitem GROUP BY ALL""")
def search_summary(spark, d):
    bad = (F.col("l_returnflag") == "R") | (F.col("l_tax") > 0.07)
    g = table(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 20).alias("parent"))
    return g.agg(F.count_distinct("l_orderkey").alias("branches"), F.count_distinct(F.when(bad, F.col("l_orderkey"))).alias("failed"), F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).cast("long").alias("days"))


@query("a26_evidence_pack", """SELECT artifact, count(*) AS n, substring(sha256(artifact || ':' || count(*)), 1, 12) AS id FROM (SELECT 'customer' AS artifact FROM customer UNION ALL SELECT 'orders' FROM orders UNION ALL SELECT 'part' FROM part) GROUP BY artifact""")
def evidence_pack(spark, d):
    parts = [table(spark, d, t).select(F.lit(t).alias("artifact")) for t in ("customer", "orders", "part")]
    g = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("artifact").agg(F.count("*").alias("n"))
    return g.withColumn("id", F.substring(F.sha2(F.concat("artifact", F.lit(":"), F.col("n").cast("string")), 256), 1, 12))


@query("d6_normalised_gain", """WITH x AS (SELECT p_partkey, p_size / 50 AS a, p_retailprice / 2000 AS b, (p_partkey % 10) / 10 AS c FROM part),
g AS (SELECT *, round(0.5::DOUBLE * least(1, greatest(0, a)) + 0.3::DOUBLE * least(1, greatest(0, b)) + 0.2::DOUBLE * c, 6) AS gain FROM x)
SELECT p_partkey, gain, CASE WHEN a < 0.1 OR c < 0.1 THEN 'fail' WHEN gain >= 0.75 THEN 'pass' WHEN gain >= 0.65 THEN 'borderline' ELSE 'fail' END AS label, concat_ws(',', CASE WHEN a < 0.1 THEN 'a' END, CASE WHEN c < 0.1 THEN 'c' END) AS below FROM g""")
def normalised_gain(spark, d):
    x = table(spark, d, "part").select("p_partkey", (F.col("p_size") / 50).alias("a"), (F.col("p_retailprice") / 2000).alias("b"), ((F.col("p_partkey") % 10) / 10).alias("c"))
    got = evidence.normalised_gain(x, {"a": ("a", 0.5), "b": ("b", 0.3), "c": ("c", 0.2)}, {"a": 0.1, "c": 0.1})
    return got.select("p_partkey", "gain", "label", "below")


@query("d7_complexity_gate", r"""WITH x AS (SELECT doc_id, list_filter([CASE WHEN n_chars < 300 THEN 'short' END, CASE WHEN n_chars > 8000 THEN 'long' END, CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN contains(text, '!!') THEN 'shout' END], lambda r: r IS NOT NULL) AS r FROM documents)
SELECT doc_id, r[1] AS reject_type, len(r) AS n_reasons, len(r) = 0 AS passed FROM x""")
def complexity_gate(spark, d):
    n, has = F.col("n_chars"), lambda x: F.contains("text", F.lit(x))
    return evidence.gate(table(spark, d, "documents"), [(n < 300, "short"), (n > 8000, "long"), (has(" | "), "table"), (has("!!"), "shout")]).select("doc_id", "reject_type", "n_reasons", "passed")


@query("d11_proposals", f"""WITH {ROUNDS_SQL}, l AS (SELECT CASE WHEN before IS NULL OR after IS NULL THEN 'missing' WHEN after >= 0.99 THEN 'full' WHEN round(before - after, 4) >= 0.15 THEN 'dropped'
  WHEN round(before - after, 4) >= 0.05 THEN 'slight_drop' WHEN round(after - before, 4) >= 0.05 THEN 'increased' ELSE 'flat' END AS label FROM rounds),
g AS (SELECT CASE label WHEN 'dropped' THEN 'strategy' WHEN 'slight_drop' THEN 'strategy' WHEN 'increased' THEN 'sample' WHEN 'missing' THEN 'data' ELSE 'none' END AS level, label FROM l)
SELECT level, count(*) AS n, count(DISTINCT label) AS labels, CASE WHEN count(*) >= 3 THEN 'strong' WHEN count(*) >= 2 THEN 'medium' ELSE 'weak' END AS strength FROM g GROUP BY level""")
def proposals(spark, d):
    return evidence.proposals(rules.effect_labels(rounds(spark, d)), "label", {"dropped": "strategy", "slight_drop": "strategy", "increased": "sample", "missing": "data"})


@query("d13_mixed_scopes", "SELECT c_nationkey AS scope, count(DISTINCT c_mktsegment) AS worlds, count(DISTINCT c_mktsegment) > 1 AS mixed FROM customer GROUP BY ALL")
def mixed_scopes(spark, d):
    g = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("scope")).agg(F.count_distinct("c_mktsegment").alias("worlds"))
    return g.withColumn("mixed", F.col("worlds") > 1)


@query("u4_stable_order", "SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS place FROM part")
def stable_order(spark, d):
    """All rows in one order: sorted by range, numbered inside a size after those of larger ones (one row per size)."""
    from pyspark.sql import Window

    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    sizes = p.groupBy("p_size").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("p_size")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("p_size").orderBy("p_partkey"))
    placed = p.join(F.broadcast(sizes.select("p_size", before.alias("before"))), "p_size")  # sizes are a fixed few
    return placed.select("p_partkey", "p_brand", (inside + F.col("before")).cast("long").alias("place")).orderBy("place")


@query("x13_safe_projection", "SELECT c_custkey, '***' AS c_name, c_mktsegment FROM customer")
def safe_projection(spark, d):
    return evidence.projected(table(spark, d, "customer"), ["c_custkey", "c_name", "c_mktsegment"], ["name"])


@query("t6_two_phase_scores", """WITH d AS (SELECT l_orderkey, sum(l_quantity) / (50 * count(*)) AS rate FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL), e AS (SELECT l_orderkey, count(*) AS later FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)
SELECT d.l_orderkey, round(rate, 6) AS score_rate, coalesce(later, 0) AS experimental, later IS NULL AS pending FROM d LEFT JOIN e USING (l_orderkey)""")
def two_phase_scores(spark, d):
    li = table(spark, d, "lineitem")
    decided = li.filter("l_linestatus = 'F'").groupBy("l_orderkey").agg((F.sum("l_quantity") / (50 * F.count("*"))).alias("rate"))
    later = li.filter("l_linestatus = 'O'").groupBy("l_orderkey").agg(F.count("*").alias("later"))
    return decided.join(later, "l_orderkey", "left").select("l_orderkey", F.round("rate", 6).alias("score_rate"), F.coalesce("later", F.lit(0)).alias("experimental"), F.col("later").isNull().alias("pending"))
