"""Join, tree and set operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, rules, tree
from .catalog import query
from .tables import table


@query("j1_before_after", """WITH b AS (SELECT user_id, arg_max(value, event_id) AS before FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT event_id, e.user_id, value AS now, before FROM events e LEFT JOIN b USING (user_id) WHERE event_type = 'click'""")
def before_after(spark, d):
    e = table(spark, d, "events")
    before = e.filter("event_type = 'view'").select("user_id", "event_id", F.col("value").alias("before"))
    now = e.filter("event_type = 'click'").select("event_id", "user_id", F.col("value").alias("now"))
    return joins.before_after(now, before.withColumnRenamed("event_id", "seq"), "user_id", "seq")


@query("j2_rubric_alignment", """SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, a.t AS left_title, b.t AS right_title, a.n AS wanted, b.n AS given
FROM (SELECT p_brand, p_type AS t, count(*) AS n FROM part WHERE p_size < 25 GROUP BY ALL) a FULL JOIN (SELECT p_brand, lower(p_type) || ' ' AS t, count(*) AS n FROM part WHERE p_size >= 20 GROUP BY ALL) b
ON a.p_brand = b.p_brand AND lower(trim(a.t)) = lower(trim(b.t))""")
def rubric_alignment(spark, d):
    p = table(spark, d, "part")
    a = p.filter("p_size < 25").groupBy("p_brand", F.col("p_type").alias("title")).agg(F.count("*").alias("wanted"))
    b = p.filter("p_size >= 20").groupBy("p_brand", F.concat(F.lower("p_type"), F.lit(" ")).alias("title")).agg(F.count("*").alias("given"))
    return joins.aligned(a, b, ["p_brand"], "title").select("p_brand", "left_title", "right_title", "wanted", "given")


@query("j3_best_against_worst", """WITH t AS (SELECT l_orderkey AS sample, l_linenumber AS trial, max(l_quantity) AS q, max(l_discount) AS item FROM lineitem GROUP BY ALL)
SELECT sample, arg_max(trial, (q, -trial)) AS best, arg_min(trial, (q, trial)) AS worst, max(q) - min(q) AS gap, round(arg_max(item, (q, -trial)) - arg_min(item, (q, trial)), 4) AS item_gap FROM t GROUP BY sample HAVING count(*) > 1""")
def best_against_worst(spark, d):
    t = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("trial")).agg(F.max("l_quantity").alias("q"), F.max("l_discount").alias("item"))
    up, down = F.struct("q", -F.col("trial")), F.struct("q", "trial")
    g = t.groupBy("sample").agg(
        F.max_by("trial", up).alias("best"), F.min_by("trial", down).alias("worst"), (F.max("q") - F.min("q")).alias("gap"),
        F.round(F.max_by("item", up) - F.min_by("item", down), 4).alias("item_gap"), F.count("*").alias("n"),
    )
    return g.filter("n > 1").drop("n")


SIGNATURES = """SELECT o_orderkey AS id, o_orderstatus AS f1, nullif(o_orderpriority, '5-LOW') AS f2, c_mktsegment AS f3, c_nationkey::VARCHAR AS f4 FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("j4_signature_similarity", f"""WITH s AS ({SIGNATURES}), c AS (SELECT f1, f2, f3, f4, count(*) AS n, min(id) AS first FROM s GROUP BY ALL), p AS (SELECT a.id AS a, b.first AS b, b.n,
  coalesce((a.f1 = b.f1)::INT, 0) + coalesce((a.f2 = b.f2)::INT, 0) + coalesce((a.f3 = b.f3)::INT, 0) + coalesce((a.f4 = b.f4)::INT, 0) AS same,
  (a.f1 IS NOT NULL AND b.f1 IS NOT NULL)::INT + (a.f2 IS NOT NULL AND b.f2 IS NOT NULL)::INT + (a.f3 IS NOT NULL AND b.f3 IS NOT NULL)::INT + (a.f4 IS NOT NULL AND b.f4 IS NOT NULL)::INT AS total
  FROM s a, c b WHERE a.id % 50 = 0) SELECT a, b, same / total AS share, n FROM p WHERE same >= 0.75 * total""")
def signature_similarity(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    s = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("f1"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("f2"), F.col("c_mktsegment").alias("f3"), F.col("c_nationkey").cast("string").alias("f4")
    )
    # Every fiftieth order asks all orders; orders with equal fields are one class, shown by its smallest id and its size.
    classes = s.groupBy("f1", "f2", "f3", "f4").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    found = joins.signature_similarity(s.filter("id % 50 = 0"), classes, ["f1", "f2", "f3", "f4"])
    return found.join(classes.select(F.col("id").alias("b"), "n"), "b").select("a", "b", "share", "n")


@query("j5_recent_failures", """WITH r AS (SELECT event_id AS id, user_id, event_type, day(ts) AS now FROM events WHERE event_type <> 'error'), l AS (SELECT user_id, day(ts) AS round FROM events WHERE event_type = 'error'),
g AS (SELECT id, count(*) AS failures FROM r JOIN l USING (user_id) WHERE now - round BETWEEN 0 AND 2 GROUP BY id) SELECT *, CASE WHEN failures >= 3 THEN 'avoid' WHEN failures = 2 THEN 'downrank' ELSE 'warn' END AS advice FROM g""")
def recent_failures(spark, d):
    e = table(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    rows = e.filter("event_type <> 'error'").select(F.col("event_id").alias("id"), "user_id", F.col("day").alias("now"))
    return joins.recent_failures(rows, e.filter("event_type = 'error'").select("user_id", F.col("day").alias("round")), ["user_id"], 2)


@query("j6_holdout_effects", """WITH c AS (SELECT n_regionkey AS candidate, n_nationkey AS root FROM nation), op AS (SELECT DISTINCT n_regionkey AS candidate, c_mktsegment AS operator FROM nation JOIN customer ON n_nationkey = c_nationkey WHERE c_acctbal > 9000)
SELECT op.candidate, operator, count(*) AS held_out, round(sum(c_acctbal), 2) AS total FROM customer JOIN op ON c_mktsegment = operator WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.candidate = op.candidate AND c.root = c_nationkey) GROUP BY ALL""")
def holdout_effects(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    seen = n.join(c.filter("c_acctbal > 9000"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_regionkey").agg(F.collect_set("c_mktsegment").alias("operators"))
    own = n.groupBy("n_regionkey").agg(F.collect_list("n_nationkey").alias("roots"))
    cand = seen.join(own, "n_regionkey").withColumnRenamed("n_regionkey", "candidate")
    effects = c.select(F.col("c_mktsegment").alias("operator"), F.col("c_nationkey").alias("root"), "c_acctbal")
    return joins.holdout(effects, cand, "operator", "root").groupBy("candidate", "operator").agg(F.count("*").alias("held_out"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("j7_induction", """WITH g AS (SELECT p_brand, p_size % 5 AS kind, p_type, count(*) AS support, count(DISTINCT p_name) AS roots FROM part GROUP BY ALL),
s AS (SELECT p_brand, count(*) AS scope_rows FROM part GROUP BY ALL), o AS (SELECT p_brand, p_type, count(*) AS own_rows FROM part GROUP BY ALL)
SELECT p_brand, kind, p_type, support, roots, scope_rows - own_rows AS counterexamples, roots >= 2 AND scope_rows - own_rows >= 1 AS accepted FROM g JOIN s USING (p_brand) JOIN o USING (p_brand, p_type)""")
def induction(spark, d):
    p = table(spark, d, "part").withColumn("kind", F.col("p_size") % 5)
    return joins.induced(p, ["p_brand", "kind"], ["p_brand"], "p_type", "p_name")


@query("j8_wildcard_audit", """WITH r AS (SELECT o_orderkey, o_orderpriority AS scope FROM orders), k AS (SELECT r_regionkey AS card, CASE r_regionkey WHEN 0 THEN '' WHEN 1 THEN '1-URGENT' WHEN 2 THEN '5-LOW' WHEN 3 THEN '1-URGENT' ELSE '3-MEDIUM' END AS scope FROM region)
SELECT o_orderkey, r.scope, card FROM r JOIN k ON k.scope = '' OR k.scope = r.scope""")
def wildcard_audit(spark, d):
    routes = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("scope"))
    k = F.col("r_regionkey")
    scope = F.when(k == 0, "").when(k == 1, "1-URGENT").when(k == 2, "5-LOW").when(k == 3, "1-URGENT").otherwise("3-MEDIUM")
    return joins.wildcard_join(routes, table(spark, d, "region").select(k.alias("card"), scope.alias("scope")), "scope")


@query("j9_decision_merge", """WITH f AS (SELECT l_orderkey, l_linenumber, arg_min(l_quantity, (l_partkey, l_suppkey, l_quantity)) AS child FROM lineitem GROUP BY ALL), p AS (SELECT o_orderkey, round(o_totalprice % 50, 0) AS parent FROM orders)
SELECT l_orderkey, count(*) FILTER (child < parent) AS decreased, count(*) FILTER (child > parent) AS increased, count(*) FILTER (child = parent) AS unchanged FROM f JOIN p ON l_orderkey = o_orderkey GROUP BY l_orderkey""")
def decision_merge(spark, d):
    first = F.min_by("l_quantity", F.struct("l_partkey", "l_suppkey", "l_quantity"))
    f = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(first.alias("child"))
    p = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.round(F.col("o_totalprice") % 50, 0).alias("parent"))
    c = lambda x: F.count_if(x)
    return f.join(p, "l_orderkey").groupBy("l_orderkey").agg(c(F.col("child") < F.col("parent")).alias("decreased"), c(F.col("child") > F.col("parent")).alias("increased"), c(F.col("child") == F.col("parent")).alias("unchanged"))


@query("j10_fork_join", """SELECT a.doc_id, a.n_chars, b.quality, b.toxic FROM documents a JOIN labels b USING (doc_id)""")
def fork_join(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")


@query("j11_route_conflicts", """SELECT c_custkey, c_nationkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IS DISTINCT FROM CASE n_regionkey WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'HOUSEHOLD' END""")
def route_conflicts(spark, d):
    r = F.col("n_regionkey")
    frozen = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(r == 0, "BUILDING").when(r == 1, "HOUSEHOLD").alias("c_mktsegment"))
    return joins.conflicts(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), frozen, "c_nationkey", ["c_mktsegment"])


@query("j12_stale_priors", """SELECT a.event_type, count(*) AS priors, count(*) FILTER (a.value IS DISTINCT FROM b.value OR a.event_type IS DISTINCT FROM b.event_type) AS stale FROM events a JOIN events b ON a.event_id = b.event_id - 150 AND a.user_id = b.user_id GROUP BY a.event_type""")
def stale_priors(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    later = e.select((F.col("event_id") - 150).alias("event_id"), "user_id", F.col("event_type").alias("t"), F.col("value").alias("v"))
    stale = ~F.col("value").eqNullSafe(F.col("v")) | ~F.col("event_type").eqNullSafe(F.col("t"))
    return e.join(later, ["event_id", "user_id"]).groupBy("event_type").agg(F.count("*").alias("priors"), F.count_if(stale).alias("stale"))


@query("j13_cache_fallback", """WITH c AS (SELECT user_id, arg_max(event_type, event_id) AS answer FROM events WHERE event_type IN ('purchase', 'click') AND user_id % 3 > 0 GROUP BY user_id)
SELECT event_id, e.user_id, coalesce(answer, 'rule-' || (e.user_id % 5)) AS answer, CASE WHEN answer IS NULL THEN 'fallback' ELSE 'cache' END AS answered_by FROM events e LEFT JOIN c USING (user_id) WHERE event_type = 'view'""")
def cache_fallback(spark, d):
    e = table(spark, d, "events")
    ok = e.filter("event_type IN ('purchase', 'click') AND user_id % 3 > 0").select("user_id", "event_id", F.col("event_type").alias("answer"))
    requests = e.filter("event_type = 'view'").select("event_id", "user_id")
    return joins.cached_or_fallback(requests, joins.last_wins(ok, "user_id", "event_id"), "user_id", F.concat(F.lit("rule-"), (F.col("user_id") % 5).cast("string")))


@query("j14_reconciliation", """WITH b AS (SELECT l_orderkey, arg_max(l_returnflag, (l_shipdate, l_partkey, l_suppkey, l_linenumber, l_returnflag)) AS last FROM lineitem GROUP BY ALL)
SELECT o_orderkey, CASE WHEN last = 'R' THEN 'complete' WHEN last IS NULL THEN 'skipped' ELSE 'open_' || last END AS status FROM orders LEFT JOIN b ON o_orderkey = l_orderkey""")
def reconciliation(spark, d):
    last = F.max_by("l_returnflag", F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(last.alias("last"))
    status = F.when(F.col("last") == "R", "complete").when(F.col("last").isNull(), "skipped").otherwise(F.concat(F.lit("open_"), "last"))
    return table(spark, d, "orders").select("o_orderkey").join(b, "o_orderkey", "left").select("o_orderkey", status.alias("status"))


@query("j15_resume_check", """SELECT c_custkey AS key, 'left' AS only FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
UNION ALL SELECT DISTINCT o_custkey, 'right' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def resume_check(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return joins.missing_keys(a, table(spark, d, "orders").select(F.col("o_custkey").alias("key")).filter("key IS NOT NULL"), "key")


@query("f12_coverage", """SELECT c_nationkey AS nation, count(*) AS n, count(DISTINCT c_custkey) < count(*) AS repeated FROM customer GROUP BY c_nationkey""")
def coverage(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation"))
    return c.agg(F.count("*").alias("n"), (F.count_distinct("c_custkey") < F.count("*")).alias("repeated"))


NODES = """nodes AS (SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent, NULL::DOUBLE AS score FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, NULL FROM nation
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_acctbal FROM customer)"""


def nodes(spark, d):
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("double").alias("score"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.lit(None).cast("double").alias("score"))
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.col("c_acctbal").alias("score"))
    return r.unionByName(n).unionByName(c)


@query("r1_tree_nodes", f"""WITH RECURSIVE {NODES}, t AS (SELECT id, 1 AS depth, id AS path FROM nodes WHERE parent IS NULL UNION ALL SELECT n.id, depth + 1, path || '>' || n.id FROM t JOIN nodes n ON n.parent = t.id)
SELECT id, depth, path, depth < 3 AS expandable FROM t""")
def tree_nodes(spark, d):
    return tree.derive(nodes(spark, d), 3)


@query("r2_ancestor_path", """SELECT 'c' || c_custkey AS id, 'n' || c_nationkey AS p1, 'r' || n_regionkey AS p2 FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def ancestor_path(spark, d):
    return tree.ancestors(nodes(spark, d), 3).filter("p2 IS NOT NULL").select("id", "p1", "p2")


@query("r3_layer_quota", f"""WITH RECURSIVE {NODES}, t AS (SELECT id, 1 AS depth, id AS root FROM nodes WHERE parent IS NULL UNION ALL SELECT n.id, depth + 1, root FROM t JOIN nodes n ON n.parent = t.id)
SELECT root, count(*) FILTER (depth = 2) AS layer2, count(*) FILTER (depth = 3) AS layer3 FROM t GROUP BY root""")
def layer_quota(spark, d):
    return tree.layer_counts(tree.derive(nodes(spark, d), 3), 3)


@query("r4_attempt_rows", """SELECT n_nationkey AS plan, n_name, count(c_custkey) AS attempts FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal < 0 GROUP BY ALL""")
def attempt_rows(spark, d):
    done = table(spark, d, "customer").filter("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("plan")).agg(F.count("*").alias("attempts"))
    plan = table(spark, d, "nation").select(F.col("n_nationkey").alias("plan"), "n_name")
    return plan.join(done, "plan", "left").select("plan", "n_name", F.coalesce("attempts", F.lit(0)).alias("attempts"))


@query("u1_set_algebra", """WITH a AS (SELECT user_id, list(DISTINCT event_type) AS x FROM events WHERE event_id % 2 = 0 GROUP BY user_id), b AS (SELECT user_id, list(DISTINCT event_type) AS y FROM events WHERE event_id % 2 = 1 GROUP BY user_id)
SELECT user_id, array_to_string(list_sort(list_filter(x, lambda e: NOT list_contains(y, e))), ',') AS only_x, array_to_string(list_sort(list_intersect(x, y)), ',') AS common, len(list_distinct(list_concat(x, y)))::BIGINT AS n_union FROM a JOIN b USING (user_id)""")
def set_algebra(spark, d):
    e = table(spark, d, "events")
    g = e.groupBy("user_id").agg(F.collect_set(F.when(F.col("event_id") % 2 == 0, F.col("event_type"))).alias("x"), F.collect_set(F.when(F.col("event_id") % 2 == 1, F.col("event_type"))).alias("y"))
    g = g.filter((F.size("x") > 0) & (F.size("y") > 0))
    text = lambda c: F.array_join(F.array_sort(c), ",")
    return g.select("user_id", text(F.array_except("x", "y")).alias("only_x"), text(F.array_intersect("x", "y")).alias("common"), F.size(F.array_union("x", "y")).cast("long").alias("n_union"))


@query("u2_union_all", """SELECT 'customer' AS artifact, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS note FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""")
def union_all(spark, d):
    c = table(spark, d, "customer").select(F.lit("customer").alias("artifact"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("note"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("artifact"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("u5_advice_conflicts", """SELECT p_brand, p_type, n_actions, first_action FROM (SELECT p_brand, p_type, count(DISTINCT p_size % 3) AS n_actions, arg_min(p_size % 3, p_partkey) AS first_action FROM part GROUP BY ALL) WHERE n_actions > 1""")
def advice_conflicts(spark, d):
    action = F.col("p_size") % 3
    g = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count_distinct(action).alias("n_actions"), F.min_by(action, "p_partkey").alias("first_action"))
    return g.filter("n_actions > 1")


@query("d14_branch_status", """SELECT c_custkey, round(c_acctbal / 10000 - s_acctbal / 10000, 4) AS delta, CASE WHEN s_acctbal IS NULL THEN 'branch_error' WHEN round(c_acctbal / 10000 - s_acctbal / 10000, 4) < 0 THEN 'decreased'
  WHEN round(c_acctbal / 10000 - s_acctbal / 10000, 4) > 0 THEN 'increased' ELSE 'unchanged' END AS status, coalesce(abs(round(c_acctbal / 10000 - s_acctbal / 10000, 4)) < 0.02, true) AS review FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def branch_status(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), (F.col("s_acctbal") / 10000).alias("parent"))
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 10000).alias("child"))
    return rules.branch_status(c.join(s, "c_custkey", "left")).select("c_custkey", "delta", "status", "review")
