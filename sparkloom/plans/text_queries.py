"""Text operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import rules
from .catalog import query
from .tables import table

LINES = "list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')"


@query("x2_repeated_lines", f"""WITH l AS (SELECT doc_id, {LINES} AS l FROM documents) SELECT doc_id, len(l) AS n_lines, round((len(l) - len(list_distinct(l))) / nullif(len(l), 0), 4) AS repeated FROM l""")
def repeated_lines(spark, d):
    df = table(spark, d, "documents").select("doc_id", T.lines(F.col("text")).alias("l"))
    return df.select("doc_id", F.size("l").cast("long").alias("n_lines"), T.repeated_share(F.col("l")).alias("repeated"))


@query("x2_quality_codes", r"""WITH c AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l,
  list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents),
k AS (SELECT doc_id, list_filter([CASE WHEN contains(lower(text), 'i cannot') OR contains(lower(text), 'as an ai') THEN 'refusal' END, CASE WHEN length(text) < 40 THEN 'too_short' END,
  CASE WHEN length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) > 0.1 * length(text) THEN 'garbled' END,
  CASE WHEN len(list_filter(list_distinct(string_split(text, '')), lambda c: c NOT IN (chr(10), chr(13)) AND contains(text, repeat(c, 20)))) > 0 THEN 'long_run' END,
  CASE WHEN len(l) >= 4 AND round((len(l) - len(list_distinct(l))) / len(l), 4) > 0.6 THEN 'repeated_lines' END,
  CASE WHEN len(s) >= 3 AND round((len(s) - len(list_distinct(s))) / len(s), 4) > 0.6 THEN 'repeated_sentences' END], lambda x: x IS NOT NULL) AS codes FROM c)
SELECT doc_id, array_to_string(codes, ',') AS codes FROM k""")
def quality_codes(spark, d):
    return T.quality_codes(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", F.array_join("codes", ",").alias("codes"))


@query("x6_complexity", r"""SELECT doc_id, len(regexp_extract_all(text, '[.!?]+')) AS n_sentences, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers,
  len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n_lines, len(list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}'))) AS n_terms FROM documents""")
def complexity(spark, d):
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in T.complexity(F.col("text")).items()])


@query("x1_focus_terms", r"""WITH w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]{2,}')) AS t FROM conversations),
g AS (SELECT conv_id, turn, t, list_filter(t, lambda x: length(x) BETWEEN 4 AND 8) AS s FROM w)
SELECT conv_id, turn, len(list_distinct(list_concat(t, flatten(list_transform(s, lambda x: list_transform(range(1, length(x) - 2), lambda i: substring(x, i, 4)))),
  flatten(list_transform(s, lambda x: list_transform(range(1, length(x) - 1), lambda i: substring(x, i, 3)))), flatten(list_transform(s, lambda x: list_transform(range(1, length(x)), lambda i: substring(x, i, 2))))))) AS n_terms FROM g""")
def focus_terms(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.size(T.focus_terms(F.coalesce("text", F.lit("")))).cast("long").alias("n_terms"))


@query("x5_sentence_ledger", r"""WITH s AS (SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM conversations),
e AS (SELECT conv_id, turn, unnest(s) AS sentence, unnest(range(0, len(s))) AS pos FROM s)
SELECT conv_id, turn, pos, substring(sha256(sentence), 1, 16) AS fact_key, CASE WHEN contains(sentence, '?') THEN 'question' WHEN regexp_matches(sentence, '[0-9]') THEN 'number' ELSE 'statement' END AS class FROM e""")
def sentence_ledger(spark, d):
    s = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))
    kind = F.when(F.contains("sentence", F.lit("?")), "question").when(F.col("sentence").rlike("[0-9]"), "number").otherwise("statement")
    return s.select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), F.substring(F.sha2("sentence", 256), 1, 16).alias("fact_key"), kind.alias("class"))


@query("x7_number_parse", r"""WITH n AS (SELECT doc_id, nullif(regexp_extract(text, '(-?[0-9]+(?:\.[0-9]+)?)', 1), '') AS number FROM documents), v AS (SELECT doc_id, number, TRY_CAST(number AS DOUBLE) AS x FROM n)
SELECT doc_id, CASE WHEN abs(x) < 9e18 THEN round_even(x, 0)::BIGINT END AS number FROM v""")
def number_parse(spark, d):
    return table(spark, d, "documents").select("doc_id", T.parsed_number(F.col("text")).alias("number"))


@query("x8_unique_rubric", r"""SELECT p_brand, trim(regexp_replace(p_name || '  ' || p_type, '[ \t\n\r]+', ' ', 'g')) AS title, min(p_partkey) AS first FROM part GROUP BY ALL""")
def unique_rubric(spark, d):
    p = table(spark, d, "part").select("p_brand", F.concat_ws("  ", "p_name", "p_type").alias("title"), F.col("p_partkey").alias("first"))
    return T.unique_rubric(p, "p_brand", "title", "first")


@query("x9_json_extraction", r"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_extraction(spark, d):
    noisy = F.concat(F.lit("answer: "), F.regexp_replace("props", r"\}$", ",}"), F.lit(" end"))
    return table(spark, d, "events").select("event_id", F.from_json(T.json_candidate(noisy), "k long")["k"].alias("k"))


@query("x10_hash_identities", """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '"}') AS sha, md5(text) AS md5 FROM documents""")
def hash_identities(spark, d):
    canonical = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"lang":"'), "lang", F.lit('"}'))
    return table(spark, d, "documents").select("doc_id", F.sha2(canonical, 256).alias("sha"), F.md5("text").alias("md5"))


@query("x11_composite_ids", "SELECT concat_ws('::', l_orderkey, l_linenumber, l_returnflag) AS id, count(*) AS n FROM lineitem GROUP BY ALL")
def composite_ids(spark, d):
    return table(spark, d, "lineitem").groupBy(F.concat_ws("::", "l_orderkey", "l_linenumber", "l_returnflag").alias("id")).agg(F.count("*").alias("n"))


@query("x12_profile_levels", """SELECT o_orderkey, CASE WHEN lower(trim(substring(o_orderpriority, 3))) IN ('low', 'medium', 'high') THEN lower(trim(substring(o_orderpriority, 3))) ELSE 'medium' END AS level FROM orders""")
def profile_levels(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.normalised_level(F.expr("substring(o_orderpriority, 3)")).alias("level"))


@query("x14_dates", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, date_diff('day', o_orderdate, TIMESTAMP '2000-01-01') AS age FROM orders""")
def dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.datediff(F.lit("2000-01-01"), F.to_date("o_orderdate")).cast("long").alias("age"))


@query("a17_content_audit", """SELECT source, count(*) AS n, count(*) FILTER (contains(text, '@')) AS contacts, count(*) FILTER (contains(text, 'token')) AS secrets, count(*) FILTER (contains(text, '!!')) AS shouts,
  round((count(*) FILTER (contains(text, '@')) + count(*) FILTER (contains(text, 'token')) + count(*) FILTER (contains(text, '!!'))) / count(*), 4) AS risk FROM documents GROUP BY source""")
def content_audit(spark, d):
    has = lambda x: F.count_if(F.contains("text", F.lit(x)))
    g = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), has("@").alias("contacts"), has("token").alias("secrets"), has("!!").alias("shouts"))
    return g.withColumn("risk", F.round((F.col("contacts") + F.col("secrets") + F.col("shouts")) / F.col("n"), 4))


@query("a2_semantic_report", """SELECT lang, count(*) AS n, min(n_chars) AS low, max(n_chars) AS high, round(avg(n_chars), 4) AS mean, count(*) FILTER (n_chars < 500) AS short FROM documents GROUP BY lang""")
def semantic_report(spark, d):
    c = F.col("n_chars")
    return table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.round(F.avg(c), 4).alias("mean"), F.count_if(c < 500).alias("short"))


@query("f7_keyword_filter", "SELECT doc_id, lang FROM documents WHERE contains(text, 'keit') OR contains(text, 'ción') OR contains(text, 'ing ')")
def keyword_filter(spark, d):
    return table(spark, d, "documents").filter(rules.contains_any(F.col("text"), ["keit", "ción", "ing "])).select("doc_id", "lang")


@query("d15_reference_check", r"""WITH t AS (SELECT doc_id, text || ' [' || (doc_id % 4) || ']' AS a, CASE WHEN doc_id % 3 = 0 THEN ['1', '2'] ELSE ['0', '1', '2', '3'] END AS ok FROM documents),
c AS (SELECT *, list_distinct(regexp_extract_all(a, '\[(\d+)\]', 1)) AS ids FROM t)
SELECT doc_id, array_to_string(list_filter([CASE WHEN trim(a) = '' THEN 'empty' END, CASE WHEN contains(a, 'token') THEN 'forbidden_word' END, CASE WHEN len(ids) = 0 THEN 'no_citation' END,
  CASE WHEN len(list_filter(ids, lambda x: NOT list_contains(ok, x))) > 0 THEN 'citation_outside' END], lambda x: x IS NOT NULL), ',') AS issues FROM c""")
def reference_check(spark, d):
    answer = F.concat("text", F.lit(" ["), (F.col("doc_id") % 4).cast("string"), F.lit("]"))
    allowed = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(*[F.lit(str(i)) for i in range(4)]))
    return table(spark, d, "documents").select("doc_id", F.array_join(rules.reference_issues(answer, allowed, ["token"]), ",").alias("issues"))
