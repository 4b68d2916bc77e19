"""Sources, sinks and streams over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import records
from ..sources.scratch import shared_path
from ..streaming import events as streams
from .catalog import query
from .tables import table

PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("s1_json_round_trip", "SELECT event_id, user_id, event_type, value FROM events")
def json_round_trip(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    path = shared_path(spark, "json")
    rows.write.json(path)
    return records.read_json(spark, path, rows.schema)


@query("s2_optional_scan", "SELECT 0::BIGINT AS n")
def optional_scan(spark, d):
    return records.read_optional(spark, shared_path(spark, "absent"), PROPS).agg(F.count("*").alias("n"))


@query("s3_corrupt_rows", "SELECT (event_id % 7 = 0) AS corrupt, count(*) AS n, sum(CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END)::BIGINT AS total FROM events GROUP BY ALL")
def corrupt_rows(spark, d):
    raw = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("<"), "props")).otherwise(F.col("props")).alias("props"))
    good, bad = records.split_corrupt(raw, "props", PROPS)
    total = good.groupBy(F.lit(False).alias("corrupt")).agg(F.count("*").alias("n"), F.sum("k").alias("total"))
    return total.unionByName(bad.groupBy(F.lit(True).alias("corrupt")).agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("total")))


@query("s6_first_wins", "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_wins(spark, d):
    return records.first_wins(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("s9_trace_rows", "SELECT sha256(concat_ws('|', 'score', doc_id % 50, lang, sha256(text))) AS trace_id, lang, count(*) AS seen FROM documents GROUP BY ALL")
def trace_rows(spark, d):
    docs = table(spark, d, "documents").select((F.col("doc_id") % 50).alias("key"), "lang", "text")
    return records.trace_rows(docs, "score", "key", "lang", "text")


@query("s10_append_once", "SELECT user_id, min(event_id) AS event_id FROM events WHERE event_id >= 5000 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id < 400) GROUP BY user_id")
def append_once(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id")
    return records.append_once(e.filter("event_id >= 5000"), e.filter("event_id < 400"), "user_id", "event_id")


@query("s11_append_unique", """WITH n AS (SELECT doc_id, md5(text) AS digest, CASE WHEN doc_id % 2 = 0 THEN 'k' || (doc_id % 300) ELSE ' ' END AS key FROM documents), e AS (SELECT * FROM n WHERE doc_id < 100),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY doc_id) AS p FROM n WHERE doc_id >= 100) WHERE p = 1 AND digest NOT IN (SELECT digest FROM e))
SELECT min(doc_id) AS doc_id, arg_min(digest, doc_id) AS digest, key FROM f WHERE key <> ' ' AND key NOT IN (SELECT key FROM e) GROUP BY key UNION ALL SELECT doc_id, digest, key FROM f WHERE key = ' '""")
def append_unique(spark, d):
    k = F.col("doc_id")
    n = table(spark, d, "documents").select("doc_id", F.md5("text").alias("digest"), F.when(k % 2 == 0, F.concat(F.lit("k"), (k % 300).cast("string"))).otherwise(" ").alias("key"))
    return records.append_unique(n.filter("doc_id >= 100"), n.filter("doc_id < 100"), "digest", "key", "doc_id")


@query("s12_admission_log", """SELECT doc_id, reason, reason IS NULL AS admitted FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'no_evidence' WHEN length(text) > 3000 THEN 'full_content' WHEN row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 THEN 'duplicate' END AS reason FROM documents)""")
def admission_log(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", F.md5("text").alias("digest"), F.when(F.col("doc_id") % 10 != 0, F.col("source")).alias("evidence"))
    return records.admit(rows, "evidence", "text", "digest", "doc_id", 3000).select("doc_id", "reason", "admitted")


@query("s13_watermark_extract", """SELECT event_id, CASE WHEN user_id % 7 = 3 THEN 'needs_review' WHEN user_id % 5 = 0 OR event_id > 40 * user_id THEN 'new' ELSE 'seen' END AS status FROM events""")
def watermark_extract(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.lit("a").alias("prefix"))
    u = F.col("user_id")
    marks = e.select("user_id").distinct().filter((u % 5 != 0) | (u % 7 == 3)).select("user_id", (40 * u).alias("last_line"), F.when(u % 7 == 3, "b").otherwise("a").alias("prefix"))
    return records.after_watermark(e, marks, "user_id", "event_id", "prefix").select("event_id", "status")


@query("s15_last_success", "SELECT user_id, arg_max(value, event_id) AS value FROM events WHERE event_type <> 'error' GROUP BY user_id")
def last_success(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value", (F.col("event_type") != "error").alias("ok"))
    return records.last_success(e, "user_id", "event_id", "ok", "value")


@query("s16_confirmed_stage", """SELECT user_id, arg_max(event_type, p) AS confirmed, count(DISTINCT event_type) AS stages FROM (SELECT *, list_position(['view', 'click', 'purchase'], event_type) AS p FROM events) WHERE p > 0 GROUP BY user_id""")
def confirmed_stage(spark, d):
    return records.confirmed_stage(table(spark, d, "events"), "user_id", "event_type", ["view", "click", "purchase"])


@query("s17_request_budget", """SELECT * FROM (SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS spent FROM events) WHERE spent <= 100""")
def request_budget(spark, d):
    return records.within_budget(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 100).drop("value")


@query("t2_stream_counts", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(event_id) AS last FROM events GROUP BY event_type")
def stream_counts(spark, d):
    schema = table(spark, d, "events").schema
    return streams.final_state(streams.counts_by_kind(streams.event_stream(spark, d, "events.parquet", schema)), shared_path(spark, "stream"))


@query("t4_stream_windows", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(spark, d):
    schema = table(spark, d, "events").schema
    return streams.final_state(streams.windowed_counts(streams.event_stream(spark, d, "events.parquet", schema)), shared_path(spark, "stream"))
