"""How the operators' records are bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, trial, score: an order's lines as a sample's repeated trials."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    return rows.select(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("trial"), (F.col("q") / 50).alias("score"))


TRIALS_SQL = "trials AS (SELECT l_orderkey AS sample, l_linenumber AS trial, max(l_quantity) / 50 AS score FROM lineitem GROUP BY ALL)"


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, trial, awarded, possible: the rows of one order line as repeated judgements."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("trial"), F.col("l_quantity").alias("awarded"), F.lit(50.0).alias("possible"))


JUDGEMENTS_SQL = "judgements AS (SELECT l_orderkey AS sample, l_linenumber AS trial, l_quantity AS awarded, 50.0 AS possible FROM lineitem)"


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, strategy, before, after: mean event values of a user in the first and second half of the month."""
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    rate = lambda c: F.round(F.least(F.lit(1.0), F.avg(F.when(c, F.col("value"))) / 20), 4)
    g = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key"), F.col("event_type").alias("strategy"))
    return g.agg(rate(~late).alias("before"), rate(late).alias("after"))


ROUNDS_SQL = """rounds AS (SELECT user_id AS key, event_type AS strategy,
  round(least(1.0, avg(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END) / 20), 4) AS before,
  round(least(1.0, avg(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END) / 20), 4) AS after FROM events GROUP BY ALL)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grp, id, quality, toxic, gain: labelled documents as rewrite candidates of a source and language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.select(F.concat_ws("/", "source", "lang").alias("grp"), F.col("doc_id").alias("id"), "quality", "toxic", (F.col("n_chars") % 97).alias("gain"))


CANDIDATES_SQL = """candidates AS (SELECT concat_ws('/', source, lang) AS grp, doc_id AS id, quality, toxic, n_chars % 97 AS gain
  FROM documents JOIN labels USING (doc_id))"""
