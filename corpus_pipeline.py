"""A training corpus from raw documents: five stages over the operators of sparkloom.llm.

Every stage takes all rows its predecessor kept, as a table with the columns of documents,
and its decisions hold for all that follow; the last returns what the token store holds.

Odd cases: documents without text or with fewer than 50 words do not pass the first stage, so
nulls and empty texts end there; a null lang, source or doc_id is a value like others; of rows
that repeat a doc_id and text one stays, rows that share a doc_id only are documents of their
own; texts of any length are taken whole; of equally good keepers the smaller doc_id stays;
columns beyond those of documents are carried to the store stage and end there, whatever their
names; an empty table, before or after any stage, gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontaminate, mixing, ngram_join, quality, queries, store
from sparkloom.llm.common import documents, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the adaptive fences reject go."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return ngram_join.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def token_store(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids go to a content-addressed store; a row per stored document, read back and verified."""
    return store.store_and_digest(docs, queries.tokenizer_path(), queries.END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_store", token_store),
]

#: Hash-drawn mixes and tokenizers have no SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
