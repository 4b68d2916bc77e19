"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, mixing, ngram_join, pii, quality, secrets, sharding, store, tokens
from .common import documents, written

N_SHARDS = 24
END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "shards")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(documents(spark, sf_dir))


def op3_content_addressed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.store_and_digest(documents(spark, sf_dir), tokenizer_path(), END_ID)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(documents(spark, sf_dir))


def op7_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.feistel_shards(documents(spark, sf_dir).select("doc_id", "text"), N_SHARDS)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = written(tokens.length_histogram(documents(spark, sf_dir), tokenizer_path()), "lengths")
    return tokens.length_report(histogram)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality_report(documents(spark, sf_dir)).select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_pii": op2_pii,
    "op3_content_addressed_store": op3_content_addressed_store,
    "op4_language_id": op4_language_id,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_feistel_sharding": op7_feistel_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op10_benchmark_decontamination": decontaminate.DECONTAMINATE_SQL,
    "op9_quality_rules": quality.QUALITY_SQL,
}
