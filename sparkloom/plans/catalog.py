"""All registered queries over the driver's tables, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "a1_effect_matrix"


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


from . import evidence_queries, join_queries, review_queries, rule_queries, source_queries, stat_queries, text_queries, window_queries  # noqa: E402, F401
