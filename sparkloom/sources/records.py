"""Record sources and idempotent sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, array: bool = False, strict: bool = True) -> DataFrame:
    """Rows of JSON lines (or of whole-file arrays); a bad row raises, or goes to _corrupt_record if not strict."""
    return spark.read.schema(schema).json(path, multiLine=array, mode="FAILFAST" if strict else "PERMISSIVE")


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A missing path is an empty relation; any other failure is one."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_corrupt(rows: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, issues): JSON text in a column that parses under the schema, and what does not."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = rows.withColumn("__j", F.from_json(column, marked, {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("__j").isNull() | F.col("__j._corrupt").isNotNull()
    rest = [c for c in rows.columns if c != column]
    good = parsed.filter(~bad).select(*rest, *[F.col(f"__j.{f.name}").alias(f.name) for f in schema.fields])
    return good, parsed.filter(bad).select(*rows.columns)


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the first in the order, by an aggregation with map-side partials."""
    rest = [c for c in rows.columns if c != key]
    g = rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("__first"))
    return g.select(key, *[F.col(f"__first.{c}").alias(c) for c in rest])


def append_once(new: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """The new rows whose key is not there yet, the first of each key."""
    return first_wins(new, key, order).join(existing.select(key), key, "left_anti")


def append_unique(new: DataFrame, existing: DataFrame, digest: str, key: str, order: str) -> DataFrame:
    """Rows that repeat neither the content nor the (non-blank) key of an existing row, nor of a new row before them."""
    w = Window.partitionBy(digest).orderBy(order)
    fresh = new.withColumn("__d", F.row_number().over(w)).filter("__d = 1").drop("__d")
    fresh = fresh.join(existing.select(digest), digest, "left_anti")
    blank = F.col(key).isNull() | (F.trim(F.col(key)) == "")
    keyed = first_wins(fresh.filter(~blank), key, order).join(existing.filter(~blank).select(key), key, "left_anti")
    return keyed.select(*new.columns).unionByName(fresh.filter(blank).select(*new.columns))


def admit(rows: DataFrame, evidence: str, text: str, digest: str, order: str, longest: int) -> DataFrame:
    """A decision and its reason per row: no evidence, whole texts, content seen before, else admitted."""
    place = F.row_number().over(Window.partitionBy(digest).orderBy(order))
    why = F.when(F.col(evidence).isNull(), "no_evidence").when(F.length(text) > longest, "full_content").when(place > 1, "duplicate")
    return rows.withColumn("reason", why).withColumn("admitted", F.col("reason").isNull())


def after_watermark(lines: DataFrame, marks: DataFrame, file: str, line: str, prefix: str) -> DataFrame:
    """Lines after each file's watermark; a file that shrank or whose prefix changed is marked for review instead."""
    m = marks.select(file, F.col("last_line").alias("__last"), F.col("prefix").alias("__prefix"))
    j = lines.join(m, file, "left")
    changed = F.col("__prefix").isNotNull() & (F.col("__prefix") != F.col(prefix))
    new = F.col("__last").isNull() | (F.col(line) > F.col("__last"))
    return j.withColumn("status", F.when(changed, "needs_review").when(new, "new").otherwise("seen")).drop("__last", "__prefix")


def last_success(log: DataFrame, key: str, order: str, ok: str, value: str) -> DataFrame:
    """The last successful value of every key in an append-only log."""
    return log.filter(ok).groupBy(key).agg(F.max_by(value, order).alias(value))


def confirmed_stage(checkpoints: DataFrame, branch: str, stage: str, order: Sequence[str]) -> DataFrame:
    """The latest stage, in a fixed order, that a branch has a checkpoint of."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(stage))
    return checkpoints.filter(place > 0).groupBy(branch).agg(F.max_by(stage, place).alias("confirmed"), F.count_distinct(stage).alias("stages"))


def within_budget(requests: DataFrame, scope: str, order: str, cost: str, limit: float) -> DataFrame:
    """Requests in order while their costs so far stay within the limit of their scope."""
    upto = F.sum(cost).over(Window.partitionBy(scope).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return requests.withColumn("spent", F.round(upto, 2)).filter(F.col("spent") <= limit)


def content_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """(n, digest): a manifest of rows in any order; the digest adds up row hashes, so parts combine."""
    return rows.agg(F.count("*").alias("n"), F.sum(F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).cast("binary"))).alias("digest"))


def published(df: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Write once: a table whose manifest matches is returned untouched, else it is written and its manifest with it."""
    spark = df.sparkSession
    want = content_digest(df, *columns).first()
    manifest = read_optional(spark, f"{path}/manifest", T.StructType([T.StructField("n", T.LongType()), T.StructField("digest", T.LongType())]))
    if tuple(want) not in [tuple(r) for r in manifest.limit(2).collect()]:
        df.write.mode("overwrite").parquet(f"{path}/data")
        spark.createDataFrame([want], "n long, digest long").write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def trace_rows(rows: DataFrame, stage: str, key: str, kind: str, text: str) -> DataFrame:
    """Content-addressed traces, the first of equal ones."""
    trace = F.sha2(F.concat_ws("|", F.lit(stage), F.col(key).cast("string"), F.col(kind), F.sha2(text, 256)), 256)
    return rows.select(trace.alias("trace_id"), kind).groupBy("trace_id").agg(F.min(kind).alias(kind), F.count("*").alias("seen"))
