"""Published artifacts: tables with a manifest, its validation, snapshots and event logs.

A published table is a folder of Parquet files; its manifest is one JSON row beside it, written
last.  File digests do not survive many part files, so a table's digest is the sum of its rows'
hashes, which adds up over any split.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 1
_MANIFEST = """version int, stage string, config string, config_sha256 string, input_sha256 string,
    artifact struct<bytes: bigint, digest: string, records: bigint>, sidecars array<struct<path: string, bytes: bigint, digest: string>>"""


def config_digest(config: Mapping | None) -> str:
    return hashlib.sha256(json.dumps(config or {}, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def table_digest(df: DataFrame) -> tuple[str, int]:
    """(digest, rows) of a table in any order."""
    if not df.columns:
        return "0", df.count()
    row = df.select(F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})).cast("decimal(38,0)").alias("h"))
    total, n = row.agg(F.sum("h"), F.count("*")).first()
    return str(total or 0), n


def _bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file or folder; null if there is none."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else None


def read_manifest(spark: SparkSession, path: str):
    """The manifest's row, or null if there is none or it is not one."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path}.manifest", mode="FAILFAST").limit(2).collect()
    except AnalysisException:
        return None
    except Exception:  # malformed JSON, as the reader reports it from an executor
        return None
    return rows[0] if len(rows) == 1 else None


def publish(df: DataFrame, path: str, stage: str, config: Mapping | None = None, source: DataFrame | None = None, sidecars: Sequence[str] = (), stamp: Mapping[str, object] | None = None) -> DataFrame:
    """df as a published table: returned untouched where a valid one is there, else written, its manifest last.

    stamp: constant columns to add (such as the round).
    """
    spark = df.sparkSession
    for name, value in (stamp or {}).items():
        df = df.withColumn(name, F.lit(value))
    if validate(spark, path, stage, config, source)[0]:
        return spark.read.schema(df.schema).parquet(path)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    digest, n = table_digest(out)
    side = [(s, _bytes(spark, s), table_digest(spark.read.parquet(s))[0]) for s in sidecars]
    row = (VERSION, stage, json.dumps(config or {}, sort_keys=True), config_digest(config), table_digest(source)[0] if source is not None else None, (_bytes(spark, path), digest, n), side)
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}.manifest")
    return out


def copy_published(spark: SparkSession, path: str, to: str, stage: str) -> DataFrame:
    """A published table under another path, sidecars as they are and digests taken anew; a source that is not valid raises."""
    ok, why = validate(spark, path, stage)
    if not ok:
        raise ValueError(f"{path}: {why}")
    m = read_manifest(spark, path)
    return publish(spark.read.parquet(path), to, stage, json.loads(m.config), sidecars=[s.path for s in m.sidecars or ()])


def validate(spark: SparkSession, path: str, stage: str | None = None, config: Mapping | None = None, source: DataFrame | None = None) -> tuple[bool, str]:
    """(valid, reason) of a published table; the reason is the first check that fails, in this order:

    output_missing, manifest_missing_or_invalid, manifest_version_mismatch, stage_mismatch,
    manifest_config_digest_mismatch, artifact_metadata_missing, artifact_size_mismatch,
    artifact_parse_failed, artifact_digest_mismatch, artifact_record_count_mismatch,
    input_metadata_missing, input_digest_mismatch, config_digest_mismatch, sidecar_path_missing,
    sidecar_missing, sidecar_size_mismatch, sidecar_digest_mismatch.
    """
    size = _bytes(spark, path)
    if size is None:
        return False, "output_missing"
    m = read_manifest(spark, path)
    if m is None:
        return False, "manifest_missing_or_invalid"
    if m.version != VERSION:
        return False, "manifest_version_mismatch"
    if stage and m.stage != stage:
        return False, "stage_mismatch"
    if m.config_sha256 != config_digest(json.loads(m.config or "{}")):
        return False, "manifest_config_digest_mismatch"
    if m.artifact is None:
        return False, "artifact_metadata_missing"
    if m.artifact.bytes != size:
        return False, "artifact_size_mismatch"
    try:
        digest, n = table_digest(spark.read.parquet(path))
    except Exception:  # whatever the reader or an executor makes of files that are no Parquet
        return False, "artifact_parse_failed"
    if m.artifact.digest != digest:
        return False, "artifact_digest_mismatch"
    if m.artifact.records != n:
        return False, "artifact_record_count_mismatch"
    if source is not None:
        if m.input_sha256 is None:
            return False, "input_metadata_missing"
        if m.input_sha256 != table_digest(source)[0]:
            return False, "input_digest_mismatch"
    if config is not None and m.config_sha256 != config_digest(config):
        return False, "config_digest_mismatch"
    for s in m.sidecars or ():
        if s.path is None:
            return False, "sidecar_path_missing"
        found = _bytes(spark, s.path)
        if found is None:
            return False, "sidecar_missing"
        if s.bytes != found:
            return False, "sidecar_size_mismatch"
        if s.digest != table_digest(spark.read.parquet(s.path))[0]:
            return False, "sidecar_digest_mismatch"
    return True, "ok"


def snapshot_id(cards: DataFrame, key: str, version: str, status: str, files: DataFrame | None = None) -> DataFrame:
    """One row (snapshot, cards, mode): the id is a digest of the versions of all cards that are not retired and of the local files (name, digest)."""
    live = cards.filter(F.col(status) != "retired")
    sums = lambda df, *c: df.agg(F.coalesce(F.sum(F.crc32(F.concat_ws("|", *c).cast("binary"))), F.lit(0)).alias("s"), F.count("*").alias("n"))
    a = sums(live, F.col(key).cast("string"), F.col(version).cast("string"))
    b = sums(files, F.col("name"), F.col("digest")) if files is not None else cards.sparkSession.createDataFrame([(0, 0)], "s long, n long")
    both = a.select(F.col("s").alias("s1"), F.col("n").alias("n1")).join(F.broadcast(b.select(F.col("s").alias("s2"), F.col("n").alias("n2"))), F.lit(True))  # one row each
    text = F.concat_ws("|", *[F.col(x).cast("string") for x in ("s1", "n1", "s2", "n2")])
    return both.select(F.concat(F.lit("MSNAP-"), F.substring(F.sha2(text, 256), 1, 20)).alias("snapshot"), F.col("n1").alias("cards"), F.when(F.col("n1") > 0, "global_memory").otherwise("no_global_memory").alias("mode"))


def append_events(df: DataFrame, path: str) -> DataFrame:
    """Append event rows to a log and return the whole log; an event's id is the digest of its content, and the log is read by id once."""
    event = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)
    df.withColumn("event", event).write.mode("append").json(path)
    log = df.sparkSession.read.schema(df.withColumn("event", event).schema).json(path)
    return log.groupBy("event").agg(F.first(F.struct(*df.columns)).alias("e"), F.count("*").alias("written")).select("event", "e.*", "written")
