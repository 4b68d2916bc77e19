"""What the training-data operators share: input, scratch tables, word patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of characters other than these (space and 0x09-0x0D).
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_CLASS = r"[\x20\x09-\x0D]"

#: Sides up to this many bytes may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it in spark.checkpoint.dir.

    Only a local session (driver and executors in one JVM) may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and return a scan of it.

    The file commit protocol makes the table whole or absent, and a lost executor
    costs later readers nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() made, once nothing that is still to run reads them."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """A broadcast hint only if the counted rows stay under BROADCAST_BYTES."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
