"""Event logs as file streams: the same rollups as in batch, kept up to date."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, pattern: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)


def counts_by_kind(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max("event_id").alias("last"))


def windowed_counts(events: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts per day and kind; state older than the watermark is dropped."""
    w = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("day"), "event_type", "n")


def first_of_each(events: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Replays are no-ops: one event per key within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def final_state(stream: DataFrame, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Run a stream to the end of its input and return its result table."""
    name = f"stream_{uuid.uuid4().hex}"
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def merged(stream: DataFrame, path: str, key: str, checkpoint: str) -> None:
    """Append each batch's rows whose key is not in the table yet, so replays and restarts change nothing."""
    schema = stream.schema

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        fresh = batch.dropDuplicates([key])
        if exists:
            fresh = fresh.join(spark.read.schema(schema).parquet(path).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(path)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
