"""Operator 7: sharding by a Feistel permutation over global row numbers.

Every row gets a global row number from a reproducible total order, a keyed Feistel
network permutes the numbers 0..N-1 (cycle walking keeps it inside that range), and
the permuted number p gives shard p mod S and slot p div S.  Both directions are
computable without a table: `locate` finds shard and slot of a row number, `row_at`
the row number of a shard and slot.  The law is `rows`: counts are at most one apart.

Numbering without a global sort: rows are grouped by (doc_id, crc, size) with their
multiplicity, the groups hashed into buckets, buckets numbered by a prefix sum over
their counts (one row per bucket), and groups numbered inside their bucket.  Rows
that agree in all three are interchangeable, so copies of a whole row, however many,
travel as one.

Edge cases: a null text has 8 bytes of size and crc32 0; a null doc_id is a value
like others; rows with equal doc_id are told apart by crc and size; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ROUNDS = 6
#: Groups to a numbering bucket, so that no task sorts more than about this many.
BUCKET_ROWS = 50_000
#: Row numbers that one row of a group of copies becomes at once.
COPY_RUN = 10_000


class Feistel:
    """A keyed permutation of range(n)."""

    def __init__(self, n: int, seed: int = 0, rounds: int = ROUNDS):
        self.n = n
        half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.half = np.uint64(half)
        self.mask = np.uint64((1 << half) - 1)
        self.keys = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, size=rounds, dtype=np.uint64)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, forward: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys if forward else self.keys[::-1]:
            if forward:
                left, right = right, left ^ self._round(right, key)
            else:
                left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, x, forward: bool) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=np.uint64), forward)
        while len(outside := np.flatnonzero(out >= np.uint64(self.n))):
            out[outside] = self._once(out[outside], forward)
        return out.astype(np.int64)

    def permute(self, x) -> np.ndarray:
        return self._walk(x, True)

    def invert(self, x) -> np.ndarray:
        return self._walk(x, False)


def locate(row: int, n_rows: int, n_shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of a global row number."""
    p = int(Feistel(n_rows, seed).permute([row])[0])
    return p % n_shards, p // n_shards


def row_at(shard: int, slot: int, n_rows: int, n_shards: int, seed: int = 0) -> int:
    """The global row number that lies in a shard's slot."""
    return int(Feistel(n_rows, seed).invert([slot * n_shards + shard])[0])


def number_rows(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, row_number) for every row, and the number of rows."""
    groups = (
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )
    groups = written(groups, "shard-groups")
    rows, distinct = groups.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")).first()
    n_buckets = max(1, -(-distinct // bucket_rows))
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(n_buckets)))
    counts = groups.groupBy("bucket").agg(F.sum("copies").alias("rows"))  # one row per bucket
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    # A bucket holds a bounded number of groups; its partition is split no further.
    w = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size")
    inside = F.coalesce(F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = groups.withColumn("inside", inside).join(counts, "bucket")
    numbered = numbered.withColumn("first", F.col("base") + F.col("inside"))
    names = ["doc_id", "size", "text_crc32"]
    # Copies of a whole row become rows again run by run; long groups are dealt out before that.
    few = numbered.filter(F.col("copies") <= COPY_RUN).select(*names, F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("row_number"))
    many = numbered.filter(F.col("copies") > COPY_RUN)
    runs = many.select(*names, F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1, F.lit(COPY_RUN).cast("long"))).alias("begin"), (F.col("first") + F.col("copies")).alias("end"))
    upto = F.least(F.col("begin") + COPY_RUN, F.col("end")) - 1
    again = runs.repartition("begin").select(*names, F.explode(F.sequence("begin", upto)).alias("row_number"))
    return few.unionByName(again), rows


def feistel_shards(docs: DataFrame, n_shards: int = 24, seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, row_number, position (permuted), law, shard, slot, grown_shard."""
    numbered, n = number_rows(docs, bucket_rows)

    @F.pandas_udf("long")
    def permuted(rows: pd.Series) -> pd.Series:
        return pd.Series(Feistel(n, seed).permute(rows.to_numpy()))

    return numbered.withColumn("position", permuted("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("position") % n_shards).cast("int").alias("shard"),
        F.expr(f"position div {n_shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
