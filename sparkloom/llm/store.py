"""Operator 3: token ids in a content-addressed store.

A document's id stream (end id included) is cut where a rolling hash over the last ids
meets a mask, so equal passages give equal chunks wherever they stand.  A chunk's
address is the BLAKE2b digest of its bytes, and its bytes are stored once.

The store is a folder of four Parquet tables:

  chunks    digest, n, ids (little-endian, 2 bytes an id if the vocabulary allows, else 4),
            one row per digest
  recipes   in ascending doc_id order, file after file: part, doc_id, uid, n_tokens, root
            (Merkle root over the chunk digests), chunks (digest, n, before)
  manifest  part, n_docs, n_ids, root (Merkle root over the documents' roots, in order)
  head      id_bytes, n_docs, n_ids, root (over the parts' roots)

Reading verifies all of it: every chunk's bytes against its address, every document's
root against its recipe, every part's root and the head's.  A document's CRC32 comes from
its chunks' CRCs, each computed from the stored bytes and shifted past the bytes that
follow it; CRCs so shifted combine by exclusive or, so no payload moves when reading.

Skew: each task merges the chunks it makes and writes them with their uses (uid, doc_id,
seq, before) to the shared folder.  Bytes then travel by digest without the uses, at most one
row per task and digest, and uses by document without the bytes, so a chunk that all documents
share puts no more in one task than it has tasks.

Edge cases: a null or empty text is a document of one id, the end id; rows that repeat a
doc_id are documents of their own (uid tells them apart; they stand side by side, ordered
by root, then uid); null doc_ids come first; an empty table makes an empty store; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, scratch_path, written
from .tokens import encoder_for, text_slices

MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 128, 512, 4096
#: Ids that the rolling hash sees; at most MIN_CHUNK, so that no cut depends on a chunk before.
WINDOW = 8
#: Bytes of chunks a task merges before it hands them on.
HOLD_BYTES = 48 << 20
_MADE_ROW = "digest binary, n int, ids binary, refs array<struct<uid:long,doc_id:long,seq:int,before:long>>"
_CHUNK_ROW = "digest binary, n int, ids binary"
_RECIPE_ROW = "part int, doc_id long, uid long, n_tokens long, root binary, chunks array<struct<digest:binary,n:int,before:long>>"


def address(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary Merkle tree; an odd node moves up unchanged, no leaf gives the empty digest."""
    level = [hashlib.blake2b(b"\0" + x, digest_size=16).digest() for x in leaves]
    if not level:
        return hashlib.blake2b(b"", digest_size=16).digest()
    while len(level) > 1:
        paired = [hashlib.blake2b(b"\1" + a + b, digest_size=16).digest() for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2 :]
    return level[0]


def _rolling_table(vocabulary: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(1729)).integers(0, 2**64, size=vocabulary, dtype=np.uint64)


def cut_points(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> list[list[int]]:
    """Per stream [start, end) of ids: the ends of its chunks."""
    known = table[ids]
    rolled = known.copy()
    for back in range(1, WINDOW):
        rolled[back:] += known[:-back] << np.uint64(3 * back)
    rolled *= np.uint64(0x9E3779B97F4A7C15)
    candidates = np.flatnonzero((rolled >> np.uint64(40)) % np.uint64(MEAN_CHUNK - MIN_CHUNK) == 0) + 1
    low, high = np.searchsorted(candidates, starts), np.searchsorted(candidates, ends)
    out = []
    for s, e, a, b in zip(starts.tolist(), ends.tolist(), low.tolist(), high.tolist()):
        cuts, last = [], s
        for c in candidates[a:b].tolist():
            while c - last > MAX_CHUNK:
                last += MAX_CHUNK
                cuts.append(last)
            if c - last >= MIN_CHUNK:
                cuts.append(c)
                last = c
        while e - last > MAX_CHUNK:
            last += MAX_CHUNK
            cuts.append(last)
        if last < e:
            cuts.append(e)
        out.append(cuts)
    return out


def _chunk_rows(tokenizer: str, end_id: int):
    """A function over batches of (uid, doc_id, text) that makes chunk rows, merged within the task."""

    def emit(held: dict) -> pa.RecordBatch:
        refs = pa.array([[{"uid": u, "doc_id": d, "seq": q, "before": b} for u, d, q, b in x[2]] for x in held.values()], pa.list_(pa.struct([("uid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("before", pa.int64())])))
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([x[0] for x in held.values()], pa.int32()), pa.array([x[1] for x in held.values()], pa.binary()), refs], ["digest", "n", "ids", "refs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, end_id)
        table = _rolling_table(encoder.vocabulary)
        kind = np.dtype("<u2") if encoder.vocabulary <= 1 << 16 else np.dtype("<u4")
        held: dict[bytes, tuple[int, bytes, list]] = {}
        size = 0
        for batch in batches:
            uids, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, texts in text_slices(batch.column(2)):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                raw, width = ids.astype(kind).tobytes(), kind.itemsize
                for i, (begin, cuts) in enumerate(zip((ends - counts).tolist(), cut_points(ids, ends - counts, ends, table))):
                    a = begin
                    for seq, b in enumerate(cuts):
                        payload = raw[a * width : b * width]
                        key = address(payload)
                        if key not in held:
                            held[key] = (b - a, payload, [])
                            size += len(payload) + 100
                        held[key][2].append((uids[at + i], doc_ids[at + i], seq, a - begin))
                        size += 32
                        a = b
                    if size > HOLD_BYTES:
                        yield emit(held)
                        held, size = {}, 0
        if held:
            yield emit(held)

    return run


@F.pandas_udf(T.BinaryType())
def _root(digests: pd.Series) -> pd.Series:
    return pd.Series([merkle(list(x)) for x in digests])


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> str:
    """Encode every whole text of docs (doc_id, text) and write the store; returns path."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), "text")
    made = rows.mapInArrow(_chunk_rows(tokenizer, end_id), _MADE_ROW)
    made = written(made, "store-made")
    spark = docs.sparkSession
    # One row per task and digest; the first of them keeps the bytes.
    first = F.row_number().over(Window.partitionBy("digest").orderBy("uid")) == 1
    payload = made.select("digest", "n", "ids", F.col("refs")[0]["uid"].alias("uid"))
    payload.withColumn("__first", first).filter("__first").select("digest", "n", "ids").write.option("compression", "zstd").parquet(f"{path}/chunks")
    refs = made.select("digest", "n", F.explode("refs").alias("r"))
    recipes = (
        refs.groupBy("r.doc_id", "r.uid")  # a document's chunks: bounded by its own text
        .agg(F.sort_array(F.collect_list(F.struct("r.seq", "digest", "n", "r.before"))).alias("c"))
        .select(
            "doc_id",
            "uid",
            F.aggregate("c", F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("n_tokens"),
            _root(F.transform("c", lambda x: x["digest"])).alias("root"),
            F.transform("c", lambda x: F.struct(x["digest"].alias("digest"), x["n"].alias("n"), x["before"].alias("before"))).alias("chunks"),
        )
    )
    ordered = recipes.repartitionByRange("doc_id", "root", "uid").sortWithinPartitions("doc_id", "root", "uid")
    ordered.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(f"{path}/recipes")
    recipes = spark.read.schema(_RECIPE_ROW).parquet(f"{path}/recipes")
    _part_roots(recipes).write.parquet(f"{path}/manifest")
    parts = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()  # one row per recipe file
    width = 2 if encoder_for(tokenizer, end_id).vocabulary <= 1 << 16 else 4
    head = (width, sum(p.n_docs for p in parts), sum(p.n_ids for p in parts), merkle([bytes(p.root) for p in parts]))
    spark.createDataFrame([head], "id_bytes int, n_docs long, n_ids long, root binary").coalesce(1).write.parquet(f"{path}/head")
    discard(made)
    return path


def _part_roots(recipes: DataFrame) -> DataFrame:
    """One row per part (a part is one task's share of the recipes, so its roots fit in a task)."""
    return recipes.groupBy("part").agg(
        F.count("*").alias("n_docs"),
        F.sum("n_tokens").alias("n_ids"),
        F.sort_array(F.collect_list(F.struct("doc_id", "root", "uid"))).alias("docs"),
    ).select("part", "n_docs", "n_ids", _root(F.transform("docs", lambda x: x["root"])).alias("root"))


class StoreError(ValueError):
    """What is stored does not match its manifest."""


def verify_manifest(spark: SparkSession, path: str) -> None:
    """Raise unless recipes, manifest and head agree."""
    recipes = spark.read.schema(_RECIPE_ROW).parquet(f"{path}/recipes")
    broken = recipes.filter(_root(F.transform("chunks", lambda x: x["digest"])) != F.col("root")).limit(1).count()
    found = {p.part: (p.n_docs, p.n_ids, bytes(p.root)) for p in _part_roots(recipes).collect()}
    said = {p.part: (p.n_docs, p.n_ids, bytes(p.root)) for p in spark.read.parquet(f"{path}/manifest").collect()}
    head = spark.read.parquet(f"{path}/head").first()
    if broken or found != said or bytes(head.root) != merkle([said[k][2] for k in sorted(said)]):
        raise StoreError(f"{path}: recipes, manifest and head do not agree")


# CRC-32 arithmetic: polynomials over GF(2) modulo the (reflected) CRC polynomial.
_POLY = np.uint32(0xEDB88320)


def _multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    product = np.zeros_like(b)
    for bit in range(31, -1, -1):
        product ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0)).astype(np.uint32)
        b = np.where(b & np.uint32(1), (b >> np.uint32(1)) ^ _POLY, b >> np.uint32(1)).astype(np.uint32)
    return product


def shift_crc(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """The part that a block with this CRC has in the CRC of a stream in which n_bytes follow it."""
    crc, left = crc.astype(np.uint32), n_bytes.astype(np.uint64).copy()
    power = np.full(1, 1 << 23, dtype=np.uint32)  # x^8: one byte
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        crc[odd] = _multiply(np.broadcast_to(power, crc[odd].shape), crc[odd])
        power = _multiply(power, power)
        left >>= np.uint64(1)
    return crc


@F.pandas_udf(T.LongType())
def _shifted(crc: pd.Series, n_bytes: pd.Series) -> pd.Series:
    return pd.Series(shift_crc(crc.to_numpy(), n_bytes.to_numpy()).astype(np.int64))


def _checked_chunks(path: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for digest, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if address(payload) != digest:
                    raise StoreError(f"{path}: the bytes of chunk {digest.hex()} do not match its address")
                crcs.append(zlib.crc32(np.frombuffer(payload, dtype=f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary()), pa.array(crcs, pa.int64())], ["digest", "crc"])

    return run


def read_digests(spark: SparkSession, path: str, end_bytes: int = 4) -> DataFrame:
    """Verify the store and return doc_id, start, n_tokens, ids_crc32 for every document in it."""
    verify_manifest(spark, path)
    width = spark.read.parquet(f"{path}/head").first().id_bytes
    chunks = spark.read.schema(_CHUNK_ROW).parquet(f"{path}/chunks").select("digest", "ids")
    crcs = chunks.mapInArrow(_checked_chunks(path, width), "digest binary, crc long")
    recipes = spark.read.schema(_RECIPE_ROW).parquet(f"{path}/recipes")
    uses = recipes.select("part", "doc_id", "uid", "root", "n_tokens", F.explode("chunks").alias("c"))
    uses = uses.select("part", "doc_id", "uid", "root", "n_tokens", "c.digest", (end_bytes * (F.col("n_tokens") - F.col("c.before") - F.col("c.n"))).alias("after"))
    # A left join: a chunk that is missing makes its documents' CRC null instead of dropping them.
    part_of = uses.join(crcs, "digest", "left").withColumn("crc", _shifted(F.coalesce("crc", F.lit(0)), "after") + F.when(F.col("crc").isNull(), None).otherwise(0))
    per_doc = part_of.groupBy("part", "doc_id", "uid", "root", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"), F.bool_or(F.col("crc").isNull()).alias("lost"))
    sizes = spark.read.parquet(f"{path}/manifest").select("part", "n_ids")  # one row per recipe file
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("doc_id", "root", "uid").rowsBetween(Window.unboundedPreceding, -1)
    numbered = per_doc.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(sizes, "part")
    crc = F.when(F.col("lost"), F.raise_error(F.lit(f"{path}: a recipe names a chunk that is not stored")).cast("long")).otherwise(F.col("ids_crc32"))
    return numbered.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", crc.alias("ids_crc32"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and the ids of every document, put together again from its recipe."""
    width = spark.read.parquet(f"{path}/head").first().id_bytes
    chunks = spark.read.schema(_CHUNK_ROW).parquet(f"{path}/chunks").select("digest", "ids")
    recipes = spark.read.schema(_RECIPE_ROW).parquet(f"{path}/recipes")
    uses = recipes.select("part", "doc_id", "uid", F.posexplode("chunks").alias("seq", "c")).select("part", "doc_id", "uid", "seq", "c.digest")
    joined = uses.join(chunks, "digest").groupBy("part", "doc_id", "uid").agg(F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("c"))

    @F.pandas_udf("array<int>")
    def ids(parts: pd.Series) -> pd.Series:
        return pd.Series([np.concatenate([np.frombuffer(p["ids"], dtype=f"<u{width}") for p in x]).astype(np.int32) for x in parts])

    return joined.select("part", "doc_id", "uid", ids("c").alias("ids"))


def store_and_digest(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write a store under the shared scratch folder and read it back."""
    spark = docs.sparkSession
    return read_digests(spark, write_store(docs, scratch_path(spark, "token-store"), tokenizer, end_id))
