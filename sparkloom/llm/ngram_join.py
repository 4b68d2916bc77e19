"""Operator 5: n-gram Jaccard self-join with filters under several global token orders.

A document is the set of its distinct 5-word shingles (64-bit hashes).  Documents with
equal sets form a class; the join runs over classes.

Under any total order of tokens, two sets of Jaccard similarity t share a token among
their first n - ceil(t n) + 1.  Three global orders are used: by the logarithm of a token's
frequency, by a coarse step of it (a factor of 16) with another hash inside the step, and by
a third hash alone.  Frequencies are estimated for all tokens by a counting sketch over all
documents (fixed size; an estimate that is off costs time, never a link).  Under the first
order common passages come last, which makes few candidates; the other orders pick other
tokens, and a candidate must share prefix tokens under all three.

  1. Tokens of the first order's prefixes are grouped; those of one class drop out.  Tokens
     that are frequent by the sketch are dealt out with a salt, so no task holds a hot token.
  2. Each token's smallest class is compared with the others (a star, never all pairs),
     and the links found give a first set of components.
  3. Tokens all of whose classes are already connected drop out, and of tokens with the same
     classes (those of one shared passage) all but one.  In the others, classes
     of different components are paired if their sizes allow it and their 512-bit parity
     sketches do not rule it out (the distance of two sketches is at most the number of
     tokens that the sets do not share).  The classes of a token with more than `BLOCK` are
     split in blocks; its largest component's classes are never paired with each other, so
     a group of near copies costs rows in proportion to its size.  This is done twice: first
     each class goes with its nearest partner of every group only, by the distance of the
     sketches, which is a pair a row at most; then, with the components that these links
     make, all pairs that are left.
  4. Of candidates whose narrow parity sketches (a bit per token) are close, the prefixes under
     the second and third order are intersected, then wider parity sketches compared; only
     then do whole sets move, and what passed is verified.
  5. Components over all links found.

A pair never compared is one whose ends are connected anyway, or that some filter proves
to be below the threshold, so components are exact; links inside a component are not all
listed.

Edge cases: a null or empty text, or one without words, has an empty set and is linked
with nothing; fewer than 5 words are one shingle; copies fall in one class however many;
rows that repeat a doc_id are documents of their own; a component's id is its smallest
non-null doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, maybe_broadcast, written
from .components import connected_components
from .shingles import U64, mix, shingle_sets

K, PERCENT = 5, 80
#: The sketch travels in slices of 4 KB, so that a batch of 10,000 of them stays small.
SKETCH_BITS, SKETCH_SLICES = 21, 2048
PARITY_BITS = 512
MAX_WIDE_BITS = 15
#: Classes of one token that are paired in one block.
BLOCK = 512
#: The global orders: a hash, and how much of the frequency rank goes before it (in bits cut off; 8 is all of it).
ORDERS = ((U64(0x51ED270B7F4A7C15), 0), (U64(0xC2B2AE3D27D4EB4F), 4), (U64(0x165667B19E3779F9), 8))
#: Expected occurrences of a token from which its rows are dealt out with a salt.
HOT_TOKEN = 1 << 17


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def linked(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def class_id(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity_sketch(values: np.ndarray, bits: int) -> bytes:
    """A bit per hash cell: the parity of the number of the set's tokens in it."""
    cells = np.bincount((mix(values + U64(77)) & U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def wide_bits(n: int) -> int:
    """Bits of the wide sketch of a set: enough that its cells stay sparse, if the set is not huge."""
    return 1 << min(max((4 * n - 1).bit_length(), 9), MAX_WIDE_BITS)


def narrow_bits(n: int) -> int:
    """Bits of the narrow sketch: as many as the set has tokens, which rules out sets with little in common."""
    return 1 << min(max((n - 1).bit_length(), 9), MAX_WIDE_BITS)


def sketch_distance(x: bytes, y: bytes) -> int:
    """A lower bound on the number of tokens that are in one set only; the wider sketch is folded."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    if len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def token_prefix(values: np.ndarray, ranks: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The set's first tokens under one of the global orders."""
    p, (seed, cut) = prefix_length(len(values), percent), ORDERS[order]
    rank = ranks[(values >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) >> U64(cut)
    key = (rank << U64(56)) | (mix(values ^ seed) >> U64(8))
    return values[np.argpartition(key, p - 1)[:p]] if p < len(values) else values


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    """A row (rid, doc_id, n, class) per document and, per task, rows (slice, counts) of the token sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        names = ["rid", "doc_id", "n", "class", "slice", "counts"]
        for batch in batches:
            sizes, classes = [], []
            for _, values, offsets in shingle_sets(batch.column(2), k):
                counts += np.bincount((values >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    sizes.append(b - a)
                    classes.append(class_id(values[a:b]) if b > a else None)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        parts = [x.tobytes() for x in np.split(counts, SKETCH_SLICES)]
        none = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names)

    return _keyed(docs).mapInArrow(run, "rid long, doc_id long, n long, class long, slice int, counts binary")


def _token_ranks(signatures: DataFrame) -> tuple[np.ndarray, float]:
    """For each sketch cell, the logarithm of its tokens' count against the mean, in quarters (one byte a cell); the mean."""
    size = (1 << SKETCH_BITS) // SKETCH_SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, dtype=np.uint32 if len(raw) == 4 * size else np.uint64).astype(np.uint64)
                sums[s] = sums[s] + part if s in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "counts"])

    def logarithms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(batches):
            counts = [np.frombuffer(x, dtype=np.uint64) for x in batch.column(1).to_pylist()]
            logs = [np.rint(256 * np.log2(np.maximum(x, 1))).astype(np.uint16).tobytes() for x in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int(x.sum()) for x in counts], pa.int64()), pa.array(logs, pa.binary())], ["slice", "total", "logs"])

    partial = signatures.filter("slice is not null").select("slice", "counts").mapInArrow(add, "slice int, counts binary")
    # The driver gets a count's logarithm in two bytes, and turns it into a rank slice by slice.
    found = partial.repartition("slice").mapInArrow(logarithms, "slice int, total long, logs binary").collect()
    mean = max(1.0, sum(r.total for r in found) / (1 << SKETCH_BITS))
    ranks = np.zeros((SKETCH_SLICES, size), np.uint8)
    for r in found:
        ranks[r.slice] = np.clip(np.rint(np.frombuffer(r.logs, dtype=np.uint16) / 64 - 4 * np.log2(mean)), 0, 255)
    return ranks.reshape(-1), mean


def _prefixes(docs: DataFrame, ranks, mean: float, k: int, percent: int, hot: int) -> DataFrame:
    """(token, salt, class, n) for the first order's prefixes; a task names each class once.

    A token that may occur more than `hot` times has its classes dealt over salts from 1 on; other tokens have salt 0.
    """
    salts = np.clip(np.ceil(mean * 2.0 ** (np.arange(256) / 4) / hot), 1, 1 << 20).astype(np.int32)
    none_hot = salts[ranks.value.max()] == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, values, offsets in shingle_sets(batch.column(0), k):
                tokens, classes, sizes = [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    if a == b or (c := class_id(values[a:b])) in seen:
                        continue
                    seen.add(c)
                    tokens.append(token_prefix(values[a:b], ranks.value, 0, percent))
                    classes.append(np.full(len(tokens[-1]), c, dtype=np.int64))
                    sizes.append(np.full(len(tokens[-1]), b - a, dtype=np.int32))
                if tokens:
                    token, cls = np.concatenate(tokens), np.concatenate(classes)
                    salt = np.zeros(len(token), np.int32)
                    if not none_hot:
                        many = salts[ranks.value[(token >> U64(64 - SKETCH_BITS)).astype(np.int64)]]
                        salt = np.where(many > 1, mix(cls.view(np.uint64)) % many.astype(np.uint64) + U64(1), U64(0)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(salt), pa.array(cls), pa.array(np.concatenate(sizes))], ["token", "salt", "class", "n"])
                if len(seen) > 1_000_000:
                    seen.clear()

    return docs.select("text").mapInArrow(run, "token long, salt int, class long, n int")


def _shared(prefixes: DataFrame) -> DataFrame:
    """(token, class, n, leader, leader_n): the prefix rows of tokens that more than one class has, with the token's smallest class."""
    of_token = Window.partitionBy("token", "salt").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    led = prefixes.withColumns({"leader": F.first("class").over(of_token), "leader_n": F.first("n").over(of_token), "last": F.last("class").over(of_token)})
    led = written(led.filter("leader != last OR salt > 0"), "ngram-led")
    names = ["token", "class", "n", "leader", "leader_n"]
    cold, hot = led.filter("salt = 0").select(names), led.filter("salt > 0")
    if hot.isEmpty():
        return cold
    # Salted tokens: their leaders come from one row per token and salt; Spark splits a skewed side of the join.
    best = hot.groupBy("token").agg(F.min(F.struct("leader", "leader_n")).alias("best"), F.max("last").alias("top"))
    best = best.filter(F.col("best.leader") != F.col("top")).select("token", F.col("best.leader").alias("leader"), F.col("best.leader_n").alias("leader_n"))
    shared = written(cold.unionByName(hot.select("token", "class", "n").join(best, "token").select(names)), "ngram-shared")
    discard(led)
    return shared


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, ranks, k: int, percent: int) -> DataFrame:
    """(class, n, tokens, parity, narrow, marks, wide) of the wanted classes, from one document of each.

    marks: the prefixes under the second and the third order, in 16 bits a token (tokens that
    fall together make a pair pass, never fail).
    """
    one = written(classes.join(wanted.distinct(), "class", "left_semi").select("rid").distinct(), "ngram-reps")
    found = _keyed(docs).join(maybe_broadcast(one, one.count(), 16), "rid", "left_semi")

    def marks(x: np.ndarray) -> bytes:
        return b"".join((mix(token_prefix(x, ranks.value, o, percent)) >> U64(48)).astype(np.uint16).tobytes() for o in (1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values, offsets in shingle_sets(batch.column(0), k):
                rows = [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if b > a]
                made = [[x.tobytes() for x in rows], [parity_sketch(x, PARITY_BITS) for x in rows], [parity_sketch(x, narrow_bits(len(x))) for x in rows], [marks(x) for x in rows], [parity_sketch(x, wide_bits(len(x))) for x in rows]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_id(x) for x in rows], pa.int64()), pa.array([len(x) for x in rows], pa.int32()), *[pa.array(c, pa.binary()) for c in made]],
                    ["class", "n", "tokens", "parity", "narrow", "marks", "wide"],
                )

    # Equal rows of a representative give equal sets; only one of each class may stay.
    sets = written(found.select("text").mapInArrow(run, "class long, n int, tokens binary, parity binary, narrow binary, marks binary, wide binary"), "ngram-sets", "uncompressed")
    again = sets.groupBy("class").agg(F.count("*").alias("c")).filter("c > 1").limit(1).count()
    return written(sets.dropDuplicates(["class"]), "ngram-sets", "uncompressed") if again else sets


def _tested(pairs: DataFrame, n_pairs: int, sets: DataFrame, columns: list[str], test) -> DataFrame:
    """The pairs (a, b) for which test(n and columns of one, n and columns of the other) holds."""
    asked = pairs.select(F.col("a").alias("class"), "a", "b").unionByName(pairs.select(F.col("b").alias("class"), "a", "b"))
    both = sets.select("class", "n", *columns).join(maybe_broadcast(asked, 2 * n_pairs, 40), "class").select("a", "b", "n", *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            left, right = [], []
            for a, b, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held[:2] != (a, b):
                    held = (a, b, values)
                    continue
                other, held = held, None
                if test(values, other[2]):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return both.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long")


def prefixes_meet(x: bytes, y: bytes) -> bool:
    """Whether two sets' marks share a token under the second order and one under the third."""
    a, b = (np.frombuffer(v, np.uint16).reshape(2, -1) for v in (x, y))
    return all(len(np.intersect1d(a[o], b[o])) for o in range(2))


def _verified(pairs: DataFrame, n_pairs: int, sets: DataFrame, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b), those that are linked.

    Narrow sketches (about 1/64 of the sets' size), then the other orders' prefixes and wide
    sketches (about 1/6) rule out most pairs before whole sets move.
    """

    def near(x: list, y: list) -> bool:
        return (100 + percent) * sketch_distance(x[-1], y[-1]) <= (100 - percent) * (x[0] + y[0])

    def near_by_all(x: list, y: list) -> bool:
        return prefixes_meet(x[1], y[1]) and near(x, y)

    def equal_enough(x: list, y: list) -> bool:
        a, b = np.frombuffer(x[1], dtype=np.uint64), np.frombuffer(y[1], dtype=np.uint64)
        return linked(len(np.intersect1d(a, b, assume_unique=True)), x[0], y[0], percent)

    alike = written(_tested(pairs, n_pairs, sets, ["narrow"], near), "ngram-alike")
    close = written(_tested(alike, alike.count(), sets, ["marks", "wide"], near_by_all), "ngram-close")
    return _tested(close, close.count(), sets, ["tokens"], equal_enough)


def nearest_pairs(i: np.ndarray, j: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of rows are the nearest of one of their rows."""
    ends, pair = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort((pair, np.tile(gap, 2), ends))
    return np.unique(pair[order[np.flatnonzero(np.diff(ends[order], prepend=-1))]])


def _paired(percent: int, nearest: bool):
    """A function over rows (token, lo, hi, own, class, comp, n, parity), sorted by the first three (token: the group's key), that makes candidate pairs.

    nearest: only those that are the nearest of one of their classes in a group.
    """

    def pairs_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        token, lo, hi, own, cls, comp, n = (t.column(c).to_numpy() for c in ("token", "lo", "hi", "own", "class", "comp", "n"))
        bits = np.frombuffer(b"".join(t.column("parity").to_pylist()), dtype=np.uint64).reshape(len(cls), PARITY_BITS // 64)
        met = []
        at, d = np.arange(len(cls) - 1), 1
        while len(at := at[at + d < len(cls)]):
            i, j = at, at + d
            same = (token[i] == token[j]) & (lo[i] == lo[j]) & (hi[i] == hi[j])
            i, j = i[same], j[same]
            at, d = i, d + 1
            keep = (comp[i] != comp[j]) & ((lo[i] == hi[i]) | (own[i] != own[j]))
            keep &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[keep], j[keep]
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
            # Linked sets share at least percent/(100+percent) of n+m, so differ in at most this much.
            near = (100 + percent) * apart <= (100 - percent) * (n[i].astype(np.int64) + n[j])
            i, j = i[near], j[near]
            met.append((i, j, apart[near] / (n[i] + n[j])))
        i, j, gap = (np.concatenate(x) for x in zip(*met)) if met else (at, at, at)
        if nearest:
            keep = nearest_pairs(i, j, gap)
            i, j = i[keep], j[keep]
        found = np.unique(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])], axis=1), axis=0)
        return found[:, 0], found[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(t: pa.Table) -> pa.RecordBatch:
            a, b = pairs_of(t)
            heads = np.flatnonzero(np.diff(a, prepend=a[:1] - 1))
            partners = pa.ListArray.from_arrays(pa.array(np.append(heads, len(b)).astype(np.int32)), pa.array(b))
            return pa.RecordBatch.from_arrays([pa.array(a[heads]), partners], ["a", "partners"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > 200_000:  # work off all groups but the last, which may go on
                t = pa.Table.from_batches(held)
                key = np.stack([t.column(c).to_numpy() for c in ("token", "lo", "hi")])
                cut = int(np.flatnonzero((key != key[:, -1:]).any(axis=0))[-1]) + 1 if (key != key[:, -1:]).any() else 0
                if cut:
                    yield emit(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if rows:
            yield emit(pa.Table.from_batches(held))

    return run


def _open_groups(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, class, comp, n, rows): the classes of tokens that lie in more than one component; rows: how many the token has."""
    first = roots.select(F.col("node").alias("class"), "root")
    groups = shared.select("token", "class", "n").join(maybe_broadcast(first, first.count(), 32), "class", "left")
    groups = groups.select("token", "class", F.coalesce("root", "class").alias("comp"), "n")
    # The tokens of one passage have the same classes: one of them stands for all.  A group is known by its size and 128 bits of sums.
    hashes = (F.xxhash64("class"), F.xxhash64(F.lit(1), "class"))
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]
    sums = [F.sum(half).alias(f"h{i}") for i, half in enumerate(halves)]
    sizes = groups.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"), *sums)
    sizes = sizes.filter("low != high").groupBy("rows", *[f"h{i}" for i in range(len(sums))]).agg(F.min("token").alias("token"))
    sizes = written(sizes.select("token", "rows"), "ngram-groups")
    return written(groups.join(maybe_broadcast(sizes, sizes.count(), 16), "token"), "ngram-own")


def _candidates(open_groups: DataFrame, sets: DataFrame, percent: int, block: int, nearest: bool) -> DataFrame:
    """(a, b): classes of different components that share a token and that sizes and sketches allow; nearest: only each class's nearest of a group."""
    zero = F.lit(0)
    few = open_groups.filter(F.col("rows") <= block).select("token", zero.alias("lo"), zero.alias("hi"), zero.alias("own"), "class", "comp", "n")
    # Larger groups: their largest component goes to blocks of its own, which never meet each other.
    many = open_groups.filter(F.col("rows") > block)
    comps = many.groupBy("token", "comp").agg(F.count("*").alias("c")).groupBy("token").agg(F.max(F.struct("c", "comp")).alias("major"), F.sum("c").alias("rows"))
    blocks = lambda c: F.ceil(c / block).cast("int")
    comps = comps.select("token", F.col("major.comp").alias("major"), blocks(F.col("major.c")).alias("majors"), blocks(F.col("rows") - F.col("major.c")).alias("minors"))
    many = many.drop("rows").join(comps, "token")
    place, is_major = F.xxhash64("class"), F.col("comp") == F.col("major")
    many = many.withColumn("own", F.when(is_major, F.pmod(place, F.col("majors"))).otherwise(F.col("majors") + F.pmod(place, F.col("minors"))).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.when(is_major, F.col("majors")).otherwise(zero), F.col("majors") + F.col("minors") - 1)))
    many = many.select("token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "class", "comp", "n")
    n_sets, row_bytes = sets.count(), 32 + PARITY_BITS // 8
    parity = maybe_broadcast(sets.select("class", "parity"), n_sets, row_bytes)
    columns = ["token", "lo", "hi", "own", "class", "comp", "n", "parity"]
    rows = few.unionByName(many).join(parity, "class").select(columns).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
    found = rows.mapInArrow(_paired(percent, nearest), "a long, partners array<long>")
    # A pair that shares many tokens comes from many tasks: partners are merged before they become rows.
    merged = found.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
    return merged.select("a", F.explode("partners").alias("b"))


def class_components(docs: DataFrame, k: int = K, percent: int = PERCENT, block: int = BLOCK, hot: int = HOT_TOKEN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures: rid, doc_id, n, class; classes: class, its smallest rid, doc_id and (doc_id, rid); components: node, root over the classes that have a link)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    all_rows = written(_signatures(docs, k), "ngram-signatures")
    signatures = all_rows.filter("slice is null").select("rid", "doc_id", "n", "class")
    # Copies meet here, after a partial count per task; from now on a text is one row.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    classes = signatures.filter("class is not null").groupBy("class").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("doc_id"), F.min(order).alias("first"))
    classes = written(classes, "ngram-classes")
    table, mean = _token_ranks(all_rows)
    ranks = spark.sparkContext.broadcast(table)  # 2^SKETCH_BITS bytes, whatever the corpus
    shared = _shared(_prefixes(docs, ranks, mean, k, percent, hot))
    sets = _sets(docs, classes, shared.select("class"), ranks, k, percent)
    fits = 100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")
    star = written(shared.filter((F.col("class") != F.col("leader")) & fits).select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct(), "ngram-stars")
    links = written(_verified(star, star.count(), sets, percent), "ngram-links")
    left = shared
    for nearest in (True, False):  # what the nearest partners connect is not paired again
        roots = written(connected_components(links), "ngram-roots")
        left = _open_groups(left, roots)
        rest = written(_candidates(left, sets, percent, block, nearest), "ngram-rest")
        found = _verified(rest, rest.count(), sets, percent)
        links = written(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found), "ngram-links")
    discard(sets, shared, star, left, rest)
    return signatures, classes, connected_components(links)


def _grouped(classes: DataFrame, components: DataFrame) -> DataFrame:
    """Every class with the smallest doc_id and the first row of its component."""
    rooted = written(classes.join(components.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")), "ngram-rooted")
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min("first").alias("keeper"))
    return written(rooted.select("class", "root").join(smallest, "root").select("class", "component_id", F.col("keeper.rid").alias("keeper")), "ngram-grouped")


def ngram_components(docs: DataFrame, k: int = K, percent: int = PERCENT, **options) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    signatures, classes, components = class_components(docs, k, percent, **options)
    joined = signatures.join(_grouped(classes, components), "class", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, k: int = K, percent: int = PERCENT, **options) -> DataFrame:
    """The rows of docs less all but one of each group: the one with the smallest doc_id stays."""
    signatures, classes, components = class_components(docs, k, percent, **options)
    judged = signatures.filter("class is not null").join(_grouped(classes, components), "class")
    judged = written(judged.select("rid", (F.col("rid") == F.col("keeper")).alias("keeps")), "ngram-judged")
    lost = written(judged.filter("NOT keeps").select(F.col("rid").alias("__ngram_rid")).distinct(), "ngram-lost")
    again = judged.filter("keeps").groupBy("rid").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("rid").alias("__ngram_rid"))
    again = written(again, "ngram-again")
    keyed = docs.withColumn("__ngram_rid", F.xxhash64("doc_id", "text"))
    kept = keyed.join(maybe_broadcast(lost, lost.count(), 16), "__ngram_rid", "left_anti")
    if n_again := again.count():  # rows that repeat another row in doc_id and text
        again = maybe_broadcast(again, n_again, 16)
        twice = kept.join(again, "__ngram_rid", "left_semi").dropDuplicates(["__ngram_rid"])
        kept = kept.join(again, "__ngram_rid", "left_anti").unionByName(twice)
    return kept.select(*docs.columns)
