"""Operator 10: benchmark decontamination with spaced-seed hashing.

Native: built-in functions only.  Texts become lower-case words (runs of letters and
digits).  A spaced seed hashes the words of a window that its mask keeps and ignores the
others, so a passage whose words were replaced here and there still meets its original
wherever a window's kept words survived.  Equal hashes of a document and a benchmark item
are a hit; around every hit the words of both, aligned on it, are compared one by one.  A
document is contaminated by an item when a hit has at least `enough` equal words around
it, or `share` of all the item's words.

Documents outnumber the benchmark's seeds by far, so their windows are first tested
against a bitmap of the benchmark's hashes, two bits a hash, whose size follows the
benchmark: 64 bits a seed up to `MAX_BITMAP_BITS` (beyond a million seeds it fills up, which
lets more windows through and loses none).  Windows that pass leave the text with a slice of
words around them, and only those rows are joined.

The masks leave no accepted passage out that is aligned with an item of up to 25 words:
however the replaced words lie, some window of the item has all its kept words.  That was
found by enumerating all patterns, with shorter masks for items under `SPAN` words.  Among
longer items a pattern of scattered words may have no such window, the rarer the more of
its words are equal.  Items of 3 or 4 words must be there in full, word by word.  Items of
fewer words say nothing about where a document comes from: no document is reported for them,
and `unscreened` lists them.

Edge cases: null or empty texts on either side match nothing; rows that repeat a doc_id
are reported once per item, and filtered row by row; items that repeat an item_id are
compared one by one; empty tables give an empty report; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, text_or_empty, written

#: Kept positions of the spaced seeds, for items of SPAN words or more and for shorter ones.
MASKS = ("11101", "1101001", "11000101", "1000100101", "10000001101")
SHORT_MASKS = ("111", "1101")
SPAN = 12
#: Items of fewer words are not screened for; up to SHORTEST_SHARE words all must be equal.
MIN_ITEM, SHORTEST_SHARE = 3, 4
#: Words compared on either side of a hit's window.
REACH = 20
ENOUGH, SHARE_PERCENT = 15, 75
BITS_PER_SEED, MAX_BITMAP_BITS = 64, 1 << 26
WORDS = r"([\p{L}\p{N}]+)"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(1))


def _hash(hashes: str, at: str, mask: str) -> str:
    kept = ", ".join(f"get({hashes}, {at} + {i})" for i, c in enumerate(mask) if c == "1")
    return f"xxhash64({kept})"


def _items(benchmark: DataFrame) -> DataFrame:
    """(key, item_id, words) of the items that can match; key tells repeated ids apart."""
    items = benchmark.select("item_id", _words(text_or_empty()).alias("words")).filter(F.size("words") >= MIN_ITEM)
    return items.select(F.xxhash64("item_id", "words").alias("key"), "item_id", "words").distinct()


def _seeds(items: DataFrame, masks: list[str]) -> DataFrame:
    """(mask, seed, key, p): the hash of every window of every item."""
    hashed = items.withColumn("h", F.expr("transform(words, w -> xxhash64(w))"))
    out = None
    for m, mask in enumerate(masks):
        of_length = F.size("words") >= SPAN if mask in MASKS else F.size("words") < SPAN
        last = F.size("h") - len(mask)
        one = hashed.filter(of_length).select("key", "h", F.explode(F.sequence(F.lit(0), last)).alias("p"))
        one = one.select(F.lit(m).alias("mask"), F.expr(_hash("h", "p", mask)).alias("seed"), "key", "p")
        out = one if out is None else out.unionByName(one)
    return out


def unscreened(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_words): the items that are too short to be screened for."""
    items = benchmark.select("item_id", F.size(_words(text_or_empty())).cast("long").alias("item_words"))
    return items.filter(F.col("item_words") < MIN_ITEM)


def _bitmap(seeds: DataFrame, n: int) -> Callable[[Column], Column]:
    """The test whether a hash may be among the n seeds; never false for one that is."""
    bits = 1 << 12
    while bits < min(BITS_PER_SEED * n, MAX_BITMAP_BITS):
        bits *= 2
    # Two bits a hash: from its low and from its high half.
    slots = lambda s: (s.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(s, 32).bitwiseAND(F.lit(bits - 1)))
    cells = seeds.select(F.explode(F.array(*slots(F.col("seed")))).alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("cell"))
    cells = cells.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits"))
    # At most MAX_BITMAP_BITS / 64 cells, as text: a row for 1,024 of them.
    pages = cells.groupBy(F.shiftright("cell", 10)).agg(F.array_join(F.collect_list(F.concat_ws(",", "cell", "bits")), ",").alias("cells"))
    filled = np.zeros(bits // 64, dtype=">i8")
    for page in pages.toLocalIterator():
        pairs = np.array(page.cells.split(","), dtype=np.int64).reshape(-1, 2)
        filled[pairs[:, 0]] = pairs[:, 1]
    # A constant array of longs; each test is a shift and a mask.
    sc = seeds.sparkSession.sparkContext
    longs = sc._gateway.new_array(sc._jvm.long, len(filled))
    sc._jvm.java.nio.ByteBuffer.wrap(filled.tobytes()).asLongBuffer().get(longs)
    # Spark's packed form of an array, as plans print a plain one in full, once for each use.
    catalyst, ddl = sc._jvm.org.apache.spark.sql.catalyst.expressions, sc._jvm.org.apache.spark.sql.types.DataType.fromDDL
    packed = catalyst.Literal(catalyst.UnsafeArrayData.fromPrimitiveArray(longs), sc._jvm.org.apache.spark.sql.types.ArrayType(ddl("bigint"), False))
    bitmap = Column(sc._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(packed))

    def may_be(s: Column) -> Column:
        bit = lambda x: F.call_function("shiftright", F.get(bitmap, F.shiftright(x, 6).cast("int")), x.bitwiseAND(F.lit(63)).cast("int"))
        low, high = (bit(x).bitwiseAND(F.lit(1).cast("long")) == 1 for x in slots(s))
        return low & high

    return may_be


def hits(docs: DataFrame, benchmark: DataFrame, enough: int = ENOUGH, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """(rid, doc_id, item_id, key, item_words, matched): hits with enough equal words; rid is a hash of doc_id and text."""
    items = written(_items(benchmark), "benchmark-items")
    masks = [*MASKS, *(() if items.filter(F.size("words") < SPAN).isEmpty() else SHORT_MASKS)]
    seeds = written(_seeds(items, masks), "benchmark-seeds")
    n_items, n_seeds, n_bytes = items.count(), seeds.count(), items.agg(F.sum(F.expr("aggregate(words, 64L, (n, w) -> n + 40 + octet_length(w))"))).first()[0] or 0
    seen = _bitmap(seeds.select("seed"), n_seeds)
    vocabulary = items.select(F.explode("words").alias("w")).select(F.xxhash64("w").alias("seed")).distinct()
    known = _bitmap(vocabulary, vocabulary.count())

    def passes(i: Column) -> Column:
        """A window whose kept words are not all words of the benchmark meets no seed, so most are not hashed."""
        found = F.lit(False)
        for m in masks:
            at = [(i + k).cast("int") for k, c in enumerate(m) if c == "1"]
            here = F.coalesce(F.get(F.col("k"), at[1]), F.lit(False))
            for x in at[2:]:
                here = here & F.coalesce(F.get(F.col("k"), x), F.lit(False))
            found = found | (here & F.exists(F.array(F.xxhash64(*[F.get(F.col("h"), x) for x in at])), seen))
        return F.get(F.col("k"), i) & found

    # The row number is there for the optimizer: a filter on the exploded windows may not
    # move below it, where it would compute the hashes of a whole text for every window.
    w = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", "text").alias("rid"), "doc_id", _words(text_or_empty()).alias("words"))
    w = w.withColumn("h", F.expr("transform(words, w -> xxhash64(w))"))
    w = w.withColumn("k", F.transform("h", known))
    shortest = min(map(len, masks))
    starts = F.sequence(F.lit(0), F.greatest(F.size("h") - shortest, F.lit(0)))
    w = w.withColumn("at", F.when(F.size("h") < shortest, F.expr("cast(array() AS array<int>)")).otherwise(F.filter(starts, passes)))
    # A slice of at most SPAN + 2 REACH words leaves the text with each window.
    w = w.select("row", "rid", "doc_id", F.explode(F.expr(f"""transform(at, i -> struct(i,
        least(i, {REACH}) AS lead, slice(words, greatest(i - {REACH}, 0) + 1, {SPAN + REACH} + least(i, {REACH})) AS near,
        array({', '.join(_hash('h', 'i', m) for m in masks)}) AS seeds))""")).alias("c"))
    w = w.filter("row >= 0").select("rid", "doc_id", "c.lead", "c.near", F.posexplode("c.seeds").alias("mask", "seed"))
    hit = w.join(maybe_broadcast(seeds, n_seeds, 64), ["mask", "seed"])
    hit = hit.join(maybe_broadcast(items, 1, n_bytes + 64 * n_items), "key")
    matched = F.expr(f"""size(filter(sequence(-{REACH}, {SPAN + REACH - 1}),
        k -> k + lead >= 0 AND k + p >= 0 AND coalesce(get(near, k + lead) = get(words, k + p), false)))""")
    hit = hit.select("rid", "doc_id", "item_id", "key", F.size("words").alias("item_words"), matched.alias("matched"))
    share = F.when(F.col("item_words") <= SHORTEST_SHARE, 100).otherwise(share_percent)
    return hit.filter((F.col("matched") >= enough) | (100 * F.col("matched") >= share * F.col("item_words")))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """A row per contaminated document and item: doc_id, item_id, item_words, matched (the most around one hit)."""
    found = hits(docs.select("doc_id", "text"), benchmark, **options)
    best = found.groupBy("doc_id", "item_id").agg(F.max("item_words").alias("item_words"), F.max("matched").alias("matched"))
    return best.select("doc_id", "item_id", F.col("item_words").cast("long").alias("item_words"), F.col("matched").cast("long").alias("matched"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that no benchmark item contaminates."""
    lost = hits(docs.select("doc_id", "text"), benchmark, **options).select(F.col("rid").alias("__clean_rid")).distinct()
    lost = written(lost, "contaminated")
    keyed = docs.withColumn("__clean_rid", F.xxhash64("doc_id", "text"))
    return keyed.join(maybe_broadcast(lost, lost.count(), 16), "__clean_rid", "left_anti").select(*docs.columns)


#: Brute force in DuckDB's SQL, over the tables documents and benchmark: all words of both sides that are
#: equal, counted by alignment.  The same wherever items have up to 25 words, and over longer ones whose
#: equal words are not scattered; a hit reaches over 52 words at most.
DECONTAMINATE_SQL = r"""
WITH b AS (SELECT DISTINCT item_id, words, len(words) AS n FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM benchmark) WHERE len(words) >= 3),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM documents),
bw AS (SELECT item_id, n, unnest(words) AS w, unnest(range(0, n)) AS p FROM b),
dw AS (SELECT rid, doc_id, unnest(words) AS w, unnest(range(0, len(words))) AS i FROM d),
a AS (SELECT rid, doc_id, item_id, n, i - p AS shift, count(*) AS matched FROM dw JOIN bw USING (w) GROUP BY ALL)
SELECT doc_id, item_id, max(n) AS item_words, least(max(matched), 52) AS matched
FROM a WHERE matched >= 15 OR 100 * matched >= (CASE WHEN n <= 4 THEN 100 ELSE 75 END) * n GROUP BY ALL
"""
