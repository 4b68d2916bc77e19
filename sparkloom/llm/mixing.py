"""Operator 1: mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources in code point order (null last) weigh 3, 1, 2, 3, ...; a share of all words is
spread over them by weight, no source beyond `most` times its own words, the excess going
to the others by weight.  The targets have a closed form: min(cap, level * weight), with
the level found from prefix sums over the sources ordered by cap / weight.

Every row has a reproducible 63-bit key, and the top bits of the key cut a source into
permuted, disjoint blocks of rows.  A source's target is so many whole epochs (all its
blocks) and a rest.  The rest goes through the rows in key order and takes every row that
fits what is left, until nothing that is left out fits.  That is a few runs of rows: each
run ends before the first row that would pass the target, and the next one goes on behind
it among the rows that still fit.  The end of a run is found digit by digit from sums over
blocks, sub-blocks and at last single rows.  No step sorts a source: each level sees one
block of the level above.

The blocks drawn are exact quotas, one number per source.  A binary tree splits the
output shards in halves down to single shards; each node gives its left half a
multivariate-hypergeometric draw from its quotas.  A shard takes as many blocks of a source
as its leaf says, the next ones of the source's permuted list, and the mix is what the
shards took: a row is in it once for every shard's block that holds it, and what a row adds
to its source's taken words is the sum over the shards.  Inside a shard rows are shuffled
locally by a hash of key and copy.

Edge cases: a null text has no words, and a row without words is taken or not without
effect on the sums; a null source is a source; rows equal in doc_id and text share a key,
and where the cut falls between them as many are taken as fit the target;
with no words at all every target is 0; an empty table gives an empty mix; other columns
are carried along.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_or_empty, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20240
SHARDS = 16
MAX_BITS, SUB_BITS, BLOCK_ROWS = 12, 12, 4
_P = "__mix_"


def source_targets(sources: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, rows) with weight and target; the windows see one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy(F.lit(0))
    upto = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumns(
        {
            "words": F.sum("source_size").over(every) * F.lit(share),
            "cap_upto": F.sum("cap").over(upto),
            "weight_after": F.sum("weight").over(every) - F.sum("weight").over(upto),
        }
    )
    # A source is at its cap when a level that just fills it spends no more than there is.
    s = s.withColumn("full", F.col("cap_upto") + F.col("cap") / F.col("weight") * F.col("weight_after") <= F.col("words"))
    left = F.first("words").over(every) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    s = s.withColumn("level", F.try_divide(left, open_weight))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "rows", "weight", target.alias("target"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """docs with the columns __mix_size (words) and __mix_key."""
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    return docs.withColumns({f"{_P}size": size, f"{_P}key": F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1)})


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns)."""
    if shards == 1:
        return quotas[:, None]
    left = shards // 2
    drawn = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * left // shards, method="marginals")
    return np.concatenate([splitting_tree(drawn, left, rng), splitting_tree(quotas - drawn, shards - left, rng)], axis=1)


def _cut(rows: DataFrame, plan: DataFrame, digit: Column, more: list[str]) -> DataFrame:
    """plan, whose `rest` words are sought among rows, with the digit where they end and the rest inside it."""
    sums = rows.groupBy("sid", digit.alias("digit")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("sid").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    ends = sums.join(plan.select("sid", "rest"), "sid").filter(F.col("before") < F.col("rest"))
    ends = ends.groupBy("sid").agg(F.max(F.struct("digit", "before")).alias("e")).select("sid", F.col("e.digit").alias("digit"), F.col("e.before").alias("before"))
    return plan.join(ends, "sid").select("sid", "bits", (F.col("rest") - F.col("before")).alias("rest"), *more, "digit")


_ADDED = "concat(runs, array(struct(after, upto, most, take, whole)))"


def _run(keyed: DataFrame, left: DataFrame, later: bool) -> DataFrame:
    """(sid, upto, take, whole, gap): the next run of rows that fit, for each source of `left` that has one.

    Of the rows at its last key the first `take` are taken, of those before it all.  The cuts,
    a row per source, are written: inside each other they would be planned many times over.
    """
    block, sub = F.expr("shiftright(key, 63 - bits)"), F.expr(f"shiftright(key, {63 - SUB_BITS} - bits) & {(1 << SUB_BITS) - 1}")
    fits = keyed.join(left.select("sid", "bits", "after", "most"), "sid")
    if later:
        fits = fits.filter("key > after AND size > 0 AND size <= most")
    fits = fits.select("sid", "bits", "size", "key")
    first = written(_cut(fits, left, block, []).withColumnRenamed("digit", "block"), "mix-cuts")
    inside = lambda cut, *more: fits.withColumns({"block": block, "sub": sub}).join(cut.select("sid", *more), ["sid", *(c for c in more if c != "rest")])
    second = written(_cut(inside(first, "block"), first, F.col("sub"), ["block"]).withColumnRenamed("digit", "sub"), "mix-cuts")
    last = inside(second, "block", "sub", "rest")
    # What remains is one block in 2^24 of a source; equal rows travel as one with their count.
    last = last.groupBy("sid", "key", "rest").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    upto = Window.partitionBy("sid").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(upto), F.lit(0))).filter(F.col("before") < F.col("rest"))
    take = F.least(F.col("n"), F.coalesce(F.floor(F.try_divide(F.col("rest") - F.col("before"), F.col("size"))), F.col("n"))).cast("long")
    gap = F.col("rest") - F.col("before") - take * F.col("size")
    last = last.groupBy("sid").agg(F.max(F.struct("key", take.alias("take"), "n", gap.alias("gap"))).alias("c"))
    return last.select("sid", F.col("c.key").alias("upto"), F.col("c.take").alias("take"), (F.col("c.take") == F.col("c.n")).alias("whole"), F.col("c.gap").alias("gap"))


def mixing_plan(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, share: float = SHARE, most: int = MOST, tree=splitting_tree) -> DataFrame:
    """One row per source: sizes, target, whole epochs, where the rest is cut, and which of its blocks each shard takes; rows are `sized`."""
    narrow = rows.select("source", F.col(f"{_P}size").alias("size"), F.col(f"{_P}key").alias("key"))
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = source_targets(sources, share, most)
    bits = F.greatest(F.lit(0), F.least(F.lit(MAX_BITS), F.floor(F.log2(F.col("rows") / BLOCK_ROWS)))).cast("int")
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("int")
    sid = F.xxhash64(F.lit(seed), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    plan = plan.withColumns({"bits": bits, "epochs": epochs, "sid": sid})
    plan = written(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-sources")
    keyed = narrow.select(sid.alias("sid"), "size", "key")
    none = "array<struct<after: bigint, upto: bigint, most: bigint, take: bigint, whole: boolean>>"
    left = plan.select("sid", "bits", "rest", F.lit(-1).cast("long").alias("after"), F.lit((1 << 63) - 1).alias("most"), F.array().cast(none).alias("runs"))
    ended = left.filter("rest <= 0").select("sid", "runs", F.col("rest").alias("gap"))
    left, n = written(left.filter("rest > 0"), "mix-cuts"), 0
    # Every run but a source's last ends at a row longer than the gap, so the rows that fit get shorter and fewer.
    while not left.isEmpty():
        run = written(left.join(_run(keyed, left, n > 0), "sid", "left"), "mix-cuts")
        ended = ended.unionByName(run.filter("upto IS NULL OR gap <= 0").select("sid", F.expr(f"if(upto IS NULL, runs, {_ADDED}) AS runs"), F.expr("if(upto IS NULL, rest, gap) AS gap")))
        left = run.filter("upto IS NOT NULL AND gap > 0")
        left = left.select("sid", "bits", F.col("gap").alias("rest"), F.col("upto").alias("after"), F.expr("cast(floor(gap) AS bigint) AS most"), F.expr(f"{_ADDED} AS runs"))
        n += 1
    plan = plan.join(ended, "sid")
    # The rest counts as so many blocks as its words are worth.
    worth = F.ceil(F.try_divide((F.col("rest") - F.col("gap")) * F.expr("shiftleft(1L, bits)"), F.col("source_size")))
    plan = plan.withColumn("rest_blocks", F.when(F.size("runs") > 0, F.greatest(F.lit(1), worth)).otherwise(0).cast("long"))
    drawn = F.expr("epochs * shiftleft(1L, bits) + rest_blocks").alias("drawn")
    names = ["source", "source_size", "rows", "weight", "target", "epochs", "bits", "runs", "rest_blocks"]
    plan = written(plan.select("sid", *names, drawn), "mix-cuts")

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sid", kind="stable").reset_index(drop=True)
        leaves = tree(pdf["drawn"].to_numpy(np.int64), shards, np.random.Generator(np.random.PCG64(seed)))
        return pd.DataFrame({"sid": pdf["sid"], "shard_ends": list(np.cumsum(leaves, axis=1))})

    # One row per source and none of a document: the tree's quotas fit in one task.
    leaves = plan.select("sid", "drawn").groupBy().applyInPandas(split, "sid long, shard_ends array<long>")
    return written(plan.join(leaves, "sid").drop("sid"), "mix-plan")


def with_shards(rows: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The sized rows with __mix_shards, the shards that take them (one entry per copy), and as __mix_plan their source's plan."""
    p = plan.select(F.col("source").alias(f"{_P}source"), F.struct(*[c for c in plan.columns if c != "source"]).alias(f"{_P}plan"))
    joined = rows.join(p, F.col("source").eqNullSafe(F.col(f"{_P}source"))).drop(f"{_P}source")
    run = F.expr(f"get(filter({_P}plan.runs, r -> {_P}key > r.after AND {_P}key <= r.upto AND {_P}size <= r.most), 0)")
    joined = joined.withColumn(f"{_P}run", run)
    alone = F.coalesce((F.col(f"{_P}key") == F.col(f"{_P}run.upto")) & ~F.col(f"{_P}run.whole"), F.lit(False))
    clear = joined.filter(~alone).withColumn(f"{_P}rest", F.col(f"{_P}run").isNotNull())
    # The row at which a run ends, with the rows equal to it.
    tie = F.row_number().over(Window.partitionBy("source", f"{_P}key").orderBy("doc_id"))
    among = joined.filter(alone).withColumn(f"{_P}rest", tie <= F.col(f"{_P}run.take"))
    drawn = clear.unionByName(among).drop(f"{_P}run")
    # A row's places in the list of its source's blocks: one in each whole epoch, whose blocks an odd
    # multiplier permutes, and one in the rest, which keeps key order; rows of the rest in later blocks
    # than its words are worth go to the earlier ones in turn.
    block, blocks = f"shiftright({_P}key, 63 - {_P}plan.bits)", f"shiftleft(1L, {_P}plan.bits)"
    epochs = f"transform(filter(sequence(0, {_P}plan.epochs), c -> c < {_P}plan.epochs), c -> c * {blocks} + (({block} * (2 * c + 5) + {seed}) & ({blocks} - 1)))"
    rest = f"CASE WHEN {_P}rest THEN array({_P}plan.epochs * {blocks} + {block} % {_P}plan.rest_blocks) ELSE cast(array() AS array<bigint>) END"
    drawn = drawn.withColumn(f"{_P}places", F.expr(f"concat({epochs}, {rest})"))
    # A shard's blocks end where its leaf and those before it say; what no shard takes is not in the mix.
    shard = f"size(filter({_P}plan.shard_ends, x -> x <= i))"
    return drawn.withColumn(f"{_P}shards", F.expr(f"filter(transform({_P}places, i -> {shard}), s -> s < size({_P}plan.shard_ends))")).drop(f"{_P}places", f"{_P}rest")


def taken(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, shards."""
    rows = written(sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    mixed = with_shards(rows, mixing_plan(rows, seed=seed, **options), seed)
    size, copies = F.col(f"{_P}size"), F.size(f"{_P}shards")
    plan = [F.col(f"{_P}plan.{c}").alias(c) for c in ("source_size", "target")]
    return mixed.select("doc_id", "source", size.alias("size"), *plan, copies.alias("copies"), (size * copies).cast("long").alias("taken"), F.array_join(f"{_P}shards", ",").alias("shards"))


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: every drawn copy of a row, with the columns shard, slot_key and copy after those of docs.

    Inside a shard, ascending slot_key is the local shuffle.
    """
    plan = mixing_plan(written(sized(docs, seed).select("source", f"{_P}size", f"{_P}key"), "mix-sizes"), shards, seed, **options)
    drawn = with_shards(sized(docs, seed), plan, seed)
    drawn = drawn.select(*docs.columns, f"{_P}key", F.posexplode(f"{_P}shards").alias(f"{_P}copy", f"{_P}shard"))
    own = [F.col(f"{_P}shard").alias("shard"), F.xxhash64(F.lit(seed + 1), f"{_P}key", f"{_P}copy").alias("slot_key"), F.col(f"{_P}copy").alias("copy")]
    return drawn.select(*docs.columns, *own)


def write_mix(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """Write the mix as one folder a shard, the rows of a file in the order of their shuffle; docs has no columns named shard, slot_key or copy."""
    drawn = mix(docs, shards, **options).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot_key")
    drawn.drop("slot_key", "copy").write.partitionBy("shard").parquet(path)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with the columns of docs only, copies repeated."""
    clash = {"shard", "slot_key", "copy"} & set(docs.columns)
    held = docs.select(*[F.col(c).alias(f"{_P}own_{c}") if c in clash else F.col(c) for c in docs.columns])
    drawn = mix(held, **options)
    return drawn.select(*[F.col(f"{_P}own_{c}").alias(c) if c in clash else F.col(c) for c in docs.columns])
