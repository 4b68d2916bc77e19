"""Grouped statistics over trials, judgements, event logs and outcome rows.

All are single-shuffle aggregations with map-side partials; percentiles by index sort one
group's values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL_SCORE, HIGH_SCORE = 0.999, 0.8


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def trial_summary(trials: DataFrame, high: float = HIGH_SCORE) -> DataFrame:
    """Per sample: count, mean, median, population deviation, range, p75, counts of full and high scores."""
    s = F.col("score")
    g = trials.groupBy("sample").agg(
        F.count("*").alias("n"),
        F.round(F.avg(s), 6).alias("mean"),
        F.median(s).alias("median"),
        F.round(F.stddev_pop(s), 6).alias("std"),
        F.min(s).alias("low"),
        F.max(s).alias("high"),
        F.round(F.percentile(s, F.lit(0.75)), 6).alias("p75"),
        F.count_if(s >= FULL_SCORE).alias("n_full"),
        F.count_if(s >= high).alias("n_high"),
    )
    spread = F.round(F.col("high") - F.col("low"), 6).alias("spread")
    admission = F.round(F.greatest(F.col("median"), F.col("p75") - 0.03), 6).alias("admission")
    return g.select("*", spread, admission)


def item_stability(trials: DataFrame, possible: float = 1.0) -> DataFrame:
    """Per item position: mean, deviation, hits and misses of its awards over all samples."""
    hit = F.col("score") >= 0.5 * possible
    return trials.groupBy(F.col("trial").alias("position")).agg(
        F.round(F.avg("score"), 6).alias("mean"), F.round(F.stddev_pop("score"), 6).alias("std"), F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses")
    )


def representative_trial(trials: DataFrame) -> DataFrame:
    """Per sample the median and the trial closest to it, the lowest id on ties."""
    medians = trials.groupBy("sample").agg(F.median("score").alias("median"), F.collect_list(F.struct("trial", "score")).alias("t"))
    closest = F.array_min(F.transform("t", lambda x: F.struct(F.abs(x["score"] - F.col("median")).alias("d"), x["trial"].alias("trial"))))
    return medians.select("sample", "median", closest["trial"].alias("representative"))


def pooled_judgements(judgements: DataFrame) -> DataFrame:
    """Per sample the mean over all judgements pooled (not the mean of trial means), and the trial whose own mean is closest."""
    per_trial = judgements.groupBy("sample", "trial").agg(F.sum("awarded").alias("a"), F.sum("possible").alias("p"), F.count("*").alias("repeats"))
    pooled = per_trial.groupBy("sample").agg(
        F.sum("repeats").alias("judgements"),
        F.sum("a").alias("awarded"),
        F.sum("p").alias("possible"),
        F.collect_list(F.struct("trial", (F.col("a") / F.col("p")).alias("mean"))).alias("t"),
    )
    mean = F.col("awarded") / F.col("possible")
    closest = F.array_min(F.transform("t", lambda x: F.struct(F.round(F.abs(x["mean"] - mean), 9).alias("d"), x["trial"].alias("trial"))))
    return pooled.select("sample", "judgements", F.round(mean, 6).alias("pooled_mean"), closest["trial"].alias("representative"))


def judge_spread(judgements: DataFrame) -> DataFrame:
    """Per trial: mean, least, largest and range of the judges' ratios."""
    r = F.col("awarded") / F.col("possible")
    g = judgements.groupBy("sample", "trial").agg(F.count("*").alias("repeats"), F.round(F.avg(r), 6).alias("mean"), F.min(r).alias("low"), F.max(r).alias("high"))
    return g.withColumn("spread", F.round(F.col("high") - F.col("low"), 6))


def index_percentile(values: Column, share: float, half_even: bool) -> Column:
    """The value at index round((n-1) share) (half to even) or int((n-1) share) of the sorted values."""
    at = (F.size(values) - 1) * share
    index = F.bround(at) if half_even else F.floor(at)
    return F.get(F.sort_array(values), index.cast("int"))


def effect_matrix(effects: DataFrame, *keys: str) -> DataFrame:
    """Per group: outcome counts by label, mean change and share of hits."""
    g = effects.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.round(F.avg("delta"), 4).alias("mean_delta"),
        *[F.count_if(F.col("label") == x).alias(f"n_{x}") for x in ("full", "missing", "dropped", "slight_drop", "increased", "flat")],
    )
    return g.withColumn("hit_rate", F.round(rate(F.col("n_dropped") + F.col("n_slight_drop"), F.col("n")), 4))


SIGNATURE = ("core_capability", "overscore_cause", "failure_mode", "operator")
EFFECT_FLAGS = {
    "boundary_hits": "boundary_hit",
    "score_increases": "score_increased",
    "full_scores": "is_full_score",
    "repeated_patterns": "repeated_pattern",
    "redundancies": "redundancy",
    "repeated_contexts": "repeated_context",
    "answer_hints": "answer_hint",
    "surface_leaks": "surface_leak",
}


def full_effect_matrix(effects: DataFrame) -> DataFrame:
    """Per signature (SIGNATURE; null is blank): n, mean_delta, hit_rate, eleven conditional counts, two value counts and the mean change in characters.

    effects have the signature, delta, effect_label, complexity_passed, risk, leak_types (a list),
    review_status, char_delta and the booleans of EFFECT_FLAGS.  A missing delta counts as zero, a
    null flag as false (complexity that did not pass counts as invalid); a blank review status is
    not_reviewed; the mean of character changes is null where none is known.  Value counts are
    'value:count' in order of value.
    """
    keys = list(SIGNATURE)
    e = effects.withColumns({k: F.coalesce(F.trim(F.col(k)), F.lit("")) for k in keys})
    e = e.withColumn("review_status", F.coalesce(F.nullif(F.trim("review_status"), F.lit("")), F.lit("not_reviewed")))
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    whole = e.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(F.coalesce("delta", F.lit(0.0))).alias("mean_delta"),
        *[yes(F.col(flag)).alias(name) for name, flag in EFFECT_FLAGS.items()],
        yes(F.col("effect_label") == "effective_boundary_probe").alias("effective_probes"),
        F.count_if(~F.coalesce("complexity_passed", F.lit(False))).alias("invalid_complexities"),
        yes(F.col("risk").isin("medium", "high")).alias("semantic_risks"),
        F.avg("char_delta").alias("mean_char_delta"),
    )

    def counts(values: DataFrame, name: str) -> DataFrame:
        each = values.groupBy(*keys, "value").agg(F.count("*").alias("c"))
        listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("value", "c"))), lambda x: F.concat_ws(":", x["value"], x["c"].cast("string"))), ",")
        return each.groupBy(*keys).agg(listed.alias(name))  # one value of a fixed vocabulary each

    types = counts(e.select(*keys, F.explode("leak_types").alias("value")), "leak_type_counts")
    reviews = counts(e.select(*keys, F.col("review_status").alias("value")), "review_counts")
    joined = whole.join(types, keys, "left").join(reviews, keys, "left")
    return joined.withColumns({"hit_rate": rate(F.col("boundary_hits"), F.col("n")), "leak_type_counts": F.coalesce("leak_type_counts", F.lit(""))})


def yield_statistics(log: DataFrame, fields: list[str], operator: str = "operator") -> DataFrame:
    """Attempts, hits, errors and hits per hour by operator, and by operator and value of each field; blank values drop out."""
    globally = F.struct(F.lit("all").alias("field"), F.lit("all").alias("value"))
    each = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    rows = log.withColumn("g", F.explode(F.array(globally, *each))).filter("g.value IS NOT NULL AND trim(g.value) <> ''")
    g = rows.groupBy("g.field", "g.value", operator).agg(
        F.count("*").alias("attempts"), F.count_if("hit").alias("hits"), F.count_if("error").alias("errors"), F.round(F.sum("seconds"), 2).alias("seconds")
    )
    return g.withColumn("hits_per_hour", F.round(rate(F.col("hits") * 3600.0, F.col("seconds")), 4))


def repeat_medians(runs: DataFrame, run: str, side: str, least_runs: int = 3) -> DataFrame:
    """Per side and metric over at least so many runs: median, least, largest; then the baseline's median over the other's."""
    metrics = [c for c in runs.columns if c not in (run, side)]
    long = runs.unpivot([run, side], metrics, "metric", "reading").filter("reading IS NOT NULL")
    g = long.groupBy("metric").agg(
        F.count("*").alias("readings"),
        F.round(F.median(F.when(F.col(side) == "baseline", F.col("reading"))), 4).alias("baseline"),
        F.round(F.median(F.when(F.col(side) != "baseline", F.col("reading"))), 4).alias("optimised"),
        F.round(F.min("reading"), 4).alias("low"),
        F.round(F.max("reading"), 4).alias("high"),
    )
    return g.filter(F.col("readings") >= 2 * least_runs).withColumn("speedup", F.round(F.try_divide("baseline", "optimised"), 4))


def event_rollup(events: DataFrame, branch: str, start: str, end: str) -> DataFrame:
    """Per branch: its first start and last end, latency, failures."""
    is_start, is_end = F.col("event_type") == start, F.col("event_type") == end
    g = events.groupBy(branch).agg(
        F.min(F.when(is_start, F.col("ts"))).alias("started"),
        F.max(F.when(is_end, F.col("ts"))).alias("ended"),
        F.count_if(is_end).alias("completed"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("started"), F.col("ended"))
    return g.select(branch, F.when(F.col("ended") >= F.col("started"), seconds).alias("latency"), "completed", "errors")


def latency_percentiles(rollup: DataFrame) -> DataFrame:
    """p50 and p95 of the latencies by half-even index, over one value per branch."""
    v = rollup.agg(F.collect_list("latency").alias("v"))
    return v.select(F.size("v").cast("long").alias("n"), index_percentile(F.col("v"), 0.5, True).alias("p50"), index_percentile(F.col("v"), 0.95, True).alias("p95"))


def histogram(df: DataFrame, *keys: str) -> DataFrame:
    """Counts by a composite key joined with `+`, blanks as `missing`."""
    parts = [F.coalesce(F.nullif(F.trim(F.col(k).cast("string")), F.lit("")), F.lit("missing")) for k in keys]
    return df.groupBy(F.concat_ws("+", *parts).alias("bucket")).agg(F.count("*").alias("n"))


def top_reasons(df: DataFrame, group: str, reason: str, k: int = 5) -> DataFrame:
    """The k most frequent reasons of every group, by name on ties."""
    from pyspark.sql import Window

    counts = df.groupBy(group, reason).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), reason)
    return counts.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= k)


def round_metrics(scores: DataFrame, round_: str, stop_below: float = 0.5) -> DataFrame:
    """Per round: mean score, effective and continued samples, flat streak so far, and whether to stop."""
    from pyspark.sql import Window

    g = scores.groupBy(round_).agg(F.round(F.avg("score"), 4).alias("mean"), F.count_if("effective").alias("effective"), F.count_if("continued").alias("continued"))
    w = Window.orderBy(round_)  # one row per round
    flat = (F.abs(F.col("mean") - F.lag("mean").over(w)) < 0.01).cast("int")
    g = g.withColumn("flat", F.coalesce(flat, F.lit(0)))
    g = g.withColumn("island", F.sum(1 - F.col("flat")).over(w))
    streak = F.sum("flat").over(Window.partitionBy("island").orderBy(round_))
    return g.select(round_, "mean", "effective", "continued", streak.alias("flat_rounds"), (F.col("mean") < stop_below).alias("stop"))


def micro_average(rows: DataFrame, key: str, awarded: str, possible: str) -> DataFrame:
    """Sum of awards over sum of positive possible points, per key (not a mean of rates)."""
    p = F.sum(F.when(F.col(possible) > 0, F.col(possible)).otherwise(0.0))
    return rows.groupBy(key).agg(F.round(rate(F.sum(awarded), p), 6).alias("rate"), F.count("*").alias("n"))


def status_crosstab(rows: DataFrame, key: str, status: str, values: list[str]) -> DataFrame:
    """A count per key and status, one column a status, and the most frequent one."""
    g = rows.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(F.col(status) == v).alias(v) for v in values])
    best = F.greatest(*values)
    mode = F.coalesce(*[F.when(F.col(v) == best, F.lit(v)) for v in values])
    return g.withColumn("mode", mode)


def unstable_groups(rows: DataFrame, keys: list[str], kind: str, both: tuple[str, str]) -> DataFrame:
    """Groups in which both kinds occur."""
    g = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(kind)).alias("kinds"))
    return g.filter(F.array_contains("kinds", both[0]) & F.array_contains("kinds", both[1])).select(*keys, "n", F.concat_ws(",", "kinds").alias("kinds"))


def merged_counts(counted: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by key where evidence fills only what is missing or zero."""
    c, e = counted.withColumnRenamed("n", "own"), evidence.withColumnRenamed("n", "seen")
    n = F.when(F.coalesce("own", F.lit(0)) > 0, F.col("own")).otherwise(F.coalesce("seen", F.lit(0)))
    return c.join(e, keys, "full_outer").select(*keys, n.alias("n"))
