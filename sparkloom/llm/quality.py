"""Operator 9: quality rules with adaptive thresholds from mergeable quantile sketches.

Native: built-in functions only.  Each text is reduced to six counts.  Per language and
source, four ratios (symbols, repeated lines and repeated words in thousandths, word length
in hundredths) are summarised by a mergeable quantile sketch: counts in logarithmic buckets
of six significant bits, so a sketch has some hundred buckets whatever the values, errs by
one part in 32 at most, and partial sketches of any split of the rows add up to the same
sketch, in any order.  Every group's sketch is merged with its language's, which weighs as
much as `SHRINK` rows: a large group speaks for itself, a small one borrows, without a switch.

A group's fence is its upper quartile plus `FENCE` quartile ranges (for the word length also
its lower quartile less as many).  There is no fixed cutoff: where a group has no symbols or
repetitions its fence is a rate of zero.  A document's count must exceed what the fence
allows for its length by more than chance: by `SIGMAS` standard deviations of a count that
comes in clumps of so many (`RATIOS`).  Fences come back to the rows by a join; a row that
passes the base rule and no fence excludes is kept.

Only rows that pass the base rule (50 words, at most half of them in repeated 3-word
windows) feed the sketches, so junk does not move the fences.

Edge cases: a null or empty text has no words, fails the base rule and is not kept;
null language or source are groups like others; rows are judged one by one, so copies
and repeated ids do not matter; a ratio may be as large as it likes, it is judged as it is;
an empty table gives an empty result; columns other than text, lang and source are carried
along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_CLASS, BLANKS, WORD, text_or_empty, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: ratio name: (count, base, unit, words or lines in a clump, has a lower fence).
#: A repetition covers about two lines of ten words.
RATIOS = {
    "symbols": ("n_symbols", "n_words", 1000, 1, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 1, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 20, False),
    "word_length": ("word_chars", "n_words", 100, 1, True),
}
FENCE = 4
SIGMAS = 4
SHRINK = 50
#: Significant bits of a sketch's buckets.
BITS = 6


def with_features(docs: DataFrame, into: str = "quality") -> DataFrame:
    """docs with a struct column of the counts; `into` must not be a column of docs."""
    words, lines, hashes, grams, starts = (f"{into}__{x}" for x in ("words", "lines", "hashes", "grams", "starts"))
    text = text_or_empty()
    df = docs.withColumns(
        {
            words: F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
            lines: F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANK_CLASS[1:-1]}]")),
        }
    )
    df = df.withColumn(
        hashes,
        F.expr(f"""transform(slice(`{words}`, 1, greatest(size(`{words}`) - 2, 0)),
            (w, i) -> xxhash64(w, get(`{words}`, i + 1), get(`{words}`, i + 2)))"""),
    )
    # Windows as (hash, position), sorted so that equal windows become neighbours; most texts
    # repeat none, which a hash set tells without a sort.
    df = df.withColumn(
        grams,
        F.expr(f"""CASE WHEN size(array_distinct(`{hashes}`)) = size(`{hashes}`) THEN cast(array() AS array<struct<h: bigint, p: int>>)
            ELSE sort_array(transform(`{hashes}`, (h, i) -> struct(h AS h, i AS p))) END"""),
    )
    df = df.withColumn(
        starts,
        F.expr(f"""sort_array(transform(filter(`{grams}`,
            (g, k) -> g.h <=> get(`{grams}`, k - 1).h OR g.h <=> get(`{grams}`, k + 1).h), g -> g.p))"""),
    )
    feature = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        # The union of windows [p, p+2], from the gaps between sorted starts.
        F.expr(f"""aggregate(transform(`{starts}`, (p, k) -> least(3, coalesce(p - get(`{starts}`, k - 1), 3))),
            0L, (total, x) -> total + x)""").alias("n_repeat_words"),
    )
    return df.withColumn(into, feature).drop(words, lines, hashes, grams, starts)


def _base_failed(q: str) -> Column:
    n = F.col(f"{q}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def bucket_of(value: str) -> str:
    """The lower end of the bucket that a whole number of 0 or more falls in: its first BITS bits, then zeros."""
    low = f"greatest(length(bin({value})) - {BITS}, 0)"
    return f"shiftleft(shiftright({value}, {low}), {low})"


def sketch(df: DataFrame, q: str = "quality") -> DataFrame:
    """(lang, source, ratio, bucket, n): the quantile sketches of all rows that pass the base rule.

    df should be a written table: a filter moved below the counts would compute them again and again.
    """
    ratios = F.array(*[F.expr(f"struct('{r}' AS ratio, {unit} * `{q}`.{count} div greatest(`{q}`.{base}, 1) AS value)") for r, (count, base, unit, _, _) in RATIOS.items()])
    rows = df.filter(~_base_failed(q)).select("lang", "source", F.explode(ratios).alias("r")).select("lang", "source", "r.ratio", "r.value")
    return rows.groupBy("lang", "source", "ratio", F.expr(bucket_of("value")).alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """Add up sketches over everything but the keys."""
    return sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, shrink: int = SHRINK) -> DataFrame:
    """(lang, source, ratio, q1, q3): the buckets that hold the quartiles of each group's sketch merged with `shrink` rows' worth of its language's."""
    lent = merge(sketches, "lang").select(F.col("lang").alias("l_lang"), "ratio", "bucket", F.col("n").alias("lent"))
    groups = sketches.select("lang", "source").distinct()
    borrowed = groups.join(lent, F.col("lang").eqNullSafe(F.col("l_lang"))).select("lang", "source", "ratio", "bucket", F.lit(0).cast("long").alias("own"), "lent")
    own = sketches.select("lang", "source", "ratio", "bucket", F.col("n").alias("own"), F.lit(0).cast("long").alias("lent"))
    both = own.unionByName(borrowed).groupBy("lang", "source", "ratio", "bucket").agg(F.sum("own").alias("own"), F.sum("lent").alias("lent"))
    # A group's buckets: some hundred, however many rows it has.
    w = Window.partitionBy("lang", "source", "ratio")
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    both = both.withColumn("weight", (whole("own") * F.sum("lent").over(w).cast("decimal(18,0)") + shrink * whole("lent")).cast("decimal(36,0)"))
    upto = F.sum("weight").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = both.withColumns({"upto": upto, "total": F.sum("weight").over(w)})
    return ranked.groupBy("lang", "source", "ratio").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )


def fences(sketches: DataFrame, shrink: int = SHRINK, fence: int = FENCE) -> DataFrame:
    """(lang, source) with a high rate for every ratio and a low one for the word length."""
    reach = fence * (F.col("q3") - F.col("q1"))
    bounds = []
    for name, (*_, has_low) in RATIOS.items():
        here = F.col("ratio") == name
        bounds.append(F.max(F.when(here, F.col("q3") + reach)).alias(f"high_{name}"))
        if has_low:
            bounds.append(F.max(F.when(here, F.greatest(F.col("q1") - reach, F.lit(0)))).alias(f"low_{name}"))
    return quartiles(sketches, shrink).groupBy("lang", "source").agg(*bounds)


def _beyond(q: str, name: str) -> Column:
    """Whether a row's count lies beyond its group's fence by more than chance."""
    count, base, unit, clump, has_low = RATIOS[name]
    n = f"`{q}`.{count}"
    mean = lambda side: f"(cast(`{q}__{side}_{name}` AS double) * `{q}`.{base} / {unit}.0D)"
    test = f"{n} > {mean('high')} + {SIGMAS}.0D * sqrt({clump}.0D * {mean('high')}) + {SIGMAS * clump}.0D"
    if has_low:
        test += f" OR {n} < {mean('low')} - {SIGMAS}.0D * sqrt({clump}.0D * {mean('low')}) - {SIGMAS * clump}.0D"
    return F.expr(f"coalesce({test}, false)")


def verdicts(df: DataFrame, q: str = "quality", shrink: int = SHRINK, fence: int = FENCE) -> DataFrame:
    """df (which has the struct q) with the booleans base_failed and kept inside q."""
    bounds = fences(sketch(df, q), shrink, fence)
    names = [c for c in bounds.columns if c not in ("lang", "source")]
    bounds = bounds.select(F.col("lang").alias(f"{q}__lang"), F.col("source").alias(f"{q}__source"), *[F.col(c).alias(f"{q}__{c}") for c in names])
    # One row per language and source; if that is few, Spark broadcasts it by its measured size.
    joined = df.join(bounds, F.col("lang").eqNullSafe(F.col(f"{q}__lang")) & F.col("source").eqNullSafe(F.col(f"{q}__source")), "left")
    failed, beyond = _base_failed(q), F.lit(False)
    for name in RATIOS:
        beyond = beyond | _beyond(q, name)
    judged = joined.withColumn(q, F.col(q).withField("base_failed", failed).withField("kept", ~failed & ~beyond))
    return judged.select(*df.columns)


def quality_report(docs: DataFrame, shrink: int = SHRINK, fence: int = FENCE) -> DataFrame:
    """Every row's counts and verdict; the texts are read once, the counts are kept in a scratch table."""
    counts = with_features(docs.select("doc_id", "text", "lang", "source"), "quality").drop("text")
    return verdicts(written(counts, "quality-counts"), "quality", shrink, fence)


def quality_filter(docs: DataFrame, shrink: int = SHRINK, fence: int = FENCE) -> DataFrame:
    """The rows of docs that are kept, with the columns of docs."""
    q = "quality"
    while any(c == q or c.startswith(f"{q}__") for c in docs.columns):
        q += "_"
    counted = written(with_features(docs, q), "quality-docs")
    return verdicts(counted, q, shrink, fence).filter(F.col(f"{q}.kept")).select(*docs.columns)


#: The same in DuckDB's SQL, over the table documents.
QUALITY_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER () AS rid
  FROM documents),
grams AS (
  SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
f AS (
  SELECT w.rid, doc_id, lang, source, len(words) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_lines_once,
    coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (rid)),
b AS (
  SELECT *, n_lines - n_lines_once AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1000 * n_symbols // greatest(n_words, 1) AS symbols,
    1000 * (n_lines - n_lines_once) // greatest(n_lines, 1) AS dup_lines,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
    100 * word_chars // greatest(n_words, 1) AS word_length
  FROM f),
v AS (UNPIVOT (SELECT rid, lang, source, symbols, dup_lines, repeats, word_length FROM b WHERE NOT base_failed)
      ON symbols, dup_lines, repeats, word_length INTO NAME ratio VALUE value),
r AS (SELECT lang, source, ratio, (value >> k) << k AS bucket, count(*) AS n
      FROM (SELECT *, greatest(length(ltrim(bin(value), '0')) - 6, 0)::BIGINT AS k FROM v) GROUP BY ALL),
l AS (SELECT lang, ratio, bucket, sum(n) AS lent FROM r GROUP BY ALL),
u AS (
  SELECT lang, source, ratio, bucket, n AS own, 0 AS lent FROM r
  UNION ALL
  SELECT g.lang, g.source, l.ratio, l.bucket, 0, l.lent FROM (SELECT DISTINCT lang, source FROM r) AS g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang),
a AS (SELECT lang, source, ratio, bucket, sum(own)::HUGEINT AS own, sum(lent)::HUGEINT AS lent FROM u GROUP BY ALL),
h AS (SELECT *, own * sum(lent) OVER (PARTITION BY lang, source, ratio) + 50 * lent AS weight FROM a),
c AS (SELECT *, sum(weight) OVER (PARTITION BY lang, source, ratio ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(weight) OVER (PARTITION BY lang, source, ratio) AS total FROM h),
q AS (SELECT lang, source, ratio, min(bucket) FILTER (4 * upto >= total) AS q1, min(bucket) FILTER (4 * upto >= 3 * total) AS q3 FROM c GROUP BY ALL),
x AS (
  SELECT lang, source,
    max(CASE WHEN ratio = 'symbols' THEN q3 + 4 * (q3 - q1) END)::DOUBLE AS h1,
    max(CASE WHEN ratio = 'dup_lines' THEN q3 + 4 * (q3 - q1) END)::DOUBLE AS h2,
    max(CASE WHEN ratio = 'repeats' THEN q3 + 4 * (q3 - q1) END)::DOUBLE AS h3,
    max(CASE WHEN ratio = 'word_length' THEN q3 + 4 * (q3 - q1) END)::DOUBLE AS h4,
    max(CASE WHEN ratio = 'word_length' THEN greatest(q1 - 4 * (q3 - q1), 0) END)::DOUBLE AS l4
  FROM q GROUP BY ALL),
m AS (
  SELECT b.*, h1 * n_words / 1000.0::DOUBLE AS m1, h2 * n_lines / 1000.0::DOUBLE AS m2, h3 * n_words / 1000.0::DOUBLE AS m3,
    h4 * n_words / 100.0::DOUBLE AS m4, l4 * n_words / 100.0::DOUBLE AS m5
  FROM b LEFT JOIN x ON b.lang IS NOT DISTINCT FROM x.lang AND b.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(n_symbols > m1 + 4 * sqrt(m1) + 4 OR n_dup_lines > m2 + 4 * sqrt(m2) + 4 OR n_repeat_words > m3 + 4 * sqrt(20 * m3) + 80
    OR word_chars > m4 + 4 * sqrt(m4) + 4 OR word_chars < m5 - 4 * sqrt(m5) - 4, false) AS kept
FROM m
"""
