"""Operator 2: personal data by candidate gradient boosting.

Native: built-in functions only.  Four base patterns (email, ip, card, phone) find what
is certain.  High-recall generators propose further spans, which may overlap each other:
written-out and spaced e-mail addresses, IPv6 addresses, cards with other separators,
phone numbers without a plus.  Boosted trees score each proposal by its format (digits,
groups, separators, check digit) and its context (neighbouring characters, words before
it); a threshold per kind, calibrated for precision on labelled examples the trees were
not fitted to, selects spans.  Selected proposals that overlap a base span, or a selected
proposal that starts before them, are dropped.

The trees are fitted on `EXAMPLES` labelled spans per kind, written by a seeded generator
in this module; neither their number nor the fit depends on the corpus.

Positions are code points.  Matches and the text between them come from two passes of the
same pattern (regexp_extract_all and split), positions from running sums of their lengths.
Sums and maxima run over blocks of `BLOCK` matches and over the blocks, overlaps are found
by one sweep in order of position, and a text is cut in pieces of `PIECE` characters for
its contexts, so a text with many thousands of matches takes hardly more than linear time.

Edge cases: a null or empty text has no spans; copies and repeated ids are rows of their
own; patterns use possessive groups and anchored starts, so long runs of digits or letters
neither overflow the stack nor take quadratic time; an empty table gives an empty result;
other columns are carried along.
"""

from __future__ import annotations

import random
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import text_or_empty

KINDS = ("email", "ip", "card", "phone")
EXAMPLES = 600
BLOCK, PIECE = 64, 2048
_LOCAL = "[A-Za-z0-9._%+-]"
#: kind: (cheap test that a text may match, pattern).  The patterns find the same leftmost
#: non-overlapping matches as the plain ones; runs are entered at their start only.
BASE = {
    "email": (r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){15}", r"[0-9](?:[\x20-]?[0-9]){15,}+"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
PROPOSED = {
    "email": (
        r"(?i)(?:\(at\)|\[at\]|\x20at\x20[a-z0-9-]{1,63}\x20dot\x20|[\w]\x20@\x20\w)",
        r"(?i)(?<![\w.+-])[a-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\bat\b|@)\x20?[a-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\]|\bdot\b)\x20?[a-z]{2,10}+){1,3}",
    ),
    "ip": (r"[0-9a-fA-F]:[0-9a-fA-F]{0,4}:", r"(?<![0-9a-fA-F:.])(?:[0-9a-fA-F]{1,4}:){2,7}:?(?:[0-9a-fA-F]{1,4}:?){1,7}(?![0-9a-fA-F:.])"),
    "card": (r"[0-9][./_\x20-]{1,2}[0-9]{4}|[0-9]{13}", r"(?<![0-9.+])[0-9]{3,6}(?:[./_\x20-]{0,2}[0-9]{2,6}){2,5}(?![0-9])"),
    "phone": (r"[0-9][)./\x20-]", r"(?<![0-9.+\w])(?:00[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?(?:[\x20./-]{1,2}[0-9]{2,4}){2,4}(?![0-9])"),
}
CONTEXT = {
    "email": r"(?i)mail|contact|write|@|courriel|correo|kontakt",
    "ip": r"(?i)\bip\b|host|address|server|addr|client",
    "card": r"(?i)card|visa|master|amex|karte|carte|tarjeta|credit|pay",
    "phone": r"(?i)phone|tel|call|fax|mobil|handy|cell|tél|móvil",
}
FEATURES = ("chars", "digits", "marks", "checks", "kinds_of_digit", "letters", "said", "joined_left", "joined_right", "groups", "longest", "dots", "domain", "colons", "written")


def _luhn(digits: str) -> str:
    """Whether a string of digits passes the Luhn check."""
    return f"""(length({digits}) > 0 AND aggregate(sequence(1, greatest(length({digits}), 1)), 0, (total, i) -> total +
        CASE WHEN i % 2 = 1 THEN ascii(substring({digits}, -i, 1)) - 48
             WHEN ascii(substring({digits}, -i, 1)) >= 53 THEN 2 * (ascii(substring({digits}, -i, 1)) - 48) - 9
             ELSE 2 * (ascii(substring({digits}, -i, 1)) - 48) END) % 10 = 0)"""


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _running(df: DataFrame, name: str, values: str, zero: str, step: str) -> tuple[DataFrame, str]:
    """df with helper columns, and the SQL of the aggregate of all elements of the array `values` before index k.

    `step` folds x into a.  Every helper is named twice where it is used: the optimizer may not
    move what is named once into a lambda, where it would be computed for each element.
    """
    blocks, heads = f"{name}_blocks", f"{name}_heads"
    fold = f"{zero}, (a, x) -> {step}"
    df = df.withColumn(blocks, F.expr(f"transform(sequence(0, (size({values}) - 1) div {BLOCK}), b -> aggregate(slice({values}, cast(b * {BLOCK} + 1 AS int), {BLOCK}), {fold}))"))
    df = df.withColumn(heads, F.expr(f"transform({blocks}, (y, b) -> aggregate(slice({blocks}, 1, least(b, size({blocks}))), {fold}))"))
    upto = f"aggregate(slice({values}, cast(k div {BLOCK} * {BLOCK} + 1 AS int), k % {BLOCK}), get({heads}, cast(k div {BLOCK} AS int)), (a, x) -> {step})"
    return df, f"CASE WHEN size({heads}) = 0 THEN {zero} ELSE {upto} END"


def _matches(df: DataFrame, name: str, kind: str, test: str, pattern: str) -> DataFrame:
    """df with the column `name`: all matches in __pii_text as (kind, s, e, m)."""
    p, gaps, found, steps = _quoted(pattern), f"{name}_gaps", f"{name}_found", f"{name}_steps"
    here = f"__pii_text RLIKE {_quoted(test)}"
    df = df.withColumns(
        {
            gaps: F.expr(f"CASE WHEN {here} THEN split(__pii_text, {p}, -1) ELSE cast(array() AS array<string>) END"),
            found: F.expr(f"CASE WHEN {here} THEN regexp_extract_all(__pii_text, {p}, 0) ELSE cast(array() AS array<string>) END"),
        }
    )
    df = df.withColumn(steps, F.expr(f"CASE WHEN size({gaps}) = 0 OR size({found}) = 0 THEN cast(array() AS array<int>) ELSE transform({found}, (m, k) -> length(m) + length(get({gaps}, k))) END"))
    df, before = _running(df, name, steps, "0", "a + x")
    spans = f"transform({found}, (m, k) -> struct({KINDS.index(kind)} AS kind, {before} + length(get({gaps}, k)) AS s, m AS m))"
    df = df.withColumn(name, F.expr(f"CASE WHEN size({found}) = 0 OR size({gaps}) = 0 THEN NULL ELSE {spans} END"))
    return df.drop(gaps, found, steps, f"{name}_blocks", f"{name}_heads")


def _valid(kind: str) -> str:
    digits = "regexp_replace(x.m, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": "forall(split(x.m, '[.]'), d -> length(ltrim('0', d)) <= 3 AND cast(concat('0', right(ltrim('0', d), 3)) AS int) <= 255)",
        "card": f"length({digits}) BETWEEN 16 AND 19 AND {_luhn(digits)}",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
    }[kind]


def _cut(a: str, b: str) -> str:
    """The characters a to b (exclusive) of a text that lies in __pii_pieces."""
    i, j = f"cast(({a}) div {PIECE} AS int)", f"cast(({b}) div {PIECE} AS int)"
    head, tail = f"substring(get(__pii_pieces, {i}), cast(({a}) % {PIECE} + 1 AS int)", f"substring(coalesce(get(__pii_pieces, {j}), ''), 1, cast(({b}) % {PIECE} AS int))"
    between = f"array_join(slice(__pii_pieces, {i} + 2, {j} - {i} - 1), '')"
    return f"CASE WHEN {b} <= {a} THEN '' WHEN {i} = {j} THEN {head}, cast({b} - ({a}) AS int)) ELSE concat({head}), {between}, {tail}) END"


def _with_pieces(df: DataFrame) -> DataFrame:
    pieces = f"transform(sequence(0, length(__pii_text) div {PIECE}), i -> substring(__pii_text, cast(i * {PIECE} + 1 AS int), {PIECE}))"
    return df.withColumn("__pii_pieces", F.expr(pieces))


def _features(kind: str, x: str) -> str:
    """A struct of FEATURES for span x (kind, s, m) of the text in __pii_pieces."""
    digits = f"regexp_replace({x}.m, '[^0-9]', '')"
    groups = f"regexp_extract_all({x}.m, '([0-9]+)', 1)"
    before, after = _cut(f"greatest({x}.s - 32, 0)", f"{x}.s"), _cut(f"{x}.s + length({x}.m)", f"{x}.s + length({x}.m) + 1")
    values = {
        "chars": f"length({x}.m)",
        "digits": f"length({digits})",
        "marks": rf"length(regexp_replace({x}.m, r'[\w]', ''))",
        "checks": f"CASE WHEN {_luhn(digits)} THEN 1 ELSE 0 END",
        "kinds_of_digit": f"size(array_distinct(split({digits}, '')))",
        "letters": f"length(regexp_replace({x}.m, '[^A-Za-z]', ''))",
        "said": f"CASE WHEN {before} RLIKE {_quoted(CONTEXT[kind])} THEN 1 ELSE 0 END",
        "joined_left": rf"CASE WHEN right({before}, 1) RLIKE r'[\w#$/:=]' THEN 1 ELSE 0 END",
        "joined_right": rf"CASE WHEN {after} RLIKE r'[\w$%/:=]' THEN 1 ELSE 0 END",
        "groups": f"size({groups})",
        "longest": f"coalesce(array_max(transform({groups}, g -> length(g))), 0)",
        "dots": rf"length({x}.m) - length(replace({x}.m, '.', ''))",
        "domain": rf"CASE WHEN {x}.m RLIKE r'(?i)[.\x20\])](com|org|net|edu|info|io|de|fr|es|uk|eu)$' THEN 1 ELSE 0 END",
        "colons": f"length({x}.m) - length(replace({x}.m, ':', ''))",
        "written": rf"CASE WHEN {x}.m RLIKE r'(?i)[(\[](at|dot)[)\]]|\x20dot\x20' THEN 1 ELSE 0 END",
    }
    return "named_struct(" + ", ".join(f"'{n}', cast({values[n]} AS double)" for n in FEATURES) + ")"


def labelled_examples(n: int = EXAMPLES, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(kind, text before, span, label): n proposals per kind, half of them personal data."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("an", "er", "ti", "on", "the", "in", "re", "le", "ou", "st")) for _ in range(r.randint(1, 4)))
    say = {"email": ("mail ", "contact: ", "write to "), "ip": ("host ", "ip ", "server at "), "card": ("card ", "visa ", "credit card: "), "phone": ("phone ", "tel. ", "call ")}
    out = []

    def luhn(k: int) -> str:
        body = digits(k - 1)
        total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(body[::-1]))
        return body + str(-total % 10)

    def grouped(s: str, sep: str) -> str:
        return sep.join(s[i : i + 4] for i in range(0, len(s), 4))

    for i in range(n):
        yes = (i // 2) % 2 == 0  # pairs, so that even and odd rows hold both labels
        for kind in KINDS:
            before = f"{word()} " + (r.choice(say[kind]) if r.random() < (0.6 if yes else 0.1) else "")
            if kind == "email":
                at, dot = r.choice(((" (at) ", "."), ("(at)", "."), ("[at]", "."), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", ".")))
                tld = r.choice(("com", "org", "net", "de", "fr", "es"))
                tail = str(r.randint(0, 99)) if r.random() < 0.4 else ""
                if yes:
                    span = f"{word()}{r.choice(('.', '', '_'))}{word()}{tail}{at}{word()}{dot}{tld}"
                else:
                    span = r.choice((f"{word()}{tail} at {word()}. {word()}", f"{word()}{tail} at {word()}.{word()}", f"{word()} @ {word()}. {word()}"))
            elif kind == "ip":
                span = ":".join(f"{r.randrange(1 << r.choice((1, 4, 16, 16))):x}" for _ in range(8)) if yes else r.choice((f"{r.randint(0, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", f"{r.randint(1, 9)}:{r.randint(1, 9)}:{r.randint(1, 99)}", ":".join(digits(2) for _ in range(r.randint(3, 6)))))
            elif kind == "card":
                sep = r.choice((".", "/", "_", "  ", " ", "-"))
                if yes:
                    span = grouped(luhn(16), sep)
                else:
                    span = r.choice((grouped(digits(15) + str((int(luhn(16)[-1]) + 1) % 10), sep), f"{digits(4)}{sep}{digits(2)}{sep}{digits(2)}", digits(r.randint(13, 19)), f"{digits(3)}{sep}{digits(3)}{sep}{digits(3)}"))
            else:
                a, b, c = r.randint(201, 989), r.randint(200, 999), digits(4)
                if yes:
                    span = r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"0049 {a} {b}-{c}"))
                else:
                    span = r.choice((f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{digits(2)} {digits(3)} {digits(2)}", f"{digits(4)}.{digits(2)}.{digits(2)}", f"{digits(2)}/{digits(2)}/{digits(4)}", grouped(digits(16), r.choice(" .-/")), grouped(luhn(16), r.choice(" .-/")), f"{digits(3)} {digits(4)} {digits(4)} {digits(3)}", f"{digits(3)}.{digits(3)}.{digits(3)}"))
                    before = f"{word()} "
            out.append((kind, before, span, int(yes)))
    return out


@cache
def _models(application: str, examples: int) -> dict[str, boosting.Model]:
    spark = SparkSession.getActiveSession()
    rows = [(i, k, b + s + " and", len(b), s, y) for i, (k, b, s, y) in enumerate(labelled_examples(examples))]
    df = spark.createDataFrame(rows, "i int, kind string, __pii_text string, s int, m string, y int").withColumn("x", F.struct("s", "m"))
    df = _with_pieces(df)
    out = {}
    for kind in KINDS:
        got = df.filter(F.col("kind") == kind).select("i", "y", F.expr(_features(kind, "x")).alias("f")).orderBy("i").collect()
        # Neighbours in i alternate between fitting and calibration; both hold both labels.
        x, y = np.array([list(r.f) for r in got]), np.array([r.y for r in got], dtype=float)
        out[kind] = boosting.fit(x, y)
    return out


def models(spark: SparkSession, examples: int = EXAMPLES) -> dict[str, boosting.Model]:
    """The fitted trees per kind; one small fit per application."""
    return _models(spark.sparkContext.applicationId, examples)


def with_spans(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """docs with __pii_text, __pii_base and __pii_spans: arrays of (kind, s, e), by kind, then start; __pii_scored: every proposal as (kind, s, e, score)."""
    trees = models(docs.sparkSession, examples)
    df = docs.withColumn("__pii_text", text_or_empty())
    base, scored = [], []
    for kind, (test, pattern) in BASE.items():
        df = _matches(df, f"__pii_b_{kind}", kind, test, pattern)
        base.append(f"transform(filter(coalesce(__pii_b_{kind}, array()), x -> {_valid(kind)}), x -> struct(x.kind AS kind, x.s AS s, x.s + length(x.m) AS e))")
    df = df.withColumn("__pii_base", F.expr(f"concat({', '.join(base)})")).drop(*[f"__pii_b_{k}" for k in KINDS])
    for kind, (test, pattern) in PROPOSED.items():
        df = _matches(df, f"__pii_p_{kind}", kind, test, pattern)
    df = _with_pieces(df)
    for kind in PROPOSED:
        score = trees[kind].sql([f"f.{n}" for n in FEATURES])
        named = f"get(transform(array({_features(kind, 'x')}), f -> struct(x.kind AS kind, x.s AS s, x.s + length(x.m) AS e, {score} AS score)), 0)"
        scored.append(f"CASE WHEN __pii_p_{kind} IS NULL OR size(__pii_pieces) = 0 THEN array() ELSE transform(__pii_p_{kind}, x -> {named}) END")
    df = df.withColumn("__pii_scored", F.expr(f"concat({', '.join(scored)})")).drop("__pii_pieces", *[f"__pii_p_{k}" for k in KINDS])
    enough = " OR ".join(f"(x.kind = {i} AND x.score >= {trees[k].threshold!r}D)" for i, k in enumerate(KINDS))
    # Base spans and selected proposals in order of position, a base span first where they tie.
    df = df.withColumn("__pii_more", F.expr(f"filter(__pii_scored, x -> {enough})"))
    df = df.withColumn(
        "__pii_all",
        F.expr("""CASE WHEN size(__pii_more) = 0 THEN cast(array() AS array<struct<s: int, more: int, e: int, kind: int>>) ELSE sort_array(concat(
            transform(__pii_base, x -> struct(x.s AS s, 0 AS more, x.e AS e, x.kind AS kind)), transform(__pii_more, x -> struct(x.s AS s, 1 AS more, x.e AS e, x.kind AS kind)))) END"""),
    )
    df = df.withColumns({"__pii_ends": F.expr("transform(__pii_all, x -> x.e)"), "__pii_starts": F.expr("reverse(transform(__pii_all, x -> CASE WHEN x.more = 0 THEN x.s ELSE 2147483647 END))")})
    df, ended = _running(df, "__pii_ended", "__pii_ends", "0", "greatest(a, x)")
    df, next_base = _running(df, "__pii_next", "__pii_starts", "2147483647", "least(a, x)")
    df = df.withColumn("__pii_bounds", F.expr(f"transform(__pii_all, (y, k) -> struct({ended} AS ended, {next_base} AS after))"))
    clear = """transform(filter(__pii_all, (x, k) -> x.more = 1 AND get(__pii_bounds, k).ended <= x.s AND get(__pii_bounds, size(__pii_bounds) - 1 - k).after >= x.e),
        x -> struct(x.kind AS kind, x.s AS s, x.e AS e))"""
    df = df.withColumn("__pii_spans", F.expr(f"CASE WHEN size(__pii_bounds) = 0 THEN __pii_base ELSE sort_array(concat(__pii_base, {clear})) END"))
    return df.drop("__pii_more", "__pii_all", "__pii_ends", "__pii_starts", "__pii_bounds", *[f"__pii_{n}_{x}" for n in ("ended", "next") for x in ("blocks", "heads")])


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', get(array({names}), x.kind), x.s, x.e)), ',')"


def span_report(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, base counts per kind, base_sha256 and all spans of every document, the number of proposals and the best one's probability."""
    df = with_spans(docs.select("doc_id", "text"), examples)
    counts = [F.expr(f"cast(size(filter(__pii_base, x -> x.kind = {i})) AS long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    proposed = [F.size("__pii_scored").cast("long").alias("n_proposed"), F.round(F.expr("array_max(transform(__pii_scored, x -> x.score))"), 6).alias("best_score")]
    return df.select("doc_id", *counts, F.sha2(F.expr(_listed("__pii_base")), 256).alias("base_sha256"), F.expr(_listed("__pii_spans")).alias("spans"), *proposed)


def redacted(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """docs with every span of text replaced by its kind in brackets; a null text stays null."""
    names = ", ".join(f"'[{k}]'" for k in KINDS)
    df = _with_pieces(with_spans(docs, examples))
    df = df.withColumn("__pii_order", F.expr("array_sort(__pii_spans, (a, b) -> CASE WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 ELSE b.e - a.e END)"))
    df = df.withColumn("__pii_ends", F.expr("transform(__pii_order, x -> x.e)"))
    df, ended = _running(df, "__pii_ended", "__pii_ends", "0", "greatest(a, x)")
    df = df.withColumn("__pii_upto", F.expr(f"transform(__pii_order, (y, k) -> {ended})"))
    # A span that starts inside an earlier one is part of it.
    parts = f"transform(__pii_order, (y, k) -> CASE WHEN y.s < get(__pii_upto, k) THEN '' ELSE concat({_cut('get(__pii_upto, k)', 'y.s')}, get(array({names}), y.kind)) END)"
    rest = _cut("array_max(__pii_ends)", "length(__pii_text)")
    text = F.expr(f"CASE WHEN text IS NULL OR size(__pii_order) = 0 OR size(__pii_upto) = 0 OR size(__pii_pieces) = 0 THEN text ELSE concat(array_join({parts}, ''), {rest}) END")
    return df.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])
