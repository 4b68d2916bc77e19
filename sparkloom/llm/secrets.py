"""Operator 6: secret scans by grammar inference.

Three base patterns (assign, access, hex) find what is certain.  Beyond them, every run of
16 or more token characters is a candidate and is scored by probabilistic automata: one
per credential format, inferred from labelled credentials by merging statistically
compatible prefix-tree states, and one inferred from ordinary tokens.  A candidate is a
secret when some format's likelihood exceeds the ordinary one by a margin per character,
calibrated on labelled examples that the automata were not inferred from.

The labelled examples are `EXAMPLES` strings per format, written by a seeded generator in
this module; neither their number nor the automata depend on the corpus.

Every candidate is scored; one that overlaps a base span adds none.  Positions are code
points.  One pass over a text finds the candidates; texts without any are done, since access
keys and hex strings are candidates, too.  Overlaps are found by bisection.

Edge cases: a null or empty text has no spans; texts are scanned whole, whatever their
length, a candidate's score costs time in proportion to its length; copies and repeated ids
are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .automata import Automaton, infer

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
EXAMPLES = 120
#: Characters at the start of a token that the automata see as they are; later ones by class.
RAW = 4

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


_CLASS = {c: "d" if c in _DIGITS else "u" if c in _UPPER else "x" if c in "abcdef" else "l" for c in _UPPER + _LOWER + _DIGITS}
_CLASS_SIZE = {"d": 10, "u": 26, "x": 6, "l": 20}


def symbols(token: str) -> list[str]:
    """What a format's automaton reads."""
    return [*token[:RAW], *(_CLASS.get(c, c) for c in token[RAW:])]


def classes(token: str) -> list[str]:
    """What the automaton of ordinary tokens reads: classes throughout."""
    return [_CLASS.get(c, c) for c in token]


def labelled_tokens(n: int = EXAMPLES, seed: int = 7) -> dict[str, list[str]]:
    """Tokens by format; the format `plain` holds ordinary ones."""
    r = random.Random(seed)
    any_of = lambda letters, k: "".join(r.choice(letters) for _ in range(k))
    mixed = _UPPER + _LOWER + _DIGITS
    syllables = ("an", "er", "ti", "on", "the", "in", "re", "le", "ou", "st", "sch", "keit", "ment", "ción", "ung", "eau")
    word = lambda k: "".join(r.choice(syllables) for _ in range(k)).encode("ascii", "ignore").decode()
    plain = (
        lambda: word(r.randint(5, 14)),
        lambda: word(r.randint(5, 14)).capitalize(),
        lambda: word(r.randint(5, 9)).upper(),
        lambda: "_".join(word(r.randint(1, 3)) for _ in range(r.randint(4, 6))),
        lambda: "-".join(word(r.randint(1, 3)) for _ in range(r.randint(4, 6))),
        lambda: "/".join(word(r.randint(1, 3)) for _ in range(r.randint(4, 6))),
        lambda: any_of(_DIGITS, r.randint(16, 20)),
        lambda: "-".join(any_of(_DIGITS, 4) for _ in range(4)),
        lambda: "-" * r.randint(16, 80),
        lambda: "_" * r.randint(16, 80),
        lambda: "=" * r.randint(16, 80),
        lambda: "+" * r.randint(16, 80),
        lambda: "".join(word(r.randint(1, 3)).capitalize() for _ in range(r.randint(4, 6))),
    )
    made = {
        "access": lambda: r.choice(("ASIA", "AKIA", "AROA")) + any_of(_UPPER + _DIGITS, 16),
        "hex": lambda: any_of(_DIGITS + "ABCDEF", r.choice((32, 40, 64))),
        "forge": lambda: r.choice(("ghp_", "gho_", "ghs_")) + any_of(mixed, 36),
        "chat": lambda: f"xox{r.choice('bap')}-{any_of(_DIGITS, 12)}-{any_of(mixed, 24)}",
        "payment": lambda: f"{r.choice(('sk', 'rk'))}_{r.choice(('live', 'test'))}_{any_of(mixed, 24)}",
        "bearer": lambda: "eyJ" + any_of(mixed + "-_", r.randint(60, 120)),
        "key40": lambda: any_of(mixed + "+/", 40),
    }
    out = {name: [f() for _ in range(n)] for name, f in made.items()}
    out["plain"] = [t for i in range(8 * n) if len(t := plain[i % len(plain)]()) >= 16]
    return out


#: The listed kind under which a format's spans are reported.
FORMAT_KIND = {"access": "access", "hex": "hex", "forge": "access", "chat": "access", "payment": "access", "bearer": "access", "key40": "access"}


class Scorer:
    def __init__(self, formats: dict[str, Automaton], plain: Automaton, margin: float):
        self.formats, self.plain, self.margin = formats, plain, margin

    def best(self, token: str) -> tuple[float, str]:
        """The largest log-likelihood ratio per character, and its format."""
        s, c = symbols(token), classes(token)
        # The first characters count as they are on both sides: each is one of its class.
        plain = self.plain.log_likelihood(c) - sum(math.log(_CLASS_SIZE.get(x, 1)) for x in c[:RAW])
        return max(((a.log_likelihood(s) - plain) / len(s), name) for name, a in self.formats.items())


@cache
def scorer(examples: int = EXAMPLES) -> Scorer:
    """Infer the automata from half of the labelled tokens, calibrate the margin on the others."""
    tokens = labelled_tokens(examples)
    plain = infer([classes(t) for t in tokens["plain"][::2]])
    automata = {name: infer([symbols(t) for t in found[::2]]) for name, found in tokens.items() if name != "plain"}
    s = Scorer(automata, plain, 0.0)
    ordinary = sorted(s.best(t)[0] for t in tokens["plain"][1::2])
    # One ordinary token in a hundred may reach the margin on the calibration half.
    return Scorer(automata, plain, max(0.2, ordinary[len(ordinary) * 99 // 100]))


Span = tuple[int, int, str]


def find_spans(text: str | None, s: Scorer) -> tuple[list[Span], list[Span], list[float]]:
    """(base spans, all spans) as (start, end, kind), by start, then kind as listed, and the score of every candidate."""
    if not text:
        return [], [], []
    base: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        base += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    candidates = [m.span() for m in CANDIDATE.finditer(text)]
    if candidates:
        if "AKIA" in text:
            base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    starts, ends = [x[0] for x in base], list(accumulate((x[1] for x in base), max))
    more, scores = [], []
    for a, b in candidates:
        ratio, name = s.best(text[a:b])
        scores.append(ratio)
        before = bisect_left(starts, b)  # base spans that start before the candidate ends
        if ratio >= s.margin and not (before and ends[before - 1] > a):
            more.append((a, b, FORMAT_KIND[name]))
    return base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2]))) if more else base, scores


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def secret_report(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, base counts per kind, base_sha256 and all spans of every document, the number of candidates and the best one's score."""
    model = scorer(examples)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_candidates", "best_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for begin in range(0, batch.num_rows, 256):
                for text in batch.column(1).slice(begin, 256).to_pylist():
                    base, spans, scores = find_spans(text, model)
                    kinds = Counter(k for _, _, k in base)
                    row = (*[kinds[k] for k in KINDS], hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans), len(scores), round(max(scores), 6) if scores else None)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds_of = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds_of)]], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_candidates long, best_score double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def masked(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """docs with every found span of text replaced by its kind in brackets; a null text stays null."""
    model, at = scorer(examples), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                parts, upto = [], 0
                for a, b, kind in find_spans(text, model)[1]:
                    if a >= upto:
                        parts += [text[upto:a], f"[{kind}]"]
                    upto = max(upto, b)
                texts.append(text if text is None else "".join(parts) + text[upto:])
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
