"""Operator 4: language identification of mixed-language text.

Script ranges narrow the languages a word may have; a Viterbi search over per-word scores
with a penalty for switching then labels every word, and runs of one label are the spans
of a mixed-language text.  A document's language is the one with most letters in the best
path, its score the share of letters that the path gives it, damped by the per-letter
margin over the runner-up when a single language holds the whole text.

Per-word scores are log-likelihoods of the word's letters under hashed n-gram counts
(1 to 4 letters, word ends marked), one table per language.  The counts are taken from a
bounded sample of labelled rows: `TRAIN_ROWS` rows per language are expected, chosen by a
hash of id and text; all rows count towards the sampling rate, which is 1 where a language
has fewer.  The table has 2^15 cells a language, so it does not grow with the corpus.
Every document is labelled whole.

Edge cases: `und` with score 0 for a null text or one without a letter, and for every
text if nothing could be learned; words without letters carry no label; rows without a
language, and rows without doc_id, are never learned from; ties between languages go to
the first by code point; copies and repeated ids are rows of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_BITS = 15
ORDERS = (1, 2, 3, 4)
TRAIN_ROWS = 3000
FOLDS = 5
SWITCH_PENALTY = 8.0
#: A language is a candidate in a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.002
#: The first code point of each block range, and the script it belongs to.
SCRIPT_STARTS = (0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0E00, 0x0E80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xAC00, 0xD7B0, 0x20000)
SCRIPTS = ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "other", "georgian", "hangul", "ethiopic", "latin", "greek", "other", "kana", "kana", "other", "han", "hangul", "other", "han")
SCRIPT_NAMES = tuple(dict.fromkeys(SCRIPTS))
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(s) for s in SCRIPTS])
#: Scripts written without spaces: each letter is a word.
_ALONE = np.isin(np.arange(len(SCRIPT_NAMES)), [SCRIPT_NAMES.index(s) for s in ("han", "kana", "thai")])
_STEP_CHARS = 1 << 21


def _letters() -> np.ndarray:
    table = np.zeros(0x30000, dtype=bool)
    table[[i for i in range(0x30000) if chr(i).isalpha()]] = True
    return table


_TABLES: dict[str, np.ndarray] = {}


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, starts, ends, text) of all words, maximal runs of letters, in the lower-cased texts."""
    if not _TABLES:
        _TABLES["letter"] = _letters()
    joined = "\n".join((t or "").replace("\n", " ").lower() for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    letter = np.where(points < 0x30000, _TABLES["letter"][np.minimum(points, 0x2FFFF)], False)
    alone = np.zeros(len(points), dtype=bool)
    wide = np.flatnonzero(points >= 0x0E00)
    alone[wide] = _ALONE[_script(points[wide])]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1] | alone[1:] | alone[:-1]
    last[:-1] &= ~letter[1:] | alone[1:] | alone[:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text_ends = np.flatnonzero(points == 10)
    return points, starts, ends, np.searchsorted(text_ends, starts)


def _script(points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[np.searchsorted(np.array(SCRIPT_STARTS), points, side="right") - 1]


def _grams(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: (word index, cell) of every n-gram of the words, with a mark at both ends."""
    lengths = ends - starts + 2
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    word = np.repeat(np.arange(len(starts)), lengths)
    within = np.arange(offsets[-1]) - offsets[word]
    marked = np.where((within == 0) | (within == lengths[word] - 1), 32, points[np.clip(starts[word] + within - 1, 0, max(len(points) - 1, 0))]).astype(np.uint64)
    hashed = np.zeros(len(marked), dtype=np.uint64)
    for order in ORDERS:
        back = order - 1
        # An n-gram extends the (n-1)-gram that ends one letter before.
        hashed[back:] = hashed[back - 1 : -1] * np.uint64(0x100000001B3) + marked[back:] if back else marked
        inside = within >= back
        cells = (hashed[inside] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - CELL_BITS)
        yield word[inside], cells.astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # language x cell: log-probabilities
    scripts: np.ndarray  # language x script: candidates

    def word_scores(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per word and language, the mean n-gram log-probability times the word's letters."""
        scores = np.zeros((len(starts), len(self.languages)), dtype=np.float32)
        if not len(starts):
            return scores
        total = np.zeros(len(starts), dtype=np.float32)
        for word, cells in _grams(points, starts, ends):
            cut = np.flatnonzero(np.diff(word, prepend=-1))
            if not len(cut):
                continue
            rows = word[cut]
            total[rows] += np.diff(np.append(cut, len(word)))
            for k in range(len(self.languages)):
                scores[rows, k] += np.add.reduceat(self.weights[k][cells], cut)
        scores *= ((ends - starts) / total)[:, None]
        allowed = self.scripts[:, _script(points[starts])].T
        some = allowed.any(axis=1)
        scores[~allowed & some[:, None]] = -1e6
        return scores


def best_paths(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The label of every word on its text's best path; first[i] is the first word of text i (n+1 entries).

    All texts advance together, one word a step, the longest texts first.
    """
    labels = np.zeros(len(scores), dtype=np.int16)
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    if not len(scores) or not scores.shape[1]:
        return labels
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(1, lengths[0] + 1), side="left")
    value = scores[begin[: active[0]]].copy()
    back = np.zeros(scores.shape, dtype=np.int16)  # the label before, per word and label
    own = np.arange(scores.shape[1], dtype=np.int16)
    for step in range(1, int(lengths[0])):
        n = active[step]
        value_n = value[:n]
        top = value_n.argmax(axis=1)
        switched = value_n[np.arange(n), top][:, None] - penalty
        stay = value_n >= switched
        at = begin[:n] + step
        back[at] = np.where(stay, own, top[:, None].astype(np.int16))
        value[:n] = np.where(stay, value_n, switched) + scores[at]
    # Trace back from every text's end; texts join as the step comes to their last word.
    current = value.argmax(axis=1).astype(np.int16)
    for step in range(int(lengths[0]) - 1, -1, -1):
        n = active[step]
        at = begin[:n] + step
        labels[at] = current[:n]
        current[:n] = back[at, current[:n]]
    return labels


def _slices(column: pa.Array) -> Iterator[list[str | None]]:
    held: list[str | None] = []
    size = 0
    for begin in range(0, len(column), 128):
        for text in column.slice(begin, 128).to_pylist():
            held.append(text)
            size += len(text or "")
            if size > _STEP_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def learn(rows: DataFrame) -> Model:
    """A model from all rows (text, lang) given; counts are summed per task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            at = 0
            for texts in _slices(batch.column(0)):
                points, starts, ends, text = words_of(texts)
                own = langs[at : at + len(texts)]
                at += len(texts)
                for lang in set(own.tolist()):
                    mine = np.flatnonzero((own == lang)[text]) if len(text) else np.zeros(0, np.int64)
                    c = counts.setdefault(lang, np.zeros(1 << CELL_BITS, dtype=np.int64))
                    s = scripts.setdefault(lang, np.zeros(len(SCRIPT_NAMES), dtype=np.int64))
                    if len(mine):
                        for _, cells in _grams(points, starts[mine], ends[mine]):
                            c += np.bincount(cells, minlength=len(c))
                        s += np.bincount(_script(points[starts[mine]]), weights=ends[mine] - starts[mine], minlength=len(s)).astype(np.int64)
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([c.tobytes()], pa.binary()), pa.array([scripts[lang].tobytes()], pa.binary())], ["lang", "cells", "scripts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                parts = [np.frombuffer(p, dtype=np.int64) for p in parts]
                sums[lang] = [a + b for a, b in zip(sums[lang], parts)] if lang in sums else parts
        for lang, (c, s) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([c.tobytes()], pa.binary()), pa.array([s.tobytes()], pa.binary())], ["lang", "cells", "scripts"])

    schema = "lang string, cells binary, scripts binary"
    got = rows.select("text", "lang").mapInArrow(count, schema).repartition("lang").mapInArrow(add, schema).collect()  # one row per language
    got.sort(key=lambda r: r.lang)
    counts = np.array([np.frombuffer(r.cells, dtype=np.int64) for r in got], dtype=np.float64).reshape(len(got), 1 << CELL_BITS)
    scripts = np.array([np.frombuffer(r.scripts, dtype=np.int64) for r in got], dtype=np.float64).reshape(len(got), len(SCRIPT_NAMES))
    weights = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])) if len(got) else counts
    seen = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(tuple(r.lang for r in got), weights.astype(np.float32), seen)


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS, folds: int = FOLDS) -> DataFrame:
    """A sample of the rows outside the held-out fold: `rows` are expected per language."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0))
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not sizes:
        return labelled
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows / n))])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.lit(4), "doc_id", "text"), F.lit(1 << 24)) / F.lit(float(1 << 24))
    return labelled.filter(draw < rate)


def label_texts(model: Model, texts: list[str | None], penalty: float = SWITCH_PENALTY) -> tuple[list[str], list[float], tuple]:
    """(language, score) of every text, and (starts, ends, text, label) of its words."""
    points, starts, ends, text = words_of(texts)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    n_langs = len(model.languages)
    if not n_langs:
        return ["und"] * len(texts), [0.0] * len(texts), (starts, ends, text, np.zeros(len(starts), np.int16))
    scores = model.word_scores(points, starts, ends)
    labels = best_paths(scores, first, penalty)
    letters = np.bincount(text * n_langs + labels, weights=ends - starts, minlength=len(texts) * n_langs).reshape(len(texts), n_langs)
    whole = np.stack([np.bincount(text, weights=np.maximum(scores[:, k], -50.0), minlength=len(texts)) for k in range(n_langs)], axis=1)
    total = letters.sum(axis=1)
    pick = np.lexsort((-np.arange(n_langs)[None, :].repeat(len(texts), 0), whole, letters), axis=1)[:, -1] if n_langs > 1 else np.zeros(len(texts), np.int64)
    share = letters[np.arange(len(texts)), pick] / np.maximum(total, 1)
    if n_langs > 1:
        others = np.where(np.arange(n_langs)[None, :] == pick[:, None], -np.inf, whole).max(axis=1)
        margin = whole[np.arange(len(texts)), pick] - others
        share = share / (1 + np.exp(-np.clip(margin, -30, 30)))
    names = [model.languages[p] if t else "und" for p, t in zip(pick, total)]
    return names, [float(s) if t else 0.0 for s, t in zip(share, total)], (starts, ends, text, labels)


def language_report(docs: DataFrame, rows: int = TRAIN_ROWS, folds: int = FOLDS, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, and its spans of one language each.

    spans lists (start word, end word, language) of the text's words with letters.
    """
    model = learn(training_rows(docs.select("doc_id", "text", "lang"), rows, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, spans = [], [], []
            for texts in _slices(batch.column(2)):
                lang, score, (_, _, text, labels) = label_texts(model, texts, penalty)
                names += lang
                scores += score
                cut = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
                first = np.searchsorted(text, np.arange(len(texts) + 1))
                runs: list[list[dict]] = [[] for _ in texts]
                for a, b in zip(cut.tolist(), np.append(cut[1:], len(text)).tolist()):
                    t = int(text[a])
                    runs[t].append({"start": a - int(first[t]), "end": b - int(first[t]), "lang": model.languages[labels[a]] if model.languages else "und"})
                spans += runs
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "held_out", "lang_pred", "score", "spans"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    schema = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, schema)
