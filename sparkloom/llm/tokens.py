"""Whole-text tokenisation with a cache per text piece, and operator 8: exact length histograms.

Byte-level pre-tokenisation never joins a space followed by a non-blank to what stands
before it, so a text's ids are those of its pieces between such spaces, one after the
other.  Pieces repeat, so each worker process encodes a piece once and then looks it
up; a text in which a space is followed by another blank (or by its end) is encoded in
one go.  `encode` therefore returns exactly what the tokenizer returns for whole texts.

Arrow splits a slice of texts and numbers its distinct pieces, so Python sees each of them
once a slice.  New pieces go to the tokenizer joined to short texts; a piece's ids are told
from its neighbours' by the bytes that an id stands for.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pieces a worker process remembers; beyond it the cache starts anew.
CACHE_PIECES = 1_200_000
#: Characters of text encoded at a time.
SLICE_CHARS = 1 << 21
#: New pieces that the tokenizer gets as one text.
JOINED_PIECES = 64


class _Codes(dict):
    """piece -> code, asking the encoder for a code when a piece is new."""

    def __init__(self, encoder: PieceEncoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, piece: str) -> int:
        if self.lead and (not piece or piece[0].isspace()):
            code = PieceEncoder.WHOLE
        else:
            code = self.encoder.reserve(self.lead + piece)
        self[piece] = code
        return code


class PieceEncoder:
    WHOLE, END = 0, 1

    def __init__(self, path: str, end_id: int | None = None, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.id_bytes = _id_bytes(self.tokenizer)
        self.end = [] if end_id is None else [end_id]
        self.cache_pieces = cache_pieces
        self._reset()

    def _reset(self) -> None:
        self.first, self.later = _Codes(self, ""), _Codes(self, " ")
        self.pending: list[str] = []
        self.n_codes = 2
        self.flat = np.array(self.end, dtype=np.uint32)
        self.start = np.array([0, 0], dtype=np.int64)
        self.length = np.array([0, len(self.end)], dtype=np.int64)

    def reserve(self, piece: str) -> int:
        self.pending.append(piece)
        self.n_codes += 1
        return self.n_codes - 1

    def _encode_pending(self) -> None:
        if not self.pending:
            return
        new, lengths = self._joined(self.pending) or self._apart(self.pending)
        self.pending = []
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, new])
        self.start = np.concatenate([self.start, starts])
        self.length = np.concatenate([self.length, lengths])

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, ids per piece) from texts of several pieces; None if a piece does not end where an id does."""
        begins = [i for i, p in enumerate(pieces) if i % JOINED_PIECES == 0 or not p.startswith(" ")]
        texts = ["".join(pieces[a:b]) for a, b in pairwise([*begins, len(pieces)])]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), dtype=np.uint32)
        id_ends = np.concatenate([[0], np.cumsum(self.id_bytes[ids])])
        piece_ends = np.cumsum(np.fromiter((len(p.encode()) for p in pieces), dtype=np.int64, count=len(pieces)))
        upto = np.searchsorted(id_ends, piece_ends)
        if id_ends[-1] != piece_ends[-1] or (id_ends[upto] != piece_ends).any():
            return None
        return ids, np.diff(upto, prepend=0)

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32), np.fromiter(map(len, found), dtype=np.int64, count=len(found))

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids per text); every text ends with the end id, if there is one."""
        if self.n_codes > self.cache_pieces:
            self._reset()
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        pieces = split.flatten().dictionary_encode()
        where, heads = pieces.indices.to_numpy(), bounds[:-1]
        is_later = np.ones(len(where), dtype=bool)
        is_later[heads] = False
        used = np.zeros(len(pieces.dictionary), dtype=bool)
        used[where[is_later]] = True
        code_of = np.zeros(len(used), dtype=np.int64)
        code_of[used] = [self.later[p] for p in pieces.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False)]
        codes = code_of[where]
        codes[heads] = [self.first[p] for p in pieces.dictionary.take(pa.array(where[heads])).to_numpy(zero_copy_only=False)]
        codes = np.insert(codes, bounds[1:], self.END)
        self._encode_pending()
        return self._assemble(texts, codes, bounds[1:] + np.arange(1, len(texts) + 1))

    def _assemble(self, texts, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[codes]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        where = np.arange(total) + np.repeat(self.start[codes] - (upto - lengths), lengths)
        ids = self.flat[where]
        text_ends = upto[ends - 1] if len(ends) else np.zeros(0, np.int64)
        counts = np.diff(text_ends, prepend=0)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(codes == self.WHOLE), side="right"))
        if len(odd):
            parts = np.split(ids, text_ends[:-1])
            for i in odd:
                parts[i] = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids + self.end, dtype=np.uint32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, counts


def _id_bytes(tokenizer) -> np.ndarray:
    """Per id the bytes of text it stands for: a character of a byte-level token is one byte."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=np.int64)
    for token, i in vocabulary.items():
        out[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        out[i] = len(token.content.encode())
    return out


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder_for(path: str, end_id: int | None = None) -> PieceEncoder:
    """This process's encoder for a tokenizer file; its cache outlives a task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = PieceEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def text_slices(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, pa.Array]]:
    """(offset, texts) of slices of whole texts of at most `limit` characters together (one text may be longer)."""
    begin = held = 0
    for i, n in enumerate(pc.utf8_length(column).fill_null(0).to_pylist()):
        if i > begin and held + n + 1 > limit:
            yield begin, column.slice(begin, i - begin)
            begin, held = i, 0
        held += n + 1
    if begin < len(column):
        yield begin, column.slice(begin)


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(n_tokens, n_docs): how many documents encode to each length; a null text has length 0.

    Each task counts its own documents first, so the shuffle carries one row per task and
    length.  Copies, repeated ids and empty texts are documents like others; an empty table
    gives an empty histogram; columns other than text are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = encoder_for(tokenizer), Counter()
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                found.update(encoder.encode(texts)[1].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["n_tokens", "n_docs"])

    partial = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    return partial.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def length_report(histogram: DataFrame, span: int = 1024) -> DataFrame:
    """For every length L that occurs, taken as a context limit, what sums over the histogram give.

    docs_upto and tokens_upto: documents of at most L ids and their ids; docs_over and
    tokens_over: those beyond L; tokens_kept and tokens_cut: ids left and lost when every
    document is truncated to L; docs_share: the quantile rank of L.  Sums run inside spans
    of lengths and over the spans' totals, so no task sorts the whole histogram.
    """
    h = histogram.withColumn("span", F.expr(f"n_tokens div {span}")).withColumn("ids", F.col("n_tokens") * F.col("n_docs"))
    spans = h.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum("ids").alias("t"))
    every, before = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "span",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.sum("d").over(every).alias("docs"),
        F.sum("t").over(every).alias("tokens"),
    )
    inside = Window.partitionBy("span").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    r = h.withColumns({"du": F.sum("n_docs").over(inside), "tu": F.sum("ids").over(inside)}).join(spans, "span")
    docs_upto, tokens_upto = F.col("d0") + F.col("du"), F.col("t0") + F.col("tu")
    docs_over = F.col("docs") - docs_upto
    kept = tokens_upto + docs_over * F.col("n_tokens")
    return r.select(
        "n_tokens",
        "n_docs",
        docs_upto.alias("docs_upto"),
        docs_over.alias("docs_over"),
        tokens_upto.alias("tokens_upto"),
        (F.col("tokens") - tokens_upto).alias("tokens_over"),
        kept.alias("tokens_kept"),
        (F.col("tokens") - kept).alias("tokens_cut"),
        (docs_upto / F.col("docs")).alias("docs_share"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """n_docs, total and truncated ids for stated context limits, whether they occur as lengths or not."""
    sums = [F.sum(F.least("n_tokens", F.lit(x)) * F.col("n_docs")).alias(f"kept_{x}") for x in limits]
    return histogram.agg(F.sum("n_docs").alias("n_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("n_tokens"), *sums)


def length_quantile(report: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least this share of the documents do not exceed."""
    return report.filter(F.col("docs_share") >= share).agg(F.min("n_tokens").alias("n_tokens"))
