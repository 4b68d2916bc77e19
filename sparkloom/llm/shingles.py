"""Vectorised word shingling of whole texts, shared by the set-similarity operators.

A batch of texts is laid out as one byte array.  Words are the maximal runs of
bytes other than 0x20 and 0x09-0x0D (all ASCII, so working on UTF-8 bytes is the
same as working on code points).  Every word gets a 64-bit polynomial hash over a
random byte table, read off one running sum per batch; a shingle's hash chains its
words' hashes through a finaliser.  Cost is a fixed number of passes over the bytes
whatever the number or length of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * U64(2) + U64(1)
# A-Z hash like a-z: the lower-casing of the shingle contract costs nothing here.
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        k = min(filled, n - filled)
        out[filled : filled + k] = out[:k] * U64(pow(base, filled, 2**64))
        filled += k
    return out


_POWER_CACHE: dict[str, np.ndarray] = {"up": _powers(_BASE, _STEP), "down": _powers(_BASE_INVERSE, _STEP)}


def _power_table(kind: str, n: int) -> np.ndarray:
    table = _POWER_CACHE[kind]
    if len(table) < n:
        table = _powers(_BASE if kind == "up" else _BASE_INVERSE, 1 << (n - 1).bit_length())
        if len(table) <= 1 << 24:
            _POWER_CACHE[kind] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit lanes (xor-shift-multiply rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch and, per text, the index of its first word (n+1 entries)."""
    n_texts = len(offsets) - 1
    if len(raw) == 0:
        return np.zeros(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(raw))]
    first[cut] = inside[cut]  # a text's start also starts a word
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    ends = np.flatnonzero(last) + 1
    table = _BYTE_FOLDED if fold_case else _BYTE
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(table[raw] * _power_table("up", len(raw)), out=total[1:])
    values = (total[ends] - total[starts]) * _power_table("down", len(raw))[starts]
    values = mix(values + (ends - starts).astype(np.uint64) * U64(0xA24BAED4963EE407))
    return values, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, begin: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, with n+1 offsets.

    A text with fewer than k words (but one at least) has its whole sequence as its
    only shingle; a text without words has none.
    """
    counts = np.diff(begin)
    n_out = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n_out)])
    out = np.empty(offsets[-1], dtype=np.uint64)
    if not len(words):
        return out, offsets
    if len(words) >= k:
        full = mix(words[: len(words) - k + 1] + U64(k))
        for j in range(1, k):
            full = mix(full * U64(0x9FB21C651E98DF25) + words[j : len(words) - k + 1 + j])
    else:
        full = np.zeros(0, np.uint64)
    long = np.flatnonzero(counts >= k)
    text_of = np.repeat(np.arange(len(counts)), n_out)
    within = np.arange(offsets[-1]) - offsets[:-1][text_of]
    is_long = (counts >= k)[text_of]
    if len(long):
        out[is_long] = full[(begin[:-1][text_of] + within)[is_long]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        h = mix(words[begin[i] : begin[i] + 1] + U64(int(counts[i])))
        for j in range(1, counts[i]):
            h = mix(h * U64(0x9FB21C651E98DF25) + words[begin[i] + j])
        out[offsets[i]] = h[0]
    return out, offsets


def distinct_per_text(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, with n+1 offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    kept = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.concatenate(parts) if parts else values[:0], kept


def shingle_sets(column: pa.Array, k: int, step_bytes: int = 1 << 20):
    """(first row, values, offsets) for slices of a text column: the sorted distinct k-word shingles of every text."""
    n, begin = len(column), 0
    lengths = pa.compute.binary_length(column.cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) if n else np.zeros(0, np.int64)
    upto = np.cumsum(lengths)
    while begin < n:
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + step_bytes, side="right")))
        words, first = word_hashes(*text_buffers(column.slice(begin, end - begin)))
        yield begin, *distinct_per_text(*shingles(words, first, k))
        begin = end
