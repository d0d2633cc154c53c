"""Vectorised text helpers: words, word hashes and word shingles of an Arrow
string column as flat numpy arrays.

A *word* is a maximal run of bytes other than space and 0x09-0x0D. All
separators are ASCII, so working on UTF-8 bytes gives the same words as working
on code points. Hashes are 64-bit: a polynomial over the word's bytes (taken
from one prefix sum per chunk) followed by an avalanche step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 * 1024
SHINGLE_WORDS = 5

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_SHINGLE_MULT = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=_U)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche step for 64-bit values (wraps modulo 2**64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values back to back and the n + 1 offsets; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column`` each (a
    longer value stands alone)."""
    n = batch.num_rows
    if not n:
        return
    _, off = utf8(batch.column(column))
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield batch.slice(a, b - a)
        a = b


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per value the place of its first word
    (n + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~SEPARATOR[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data``."""
    if not len(starts):
        return np.zeros(0, _U)
    if data.itemsize > 1:
        starts, ends, data = starts * data.itemsize, ends * data.itemsize, data.view(np.uint8)
    length = ends - starts
    n = (length + 7) >> 3
    off = np.concatenate([[0], np.cumsum(n)])
    place = np.arange(off[-1]) - np.repeat(off[:-1], n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.repeat(starts, n) + 8 * place
    lanes = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))[at]
    short = np.minimum(np.repeat(ends, n) - at, 8).astype(_U)
    lanes &= _U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * short)
    with np.errstate(over="ignore"):
        lanes = mix64(lanes + mix64((place.astype(_U) + _U(1)) * _GOLDEN))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(lanes, dtype=_U)])
        return mix64(total[off[1:]] - total[off[:-1]] + length.astype(_U) * _GOLDEN)


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased if asked) and the word offsets per value."""
    data = LOWER[data] if lower else data
    starts, ends, words = word_spans(data, off)
    return span_hashes(data, starts, ends), words


def shingle_hashes(hashes: np.ndarray, words: np.ndarray,
                   k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their offsets per value. A value with
    fewer than k words (and at least one) has its whole sequence as one."""
    counts = np.diff(words)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    off = np.concatenate([[0], np.cumsum(n)])
    with np.errstate(over="ignore"):
        full = max(len(hashes) - k + 1, 0)
        rolled = np.zeros(len(hashes), dtype=_U)
        mult = np.resize(_SHINGLE_MULT, k)
        for i in range(k):
            rolled[:full] += hashes[i:i + full] * (mult[i] + _U(2 * i))
        for doc in np.flatnonzero((counts > 0) & (counts < k)):
            a, b = words[doc], words[doc + 1]
            rolled[a] = (hashes[a:b] * (mult[:b - a] + _U(2) * np.arange(b - a, dtype=_U))).sum() + _U(b - a)
        place = np.repeat(words[:-1] - off[:-1], n) + np.arange(off[-1])
        return mix64(rolled[place]), off


def distinct_sorted(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values within each segment, and the new offsets."""
    values = values.copy()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    starts = off[:-1][off[:-1] < len(values)]
    keep[starts] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept[off]


def shingle_sets(column: pa.Array, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes per value of a text column."""
    return distinct_sorted(*shingle_hashes(*word_hashes(*utf8(column)), k))


def set_signatures(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A signature of 128 bits per set, as two columns (order-free sums of members, each
    mixed in its own way)."""
    out = np.empty((len(off) - 1, 2), dtype=_U)
    with np.errstate(over="ignore"):
        for i, key in enumerate((0x2545F4914F6CDD1D, 0xDA942042E4DD58B5)):
            total = np.concatenate([np.zeros(1, _U), np.cumsum(mix64((values ^ _U(key)) * _GOLDEN))])
            out[:, i] = mix64(total[off[1:]] - total[off[:-1]] + np.diff(off).astype(_U))
    return out
