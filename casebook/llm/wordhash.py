"""Words, word hashes and word shingles of whole texts, vectorised over a slice of an Arrow string column.

A word is a run of bytes that are not ASCII white space; A-Z are lower-cased. A word's hash is a polynomial of random
64-bit numbers of its bytes (mod 2^64), computed from one running sum for all words; shingle hashes combine the hashes of
consecutive words. Two different shingles share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from casebook.llm._common import by_value

by_value(__name__)

SLICE_BYTES = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_CASED = _BYTE.copy()
_CASED[65:91] = np.random.default_rng(5).integers(1, 1 << 64, 26, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_JOIN = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _POWERS or len(_POWERS[name]) < n:
        out = np.full(max(n, SLICE_BYTES), base, np.uint64)
        out[0] = 1
        _POWERS[name] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[name]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes (a fixed one-to-one map)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def lower_table() -> np.ndarray:
    return _BYTE


def case_table() -> np.ndarray:
    return _CASED


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hash of the bytes of each [start, end): one running sum for all."""
    n = len(data)
    running = np.empty(n + 1, np.uint64)
    running[0] = 0
    np.cumsum(table[data] * _powers("step", _STEP, n + 1)[:n], dtype=np.uint64, out=running[1:])
    return mix((running[ends] - running[starts]) * _powers("back", _BACK, n + 1)[starts])


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets): rows first..last of a string column, nulls as empty; a row is never split."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, len(column))
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


class Words:
    """Words of a slice: ``starts``/``ends`` (bytes), ``docs`` (first word of each text, one more at the end), ``hashes``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        word = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = word[:-1]
        after = np.empty(n, bool)
        if n:
            after[-1] = False
            after[:-1] = word[1:]
        self.starts = np.flatnonzero(word & (~before | edge[:n]))
        self.ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.docs = np.searchsorted(self.starts, offsets)
        self.hashes = span_hashes(data, self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.docs)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; run k starts at word k, whatever text it belongs to."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _JOIN + hashes[k:k + n]
    return mix(out)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, texts): the shingles of every text in order, repeats included.

    A text with fewer words has its whole sequence as its only shingle; one without words has none.
    """
    counts = words.counts
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), per)
    at = np.repeat(words.docs[:-1], per) + (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per))
    out = np.zeros(len(text), np.uint64)
    runs = window_hashes(words.hashes, size)
    full = counts[text] >= size
    out[full] = runs[at[full]]
    for k in range(1, size):  # short texts: whole sequences of k words
        short = counts[text] == k
        if short.any():
            out[short] = window_hashes(words.hashes, k)[at[short]]
    return out, text
