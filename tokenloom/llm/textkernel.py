"""Word kernels over Arrow string batches: numpy only, chunked so memory is bounded per chunk.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; A-Z are lower-cased. Texts are
handled as UTF-8 bytes, so nothing depends on the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse mod 2**64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, CHUNK_BYTES)
        _pow = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, _BASE, dtype=np.uint64)]))
        _inv = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, _BASE_INV, dtype=np.uint64)]))
    return _pow, _inv


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    data = data[offs[0]:offs[-1]]
    return data, offs - offs[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows of about ``chunk_bytes`` text (one longer text is a slice of its own)."""
    for b in batches:
        if not b.num_rows:
            continue
        data, offs = string_buffers(b.column(b.schema.get_field_index(text)))
        lo = 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(offs, offs[lo] + chunk_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), b.num_rows)
            yield b.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text) of the words, in order; a text's end ends a word."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word's (lower-cased) bytes, worked off in slices of the buffer."""
    table = _BYTE[_LOWER] if lower else _BYTE
    out = np.empty(len(start), dtype=np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + CHUNK_BYTES, side="right")))
        base, top = int(start[lo]), int(end[hi - 1])
        power, inv = _powers(top - base + 1)
        total = np.zeros(top - base + 1, dtype=np.uint64)
        np.cumsum(table[data[base:top]] * power[:top - base], out=total[1:])
        s, e = start[lo:hi] - base, end[lo:hi] - base
        out[lo:hi] = mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lo = hi
    return out


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes, sorted, of the ``k``-word shingles of one text; a text with fewer words
    gives its whole sequence as one shingle, one without words none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    size = min(k, n)
    acc = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        acc = mix(acc * _BASE + words[j:n - size + 1 + j] + np.uint64(j + 1))
    if size < k:
        acc = mix(acc + np.uint64(size))
    return np.unique(acc)
