"""Elias-Fano sequences in flat numpy buffers, with vectorised access and successor search."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1) if bits < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)


def _select(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each word, by halving."""
    word, rank = word.copy(), rank.astype(np.int64).copy()
    at = np.zeros(len(word), dtype=np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = word & _mask(width)
        n = np.bitwise_count(low).astype(np.int64)
        up = rank >= n
        rank -= np.where(up, n, 0)
        at += np.where(up, width, 0)
        word = np.where(up, word >> np.uint64(width), low)
    return at


class EliasFano:
    """A non-decreasing sequence of ``n`` numbers: low bits packed, high bits in unary with counts per word."""

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.l = max(0, (top // max(self.n, 1)).bit_length() - 1)  # noqa: E741
        at = np.arange(self.n, dtype=np.int64) * self.l
        self.low = np.zeros((self.n * self.l >> 6) + 2, dtype=np.uint64)
        if self.l and self.n:
            part, word, off = values & _mask(self.l), at >> 6, (at & 63).astype(np.uint64)
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            self.low[word[head]] = np.bitwise_or.reduceat(part << off, head)
            over = np.flatnonzero(off.astype(np.int64) + self.l > 64)
            self.low[word[over] + 1] |= part[over] >> (np.uint64(64) - off[over])
        place = (values >> np.uint64(self.l)).astype(np.int64) + np.arange(self.n)
        self.size = (int(place[-1]) if self.n else 0) + 2  # ends with a zero
        self.high = np.zeros((self.size >> 6) + 1, dtype=np.uint64)
        if self.n:
            word = place >> 6
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            self.high[word[head]] = np.bitwise_or.reduceat(_ONE << (place & 63).astype(np.uint64), head)
        self._count()

    def _count(self) -> None:
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def tobytes(self) -> bytes:
        return np.array([self.n, self.l, self.size, len(self.low), len(self.high)], dtype="<i8").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def open(cls, buffer, offset: int = 0) -> tuple[EliasFano, int]:
        """Opens a sequence in place, and the offset behind it; only the word counts are built."""
        self = cls.__new__(cls)
        self.n, self.l, self.size, low, high = np.frombuffer(buffer, "<i8", 5, offset).tolist()
        offset += 40
        self.low = np.frombuffer(buffer, np.uint64, low, offset)
        self.high = np.frombuffer(buffer, np.uint64, high, offset + 8 * low)
        self._count()
        return self, offset + 8 * (low + high)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.l
        word, off = at >> 6, (at & 63).astype(np.uint64)
        out = self.low[word] >> off
        high = self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63))
        return (out | np.where(off > 0, high, np.uint64(0))) & _mask(self.l)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _select(self.high[word], i - self.ones[word])
        return (place - i).astype(np.uint64) << np.uint64(self.l) | self._low(i)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place in the unary part of the zero number ``k`` (from 0)."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return word * 64 + _select(~self.high[word], k - self.zeros[word])

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number that is not less than each ``x``; n if there is none."""
        x = x.astype(np.uint64)
        out = np.full(len(x), self.n, dtype=np.int64)
        h = (x >> np.uint64(self.l)).astype(np.int64)
        ok = np.flatnonzero(h < self.size - self.n)  # zeros there are: one for each high part
        h, low = h[ok], x[ok] & _mask(self.l)
        lo = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) - h + 1, 0)
        hi = self._zero(h) - h
        while len(live := np.flatnonzero(lo < hi)):  # the numbers with this high part
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < low[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
        out[ok] = lo
        return out
