"""Token ids of texts by way of their distinct words: each word is encoded once for a table that a worker keeps.

Valid for tokenizers that drop white space, as no merge crosses it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tokenloom.llm import textkernel as tk

TABLE_WORDS = 1 << 20  # words kept at most; a fuller table starts anew, which changes no result


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class WordTable:
    """``encode``: words -> (ids of all, number of ids of each). Words are keyed by 64-bit hash of their bytes."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offset of each text's ids)."""
        start, end, first = tk.word_bounds(data, offs)
        hashes, back = np.unique(tk.word_hashes(data, start, end, lower=False), return_inverse=True)
        at = np.empty(len(hashes), np.int64)
        at[back] = np.arange(len(back))  # a place where each distinct word stands
        if len(self.hash) > TABLE_WORDS:
            self.clear()
        place = np.searchsorted(self.hash, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.hash):
            new = self.hash[np.minimum(place, len(self.hash) - 1)] != hashes
        if new.any():
            raw = data.tobytes()
            ids, size = self.encode([raw[s:e].decode("utf-8", "replace") for s, e in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
            self.start = np.insert(self.start, place[new], len(self.flat) + np.cumsum(size) - size)
            self.size = np.insert(self.size, place[new], size)
            self.hash = np.insert(self.hash, place[new], hashes[new])
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
            place = np.searchsorted(self.hash, hashes)
        word = place[back]
        size = self.size[word]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.flat[ranges(self.start[word], size)], total[first]
