"""Operator 9, byte-pair encoding and decoding by batched numpy merge rounds.

The distinct words of a batch are cut into pieces as the tokenizer file says. The symbols of all pieces lie
in one flat array. Each round takes, in every piece, the leftmost pair of lowest rank and merges it; ranks are
found by binary search over the sorted pair keys, and after a merge only its two new pairs are looked up.
A piece of more than ``LONG`` symbols is merged in the same order with a heap over a linked list
instead, since its rounds would cost the square of its length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.llm.wordtable import WordTable, ranges

LONG = 256
NONE = np.int64(1) << 30


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


def latin(word: str) -> bool:
    """Whether each character is below U+0250 and lower-cased to one character: such a word is its own NFC."""
    return word.isascii() or (max(word) < "ɐ" and "İ" not in word)


class Bpe:
    """A word-end BPE tokenizer file (normaliser NFC and lower case, split pattern, byte level) as arrays."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        vocab, suffix = d["model"]["vocab"], d["model"]["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in d["model"]["merges"]]
        self.pattern = next(p["pattern"]["Regex"] for p in d["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars])
        self.last = np.array([vocab[c + suffix] for c in chars])
        left, right = (np.array([vocab[m[i]] for m in merges], dtype=np.uint64) for i in (0, 1))
        key = left << np.uint64(32) | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.made = np.array([vocab[a + b] for a, b in merges])
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._pieces = regex.compile(self.pattern)
        self.split = self._pieces.findall  # the pieces of a normalised word

    def pieces(self, word: str) -> list[bytes | int]:
        """UTF-8 pieces of a word; the id of a special token found in it."""
        if word.isalpha() and latin(word):  # a run of letters is one piece
            return [word.lower().encode()]
        out: list[bytes | int] = []
        for part in self._cut.split(word) if self._cut and "<" in word else [word]:
            if part in self.special:
                out.append(self.special[part])
            else:
                if part.isascii():
                    part = part.lower()
                else:
                    part = "".join(map(str.lower, unicodedata.normalize("NFC", part)))  # by character: no final-sigma rule
                out += [p.encode("utf-8", "surrogatepass") for p in self._pieces.findall(part)]
        return out

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it isn't merged: binary search over the sorted pair keys."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the symbols of many pieces: (ids, number of ids of each piece)."""
        word = np.repeat(np.arange(len(size)), size)
        done_word, done_sym = [], []
        rank = np.full(len(sym), NONE)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        while len(sym):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), head)
            live = (best >> 32) < NONE
            if not live.all():
                stay = np.repeat(live, np.diff(np.append(head, len(sym))))
                done_word.append(word[~stay])
                done_sym.append(sym[~stay])
                shift = np.cumsum(stay) - 1
                word, sym, rank, best = word[stay], sym[stay], rank[stay], best[live]
                at = shift[best & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            if not len(sym):
                break
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            word, sym, rank = word[keep], sym[keep], rank[keep]
            rank[at] = NONE
            right = at[at + 1 < len(sym)]
            right = right[word[right] == word[right + 1]]
            left = at[at > 0] - 1
            left = left[word[left] == word[left + 1]]
            for i in (left, right):
                rank[i] = self.rank(sym[i], sym[i + 1])
        word, sym = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_word, done_sym))
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(size))

    def merge_long(self, sym: np.ndarray) -> np.ndarray:
        """The same merges of one long piece: heap of (rank, place) over a linked list."""
        ids = sym.tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        rank = self.rank(sym[:-1], sym[1:])
        heap = [(int(r), i) for i, r in enumerate(rank.tolist()) if r < NONE]
        heapq.heapify(heap)
        table = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or table.get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j], after[i] = int(self.made[r]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (q := table.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (q, a))
        return np.array([x for x in ids if x >= 0])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        known: dict[bytes | int, int] = {}
        used, per_word = [], []
        for w in words:
            p = self.pieces(w)
            per_word.append(len(p))
            used += [known.setdefault(x, len(known)) for x in p]
        parts: list[np.ndarray] = [np.zeros(0, np.int64)] * len(known)
        short = [(i, x) for x, i in known.items() if isinstance(x, bytes) and len(x) <= LONG]
        for x, i in known.items():
            if isinstance(x, int):
                parts[i] = np.array([x])
            elif len(x) > LONG:
                parts[i] = self.merge_long(self._symbols(x, np.array([len(x)])))
        size = np.array([len(x) for _, x in short], dtype=np.int64)
        ids, n = self.merge(self._symbols(b"".join(x for _, x in short), size), size)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        sizes[[i for i, _ in short]] = n
        flat_start = np.zeros(len(known), np.int64)
        flat_start[[i for i, _ in short]] = np.cumsum(n) - n
        flat = [ids]
        total = len(ids)
        for i, p in enumerate(parts):
            if len(p):
                flat_start[i] = total
                flat.append(p)
                total += len(p)
        used_ = np.array(used, dtype=np.int64)
        per_piece = sizes[used_]
        out = np.concatenate(flat)[ranges(flat_start[used_], per_piece)]
        ends = np.concatenate([[0], np.cumsum(per_piece)])
        bound = np.concatenate([[0], np.cumsum(np.array(per_word, dtype=np.int64))])
        return out, np.diff(ends[bound])

    def _symbols(self, raw: bytes, size: np.ndarray) -> np.ndarray:
        b = np.frombuffer(raw, dtype=np.uint8)
        sym = self.inner[b]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[b[ends]]
        return sym

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks, special tokens included: the file names no decoder."""
        return " ".join([self.names[i] for i in ids])


_kept: dict[int, tuple[Bpe, WordTable]] = {}


def worker_table(spec: str) -> tuple[Bpe, WordTable]:
    """One tokenizer and word table for each worker process and tokenizer file."""
    key = hash(spec)
    if key not in _kept:
        _kept.clear()
        bpe = Bpe(spec)
        _kept[key] = bpe, WordTable(bpe.encode)
    return _kept[key]


def _coded(spec, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        bpe, table = worker_table(spec.value)
        for b, data, offs in tk.chunks(batches):
            ids, at = table.ids(data, offs)
            n, sha, dec = np.diff(at), [], []
            words = ids.tolist()
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                sha.append(hashlib.sha256(ids[lo:hi].astype("<u4").tobytes()).hexdigest())
                dec.append(hashlib.sha256(bpe.decode(words[lo:hi]).encode("utf-8", "surrogatepass")).hexdigest())
            cols = [b.column(0), pa.array(n), pa.array(sha, pa.string()), pa.array(dec, pa.string())]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids with ``with_ids``).

    A null text is empty: no ids, and the digests of nothing. Special-token strings in a text become their ids, as the
    tokenizers library does. Repeated rows and null ids stay; other columns are never read. The file
    (a few MB, read once on the driver) is broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_coded(spec, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
