"""Operator 5, language-model scoring with a sharded Elias-Fano n-gram trie.

The model is a word bigram model with hierarchical Dirichlet smoothing: P1(w) = (c(w) + 1) / (N + V + 1) and
P(w | v) = c(vw) / (c(v) + MU) + MU / (c(v) + MU) * P1(w); a text starts in a context of its own. It grows with the corpus,
so it is never in one place: texts are packed into batches of bounded size, and each batch asks for its distinct words
and bigrams once. A request carries the batch's own training counts, so the rows that build a shard are those that query it.

1. Words are dealt to shards by hash; a shard gives them dense ids and their counts.
2. Bigrams are dealt by context, and a context's successors over ``SALTS`` pieces, so no context fills a shard. A shard
   builds a trie: contexts and successors are Elias-Fano sequences, pointers from contexts to their successors another,
   and the smoothed probability of each successor is a 16-bit code. All lies in one flat buffer opened in place.
   A bigram is found by its context, then by successor search relative to the context's range.
3. Each batch joins the answers with its tokens and sums the scores of its texts.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.llm.elias_fano import EliasFano
from tokenloom.session import materialize

MU = 500.0
BATCH_BYTES = 8 << 20  # text in a batch, about; a longer text is a batch of its own
SHARD_ITEMS = 1 << 20  # requests that a shard gets, about
SALTS = 16
FLOOR = -8.0  # least log10 of a stored probability
START = np.uint32(0xFFFFFFFF)  # id of the context that a text starts in

BATCHES = "batch string, docs binary, known binary, train binary, ends binary, tokens binary, places binary, n_tokens long, n_words long, vocab binary"


def _packed(x: np.ndarray) -> bytes:
    """A column for the shuffle: its numbers by byte planes, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T) if len(x) else np.zeros(0, np.uint8)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def _pack():
    names = [x.split()[0] for x in BATCHES.split(", ")]

    def run(batches):
        for b, data, offs in tk.chunks(batches, chunk_bytes=BATCH_BYTES):
            start, end, first = tk.word_bounds(data, offs)
            words = tk.word_hashes(data, start, end) | np.uint64(1)  # 0 is the end of a text
            words = np.insert(words, first[1:], np.uint64(0))
            vocab, tokens, often = np.unique(tk.mix(words), return_inverse=True, return_counts=True)
            places = np.argsort(-often, kind="stable")  # tokens are numbered by frequency, which packs better
            rank = np.empty(len(places), np.uint32)
            rank[places] = np.arange(len(places))
            ids = b.column(0)
            row = [str(uuid.uuid4()), ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_valid().to_numpy(False).astype(np.uint8).tobytes(), b.column(2).to_numpy(False).astype(np.uint8).tobytes(),
                   (first[1:] + np.arange(1, len(first))).astype("<i8").tobytes(), _packed(rank[tokens]), _packed(places.astype("<u4")), len(tokens), len(vocab), vocab.tobytes()]
            kinds = {str: pa.string(), int: pa.int64(), bytes: pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([x], kinds[type(x)]) for x in row], names=names)

    return run


class _Batch:
    def __init__(self, row):
        self.docs = np.frombuffer(row.docs, "<i8")
        self.known = np.frombuffer(row.known, np.uint8).astype(bool)
        self.train = np.frombuffer(row.train, np.uint8).astype(bool)
        self.ends = np.frombuffer(row.ends, "<i8")
        self.tokens = _unpacked(row.places, "<u4")[_unpacked(row.tokens, "<u4")]
        self.words = int(row.n_words)
        self.sizes = np.diff(self.ends, prepend=0)
        self.learned = np.repeat(self.train, self.sizes)

    def bigrams(self, ids: np.ndarray, counts: np.ndarray, n: int):
        """(context, word, training count, count of the context, shard) of the distinct bigrams, and each token's."""
        w = ids[self.tokens]
        v = np.concatenate([[START], w[:-1]]).astype(np.uint32)
        v[self.ends[:-1]] = START
        key, back, = np.unique(v.astype(np.uint64) << np.uint64(32) | w, return_inverse=True)
        seen = np.bincount(back, weights=self.learned, minlength=len(key)).astype(np.int64)
        v, w = (key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        order = np.argsort(ids)
        end = counts[self.tokens[self.ends[0] - 1]]  # as many texts start as end
        at = order[np.minimum(np.searchsorted(ids[order], v), len(ids) - 1)]
        context = np.where(v == START, end, counts[at])
        salt = tk.mix(w.astype(np.uint64)) % np.uint64(SALTS)
        return v, w, seen, context, (tk.mix(v.astype(np.uint64) * np.uint64(SALTS) + salt) % np.uint64(n)).astype(np.int64), back


def _word_shards(vocab: np.ndarray, n: int) -> np.ndarray:
    """Shard of each word: ranges of its hash, so a sorted vocabulary is a row of shards."""
    return ((vocab >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _by_shard(shard: np.ndarray):
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


WORDS = "shard long, batch string, words binary, counts binary"


def _ask_words(n: int):
    def run(frames):
        for f in frames:
            for row in f.itertuples():
                b, vocab = _Batch(row), np.frombuffer(row.vocab, np.uint64)
                seen = np.bincount(b.tokens, weights=b.learned, minlength=len(vocab)).astype("<i8")
                rows = [(s, row.batch, vocab[i].tobytes(), _packed(seen[i])) for s, i in _by_shard(_word_shards(vocab, n))]
                yield pd.DataFrame(rows, columns=["shard", "batch", "words", "counts"])

    return run


NUMBERED = "shard long, batch string, ids binary, counts binary, distinct long, total long"


def _number(n: int):
    """A shard's words get dense ids and their counts over all batches; its first row says how many were learned."""
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(x, np.uint64) for x in rows["words"]]
        every, back = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate([_unpacked(x, "<i8") for x in rows["counts"]])).astype(np.int64)
        if len(every) * n >= START:
            raise ValueError("the vocabulary doesn't fit 32-bit ids")
        ids = (np.arange(len(every)) * n + key[0]).astype(np.uint32)
        parts = np.split(back, np.cumsum([len(x) for x in words])[:-1])
        known = [[int((count > 0).sum()), int(count.sum())]] + [[0, 0]] * (len(rows) - 1)
        return pd.DataFrame({"shard": key[0], "batch": rows["batch"], "ids": [_packed(ids[p].astype("<u4")) for p in parts], "counts": [_packed(count[p].astype("<i8")) for p in parts],
                             "distinct": [k[0] for k in known], "total": [k[1] for k in known]})

    return run


def _batch_rows(rows: pd.DataFrame):
    """(batch, ids, counts) from a batch's own row and the answers for its words."""
    b = _Batch(rows[rows["kind"] == 0].iloc[0])
    said = rows[rows["kind"] == 1].sort_values("shard")
    ids, counts = (np.concatenate([_unpacked(x, kind) for x in said[c]]) for c, kind in (("ids", "<u4"), ("counts", "<i8")))
    if len(ids) != b.words:
        raise ValueError("a batch lacks answers for some of its words")
    return b, ids, counts


BIGRAMS = "shard long, batch string, contexts binary, runs binary, context_counts binary, words binary, counts binary"


def _ask_bigrams(n: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        b, ids, counts = _batch_rows(rows)
        v, w, seen, context, shard, _ = b.bigrams(ids, counts, n)
        out = []
        for s, i in _by_shard(shard):
            head = np.flatnonzero(np.concatenate([[True], np.diff(v[i]) != 0]))
            runs = np.diff(np.append(head, len(i)))
            out.append((s, key[0], _packed(v[i][head]), _packed(runs.astype("<u4")), _packed(context[i][head]), _packed(w[i]), _packed(seen[i].astype("<u4"))))
        return pd.DataFrame(out, columns=[x.split()[0] for x in BIGRAMS.split(", ")])

    return run


class Trie:
    """Two levels in one buffer: contexts, pointers, successors relative to their context, and 16-bit codes."""

    @staticmethod
    def build(v: np.ndarray, w: np.ndarray, prob: np.ndarray) -> bytes:
        """From sorted distinct (context, word) pairs and their smoothed probabilities."""
        contexts, first = np.unique(v, return_index=True)
        width = int(w.max(initial=0)) + 1
        base = np.repeat(np.arange(len(contexts), dtype=np.uint64) * np.uint64(width), np.diff(np.append(first, len(v))))
        codes = 1 + np.rint((np.maximum(np.log10(prob), FLOOR) - FLOOR) / -FLOOR * 65534)
        parts = [EliasFano(contexts), EliasFano(np.append(first, len(v))), EliasFano(base + w)]
        return np.array([width], "<i8").tobytes() + b"".join(p.tobytes() for p in parts) + codes.astype("<u2").tobytes()

    def __init__(self, buffer: bytes):
        self.width, at = int(np.frombuffer(buffer, "<i8", 1)[0]), 8
        self.contexts, at = EliasFano.open(buffer, at)
        self.pointers, at = EliasFano.open(buffer, at)
        self.successors, at = EliasFano.open(buffer, at)
        self.codes = np.frombuffer(buffer, "<u2", self.successors.n, at)

    def find(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Code of each (context, word) pair, 0 where the trie has none."""
        out = np.zeros(len(v), dtype=np.uint16)
        if not self.contexts.n:
            return out
        i = self.contexts.successor(v)
        ok = np.flatnonzero((i < self.contexts.n) & (w < self.width))
        ok = ok[self.contexts.access(i[ok]) == v[ok]]
        i = i[ok]
        lo, hi = (self.pointers.access(x).astype(np.int64) for x in (i, i + 1))
        x = i.astype(np.uint64) * np.uint64(self.width) + w[ok]
        at = self.successors.successor(x)
        here = np.flatnonzero((at >= lo) & (at < hi))
        here = here[self.successors.access(at[here]) == x[here]]
        out[ok[here]] = self.codes[at[here]]
        return out


def probability(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** ((codes.astype(float) - 1) / 65534 * -FLOOR + FLOOR), 0.0)


CODES = "shard long, batch string, codes binary"


def _shard(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Builds a shard's trie from all requests' counts, and answers them."""
    size = [int.from_bytes(x[:8], "little") for x in rows["words"]]
    get = lambda c, kind: np.concatenate([_unpacked(x, kind) for x in rows[c]])
    runs = get("runs", "<u4")
    pair = np.repeat(get("contexts", "<u4").astype(np.uint64), runs) << np.uint64(32) | get("words", "<u4")
    every, first, back = np.unique(pair, return_index=True, return_inverse=True)
    context = np.repeat(get("context_counts", "<i8"), runs)[first]
    seen = np.bincount(back, weights=get("counts", "<u4"))
    v, w = every >> np.uint64(32), every & np.uint64(0xFFFFFFFF)
    had = seen > 0
    trie = Trie(Trie.build(v[had], w[had], seen[had] / (context[had] + MU)))
    codes = trie.find(v, w)[back].astype("<u2")
    return pd.DataFrame({"shard": key[0], "batch": rows["batch"], "codes": [_packed(x) for x in np.split(codes, np.cumsum(size)[:-1])]})


def _total(n: int, total: int, distinct: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        b, ids, counts = _batch_rows(rows)
        _, _, _, context, shard, back = b.bigrams(ids, counts, n)
        codes = np.zeros(len(shard), np.uint16)
        said = rows[rows["kind"] == 2]
        answers = {int(s): _unpacked(c, "<u2") for s, c in zip(said["shard"], said["codes"], strict=True)}
        for s, i in _by_shard(shard):
            codes[i] = answers[s]
        c = counts[b.tokens]
        base = (c + 1) / (total + distinct + 1)
        left = context[back]
        score = np.log10(probability(codes)[back] + MU / (left + MU) * base)
        start = b.ends - b.sizes
        add = lambda x: np.add.reduceat(x, start)
        return pd.DataFrame({"doc_id": pd.Series(b.docs, dtype="Int64").where(pd.Series(b.known)), "trained": b.train, "n_tokens": b.sizes,
                             "n_known": add((c > 0).astype(np.int64)), "base_score": add(np.log10(base)), "score": add(score)})

    return run


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``train`` holds (null: it doesn't); score is the model's log10 probability of the text's words and
    its end, base_score that of add-one word counts. A null text is empty: its end is its only token. Nothing to learn from
    gives N = V = 0. Repeated rows stay, and are learned from as often as they occur; other columns are never read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    batches = materialize(rows.mapInArrow(_pack(), BATCHES), "lm-batches")
    items, tokens = batches.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    words = int((items or 0) // SHARD_ITEMS) + 1
    shards = int((tokens or 0) // SHARD_ITEMS) + 1
    asked = batches.mapInPandas(_ask_words(words), WORDS)
    numbered = materialize(asked.groupBy("shard").applyInPandas(_number(words), NUMBERED), "lm-words")
    distinct, total = numbered.agg(F.sum("distinct"), F.sum("total")).first()

    nothing = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    held = batches.select(F.lit(0).alias("kind"), "batch", "docs", "known", "train", "ends", "tokens", "places", "n_words", *nothing("long", "shard"), *nothing("binary", "ids", "counts", "codes"))
    told = numbered.select(F.lit(1).alias("kind"), "batch", *nothing("binary", "docs", "known", "train", "ends", "tokens", "places"), *nothing("long", "n_words"), "shard", "ids", "counts", *nothing("binary", "codes"))
    both = held.unionByName(told)
    bigrams = both.groupBy("batch").applyInPandas(_ask_bigrams(shards), BIGRAMS)
    codes = bigrams.groupBy("shard").applyInPandas(_shard, CODES)
    codes = codes.select(F.lit(2).alias("kind"), "batch", *nothing("binary", "docs", "known", "train", "ends", "tokens", "places"), *nothing("long", "n_words"), "shard", *nothing("binary", "ids", "counts"), "codes")
    out = both.unionByName(codes).groupBy("batch").applyInPandas(_total(shards, int(total or 0), int(distinct or 0)), "doc_id long, trained boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", F.lit(int(total or 0)).cast("long").alias("train_tokens"), "base_score", "score")
