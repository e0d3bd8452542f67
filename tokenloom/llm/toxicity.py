"""Operator 8, toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words (a fixed seed list, and words learned from the labels), plain and disguised;
lexicon words near a second-person word; capitals, punctuation, elongation and other obfuscation rates. Word-level facts are worked
out once for each distinct word of a worker; everything else is numpy over whole batches. Trees, lexicon and calibration are
learned from at most ``TRAIN_ROWS`` labelled texts (the least by hash of their id), whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.llm.wordtable import WordTable

TRAIN_ROWS = 20_000
LEARNED_WORDS = 64  # most words that the lexicon learns
NEAR = 4  # words between a lexicon word and a second-person word
TREES, DEPTH, RATE, BINS, LEAST = 60, 3, 0.2, 32, 20
TOXIC_AT = 0.7
# fixed values: seed lexicon, second-person words, and characters that stand for letters
SEEDS = frozenset("idiot idiots moron morons stupid dumb loser losers trash scum pathetic disgusting worthless clown imbecile fool hate ugly garbage filth pig liar coward freak retard bastard bitch asshole fuck fucking shit damn crap kill die "
                  "idiota imbécil estúpido basura asqueroso dumm dummkopf abschaum arschloch müll idiotin crétin connard imbécile stupide ordure".split())
YOU = frozenset("you your yours yourself u ur ya du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!|", "oieastasii")

_EDGE = regex.compile(r"^[^\p{L}\p{N}@$]+|[^\p{L}\p{N}@$]+$")
_INNER = regex.compile(r"[^\p{L}]+")
_LONG = regex.compile(r"(\p{L})\1{2,}")
_MIXED = regex.compile(r"\p{L}[0-9@$*!._-]+\p{L}|[@$]\p{L}{2}")
_PUNCT = regex.compile(r"[^\p{L}\p{N}\s]")

WORD = ("letters", "capitals", "punctuation", "shouted", "you", "seed", "learned", "disguised", "elongated", "mixed", "exclaimed")
NAMES = ("words", "capitals", "punctuation", "shouted", "you", "seed", "learned", "disguised", "elongated", "mixed", "exclaimed", "hits", "near", "near_rate", "longest")


def word_facts(word: str, learned: frozenset[str]) -> tuple[int, ...]:
    """The facts WORD of one word as written."""
    bare = _EDGE.sub("", word)
    low = bare.lower()
    plain = low if low.isalpha() else ""
    long = bool(_LONG.search(low))
    mixed = bool(_MIXED.search(low))
    seed, own = low in SEEDS, low in learned
    masked = False
    if (long or mixed) and not (seed or own):
        clear = _INNER.sub("", low.translate(LEET))
        masked = any(x in SEEDS or x in learned for x in (clear, _LONG.sub(r"\1", clear), _LONG.sub(r"\1\1", clear)))
    letters = sum(map(str.isalpha, word))
    capitals = sum(map(str.isupper, word))
    return letters, capitals, len(_PUNCT.findall(word)), letters > 2 and capitals == letters, (plain or low) in YOU, seed, own, masked, long, mixed, word.count("!") + word.count("?")


def _encoder(learned: frozenset[str]):
    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.array([word_facts(w, learned) for w in words], dtype=np.int32).reshape(-1)
        return flat, np.full(len(words), len(WORD), dtype=np.int64)

    return encode


def features(data: np.ndarray, offs: np.ndarray, table: WordTable) -> np.ndarray:
    """(texts x NAMES) of a batch of texts."""
    flat, at = table.ids(data, offs)
    facts, first = flat.reshape(-1, len(WORD)), at // len(WORD)
    n = np.diff(first)
    total = np.vstack([np.zeros(len(WORD), np.int64), np.cumsum(facts, axis=0, dtype=np.int64)])
    sums = (total[first[1:]] - total[first[:-1]]).astype(float)
    rate = sums / np.maximum(n, 1)[:, None]
    letters = np.maximum(sums[:, 0], 1)
    text = np.repeat(np.arange(len(n)), n)
    hit = np.flatnonzero(facts[:, 5:8].any(axis=1))
    you = np.flatnonzero(facts[:, 4])
    near = np.zeros(len(hit), dtype=bool)
    if len(you):
        i = np.searchsorted(you, hit)
        for j in (np.minimum(i, len(you) - 1), np.maximum(i - 1, 0)):
            near |= (np.abs(you[j] - hit) <= NEAR + 1) & (text[you[j]] == text[hit])
    hits = np.bincount(text[hit], minlength=len(n)).astype(float)
    nears = np.bincount(text[hit], weights=near, minlength=len(n))
    longest = np.zeros(len(n))
    np.maximum.at(longest, text, facts[:, 0])
    return np.column_stack([np.log1p(n), sums[:, 1] / letters, sums[:, 2] / letters, rate[:, 3:], hits, nears, nears / np.maximum(n, 1), longest])


class Boosted:
    """Gradient-boosted trees for the logistic loss, on binned features, and an isotonic curve for their sums."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base, self.trees, self.curve = 0.0, [], None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        self.constant = None
        aside = np.arange(len(y)) % 4 == 3 if len(y) >= 40 else np.zeros(len(y), bool)
        if not (0 < y[~aside].sum() < (~aside).sum()):
            aside[:] = False
        fx, fy = x[~aside], y[~aside]
        cuts = [np.unique(np.quantile(fx[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        cuts = [np.unique(np.append(c, 0.0)) for c in cuts]  # most densities are 0 in most texts
        bins = np.column_stack([np.searchsorted(c, fx[:, j], side="left") for j, c in enumerate(cuts)])
        self.base = float(np.log(fy.mean() / (1 - fy.mean())))
        f = np.full(len(fy), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(bins, fy - p, p * (1 - p), np.arange(len(fy)), DEPTH, cuts)
            self.trees.append(tree)
            f = f + self._apply(tree, fx)
        raw, ry = (self.raw(x[aside]), y[aside]) if aside.any() and 0 < y[aside].sum() < aside.sum() else (f, fy)
        self.curve = isotonic(raw, ry)

    def _grow(self, bins, g, h, rows, depth, cuts):
        leaf = RATE * g[rows].sum() / (h[rows].sum() + 1.0)
        if depth == 0 or len(rows) < 2 * min(LEAST, max(1, len(g) // 20)):
            return leaf
        best = (1e-6, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for j, c in enumerate(cuts):
            b = bins[rows, j]
            gs, hs, ns = (np.cumsum(np.bincount(b, w, minlength=len(c) + 1))[:-1] for w in (g[rows], h[rows], None))
            gain = gs ** 2 / (hs + 1) + (g[rows].sum() - gs) ** 2 / (h[rows].sum() - hs + 1) - whole
            least = min(LEAST, max(1, len(g) // 20))
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (float(gain[k]), (j, k))
        if best[1] is None:
            return leaf
        j, k = best[1]
        left = bins[rows, j] <= k
        return j, float(cuts[j][k]), self._grow(bins, g, h, rows[left], depth - 1, cuts), self._grow(bins, g, h, rows[~left], depth - 1, cuts)

    def _apply(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, left, right = tree
        return np.where(x[:, j] <= cut, self._apply(left, x), self._apply(right, x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(self._apply(t, x) for t in self.trees)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        raw = self.raw(x)
        return np.clip(np.interp(raw, *self.curve) + 1e-4 * (1 / (1 + np.exp(-raw)) - 0.5), 0, 1)  # the last term keeps the order on flat stretches


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (centres, rising means with one positive and negative half of prior each)."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of raw
    for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([float(v), 1.0, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], a, strict=True)]
    # a small block has a bit of doubt: half a row of the mean is added
    mean = float(y.mean())
    level = np.maximum.accumulate([(s + 0.5 * mean) / (n + 0.5) for s, n, _ in blocks])
    return np.array([t / n for _, n, t in blocks]), level


def learn_lexicon(texts: DataFrame) -> frozenset[str]:
    """Words that mark label 1: by document frequencies of the two classes, smoothed log odds and a least share."""
    n1, n0 = (texts.where(F.col("y") == v).count() for v in (1, 0))
    words = F.array_distinct(F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\s]+", " ")), r"\s+"))
    seen = (texts.select("y", F.explode(words).alias("w")).where(F.length("w") >= 3).groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    top = seen.where((F.col("a") >= max(3, n1 * 0.01)) & (odds > 2)).orderBy(odds.desc(), "w").limit(LEARNED_WORDS).collect()
    return frozenset(r.w for r in top)


def _facts(learned):
    schema = pa.schema([("y", pa.int32()), ("id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        table = WordTable(_encoder(learned.value))
        for b, data, offs in tk.chunks(batches):
            x = features(data, offs, table)
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), pa.array(list(x), pa.list_(pa.float64()))], schema=schema)

    return run


def _score(fitted):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        learned, model = fitted.value
        table = WordTable(_encoder(learned))
        for b, data, offs in tk.chunks(batches):
            s = model.score(features(data, offs, table))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s), pa.array((s >= TOXIC_AT).astype(np.int32))], schema=schema)

    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str):
    """Broadcast (lexicon, model), learned from TRAIN_ROWS labelled texts at most."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    ids = docs.where(train).select(F.col(id_col).cast("long").alias("id")).distinct()
    sample = F.broadcast(known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(sample, "id")
    context = docs.sparkSession.sparkContext
    learned = learn_lexicon(texts)
    rows = texts.select("id", "text", "y").mapInArrow(_facts(context.broadcast(learned)), "y int, id long, x array<double>").toPandas().sort_values("id")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(NAMES))
    mixed = np.argsort(tk.mix(rows["id"].to_numpy().astype(np.uint64)), kind="stable")
    return context.broadcast((learned, Boosted(x[mixed], rows["y"].to_numpy()[mixed].astype(float))))


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from TOXIC_AT on).

    Labels are read for rows where ``train`` holds only; a score reads nothing but the text. A null text is an empty one, and is
    scored like any text. Repeated labels of an id count as their greatest; null labels and ids are left out. Labels
    of one kind only, or none, give every text their mean (0 for none). Repeated rows stay; other columns are never read.
    """
    fitted = fit(docs, labels, train, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(_score(fitted), "doc_id long, held_out boolean, score double, predicted int")
