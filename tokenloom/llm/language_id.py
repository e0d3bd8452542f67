"""Operator 6, language identification by interpolated Kneser-Ney character models.

A text is lower-cased; letters are kept, every run of other characters is one blank, and the text starts after a
blank. For each language an interpolated Kneser-Ney model of ``ORDER`` characters is
learned from at most ``SAMPLE`` labelled texts (the least by hash of their id, whole; every language is learned) and stored as sorted
hash arrays: for each order the n-gram keys with their final probabilities, and the context keys with the weight
of the lower order. A text's language is the one with the least cross-entropy per character. It is rejected
when that cross-entropy lies further above the language's own mean than calibration texts do, with room for short ones.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.session import materialize

ORDER = 4
SAMPLE = 600  # labelled texts a language learns from at most; one in five of them calibrates
LANGUAGES = 200  # whose models a task holds at a time; more of them are worked off in groups
BROADCAST_LANGUAGES = 2000  # up to so many, the table of languages and that of the sampled ids are broadcast
DISCOUNT = 0.75
BITS = 12  # of a character in an n-gram key
CHUNK_BYTES = 512 << 10  # of text that a task scores at a time; some 100 bytes of arrays to each
DENSE = 1 << 23  # possible keys up to which distinct ones are found in tables (5 bytes each) instead of by sorting
# A text is rejected if its cross-entropy is above the language's mean by more than SLACK times the share that all but one in 200
# calibration texts stay within (LEAST_ABOVE at least), plus SHORT / sqrt(characters)
SLACK, LEAST_ABOVE, SHORT = 1.5, 0.6, 4.0
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Symbol of each code point: 0 for no letter, else 12 bits (exact below 4096, hashed above)."""
    cp = np.arange(0x110000, dtype=np.uint32)
    out = np.where(cp < 4096, cp, 1 + (tk.mix(cp) % np.uint64(4095)).astype(np.uint32))
    return np.where([chr(c).isalpha() for c in cp], out, 0).astype(np.uint16)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, offset of each text, letters of each text); each text is led by a blank."""
    low = [(" " + t).lower() for t in texts]
    ends = np.cumsum([len(t) for t in low]) if low else np.zeros(0, np.int64)
    offs = np.concatenate([[0], ends]).astype(np.int64)
    sym = _letters()[np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = sym != 0
    count = np.concatenate([[0], np.cumsum(keep)])
    letters = count[offs[1:]] - count[offs[:-1]]
    keep[1:] |= sym[:-1] != 0
    keep[offs[:-1]] = True
    return sym[keep], np.concatenate([[0], np.cumsum(keep)])[offs], letters


def grams(sym: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Key of each symbol after a text's leading blank, with ORDER - 1 symbols before it; blanks stand before a text."""
    at = np.arange(len(sym)) - np.repeat(offs[:-1], np.diff(offs))
    key = sym.astype(np.uint64)
    for k in range(1, ORDER):
        before = np.zeros(len(sym), dtype=np.uint64)
        before[k:] = sym[:-k]
        before[at < k] = 0
        key |= before << np.uint64(BITS * k)
    return key


def _cut(key: np.ndarray, n: int) -> np.ndarray:
    return key & np.uint64((1 << (BITS * n)) - 1)


class KneserNey:
    """Sorted hash arrays of one language."""

    def __init__(self, key: np.ndarray):
        keys, count = np.unique(key, return_counts=True)
        self.floor = 1.0 / (1 + len(np.unique(_cut(key, 1))))
        self.orders = []  # from one character up: (keys, probabilities, context keys, weights)
        levels = [(keys, count)]
        for n in range(ORDER - 1, 0, -1):  # counts of lower orders: how many characters stand before
            levels.append(np.unique(_cut(levels[-1][0], n), return_counts=True))
        for n, (keys, count) in enumerate(reversed(levels), 1):
            ctx, first = np.unique(keys >> np.uint64(BITS), return_inverse=True)
            total, kinds = np.bincount(first, count), np.bincount(first)
            weight = DISCOUNT * kinds / total
            prob = (count - DISCOUNT) / total[first] + weight[first] * self.probability(_cut(keys, n - 1) if n > 1 else keys, n - 1)
            self.orders.append((keys, prob, ctx, weight))

    def probability(self, key: np.ndarray, n: int) -> np.ndarray:
        """Of the last character of n-character keys, given those before it."""
        if n == 0:
            return np.full(len(key), self.floor)
        keys, prob, ctx, weight = self.orders[n - 1]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        out = prob[at]
        if not hit.all():
            miss = key[~hit]
            c = np.minimum(np.searchsorted(ctx, miss >> np.uint64(BITS)), len(ctx) - 1)
            lower = np.where(ctx[c] == miss >> np.uint64(BITS), weight[c], 1.0)
            out[~hit] = lower * self.probability(_cut(miss, n - 1), n - 1)
        return out


def cross_entropies(texts: list[str], models: dict[str, KneserNey]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts x languages nats per character, characters, letters)."""
    sym, offs, letters = symbols(texts)
    key, back = _distinct(grams(sym, offs))
    n = np.diff(offs)
    out = np.empty((len(texts), len(models)))
    for j, m in enumerate(models.values()):
        total = np.concatenate([[0.0], np.cumsum(np.log(m.probability(key, ORDER))[back])])
        out[:, j] = -(total[offs[1:]] - total[offs[:-1]]) / n
    return out, n, letters


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse; by counting where the symbols at hand make few possible keys."""
    low = np.flatnonzero(np.bincount(_cut(key, 1).astype(np.int64), minlength=1 << BITS))
    low = np.union1d(low, [0])
    if len(low) ** ORDER > DENSE:
        return np.unique(key, return_inverse=True)
    dense = np.zeros(1 << BITS, dtype=np.int64)
    dense[low] = np.arange(len(low))
    code = np.zeros(len(key), dtype=np.int64)
    for k in reversed(range(ORDER)):
        code = code * len(low) + dense[(key >> np.uint64(BITS * k)) & np.uint64((1 << BITS) - 1)]
    seen = np.zeros(len(low) ** ORDER, dtype=bool)
    seen[code] = True
    there = np.flatnonzero(seen)
    place = np.zeros(len(low) ** ORDER, dtype=np.int32)
    place[there] = np.arange(len(there))
    keys, rest = np.zeros(len(there), dtype=np.uint64), there
    for k in range(ORDER):
        keys |= low[rest % len(low)].astype(np.uint64) << np.uint64(BITS * k)
        rest = rest // len(low)
    return keys, place[code]


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    """One language's model from its sample; every fifth text is kept back for calibration."""
    rows = rows.sort_values("rank")
    part = rows[rows["rank"] % 5 != 0] if len(rows) > 1 else rows
    sym, offs, letters = symbols(part["text"].tolist())
    key = grams(sym, offs)
    out = rows[["lang"]].head(1).assign(model=[pickle.dumps(KneserNey(key)) if letters.sum() else None])
    return out[out["model"].notna()]


def _calibrate(texts: pd.DataFrame, models: dict[str, KneserNey]) -> dict[str, tuple[float, float]]:
    """(mean cross-entropy, share above it that is allowed to long texts) of each language."""
    out = {}
    for lang in models:
        own = texts.loc[texts["lang"] == lang, "text"].tolist()
        ce, n, letters = cross_entropies(own, {lang: models[lang]}) if own else (np.zeros((0, 1)), np.zeros(0), np.zeros(0))
        ce, n = ce[letters > 0, 0], n[letters > 0]
        mean = float(np.average(ce, weights=n)) if len(ce) else np.inf  # nothing to calibrate by: no text is rejected
        above = float(np.quantile(ce / mean - 1, 0.995)) if len(ce) else 0.0
        out[lang] = (mean, SLACK * max(above, LEAST_ABOVE))
    return out


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> Iterator:
    """Broadcast (models, limits) of each group of LANGUAGES languages, one after another; none if nothing can be learned.

    Every language is learned. The sample, and so what reaches the driver at a time, is SAMPLE texts of each language of a group."""
    w = W.partitionBy("lang").orderBy("u", "id")
    known = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and id is not null").distinct()
    known = known.withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1 << 52)) / F.lit(float(1 << 52)))
    counts = materialize(known.groupBy("lang").agg(F.count("*").alias("c")).withColumn("grp", F.expr(f"(row_number() over (order by lang) - 1) div {LANGUAGES}")), "languages")
    groups = counts.agg(F.max("grp")).first()[0]
    groups = 0 if groups is None else groups + 1
    # only rows whose hash is low enough for some 4 * SAMPLE of a language are ranked, so none ranks all its rows
    few = F.broadcast(counts) if groups * LANGUAGES <= BROADCAST_LANGUAGES else counts
    low = known.join(few, "lang").where(F.col("u") < F.lit(4.0 * SAMPLE) / F.col("c"))
    sample = low.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= SAMPLE).select("id", "lang", "rank", "grp")
    texts = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null")
    texts = texts.join(F.broadcast(sample) if groups * LANGUAGES <= BROADCAST_LANGUAGES else sample, ["id", "lang"])
    texts = texts.groupBy("lang", "rank", "grp").agg(F.min("text").alias("text"))  # of an id's several texts, the least
    if groups > 1:
        texts = materialize(texts, "language-sample")
    for g in range(groups):
        own = texts.where(F.col("grp") == g)
        learned = own.groupBy("lang").applyInPandas(_learn, "lang string, model binary").collect()
        models = {r.lang: pickle.loads(r.model) for r in sorted(learned, key=lambda r: r.lang)}
        if models:
            yield labelled.sparkSession.sparkContext.broadcast((models, _calibrate(own.where("rank % 5 = 0").select("lang", "rank", "text").toPandas(), models)))


STATE = "doc_id long, text string, held_out boolean, lang string, least double, second double, mean double, most double"
OUT = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"
_KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _best(ce: np.ndarray, models: dict, limits: dict) -> list[np.ndarray]:
    """(name, cross-entropy, next best cross-entropy, mean, share allowed above it) of each text's best language."""
    names = np.array([*models], dtype=object)
    mean, most = (np.array([limits[x][i] for x in models]) for i in (0, 1))
    best = ce.argmin(axis=1)
    second = np.partition(ce, 1, axis=1)[:, 1] if ce.shape[1] > 1 else np.full(len(ce), np.inf)
    return [names[best], ce.min(axis=1), second, mean[best], most[best]]


def _narrow(fitted):
    """Holds each text's best language so far against one more group of languages."""
    schema = _schema(STATE)

    def run(batches):
        models, limits = fitted.value
        for b, _, _ in tk.chunks(batches, chunk_bytes=CHUNK_BYTES):
            new = _best(cross_entropies([t or "" for t in b.column(1).to_pylist()], models)[0], models, limits)
            old = [np.array(b.column(i).to_pylist(), dtype=object if i == 3 else float) for i in range(3, 8)]
            better = new[1] < old[1]  # of equals the first by name, and groups are in the order of names
            second = np.where(better, np.minimum(new[2], old[1]), np.minimum(old[2], new[1]))
            best = [np.where(better, x, y) for x, y in zip(new, old, strict=True)]
            best[2] = second
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(x, t) for x, t in zip(best, schema.types[3:], strict=True))], schema=schema)

    return run


def _predict(fitted):
    """Holds each text's best language of the groups before against the last group, and decides. ``fitted``: None if nothing was learned."""
    schema = _schema(OUT)

    def run(batches):
        models, limits = fitted.value if fitted is not None else ({}, {})
        for b, _, _ in tk.chunks(batches, chunk_bytes=CHUNK_BYTES):
            ce, n, letters = cross_entropies([t or "" for t in b.column(1).to_pylist()], models)
            if models:
                lang, least, second, mean, most = _best(ce, models, limits)
            else:
                lang, letters = np.full(b.num_rows, UNKNOWN, dtype=object), letters * 0
                least, second, mean, most = (np.zeros(b.num_rows) for _ in range(4))
            if b.num_columns > 3:
                old = [np.array(b.column(i).to_pylist(), dtype=object if i == 3 else float) for i in range(3, 8)]
                better = least < old[1]
                second = np.where(better, np.minimum(second, old[1]), np.minimum(old[2], least))
                lang, least, mean, most = (np.where(better, x, y) for x, y in ((lang, old[0]), (least, old[1]), (mean, old[3]), (most, old[4])))
            lang = np.where(letters > 0, lang, UNKNOWN)
            second = np.where(np.isinf(second), least + 1, second)
            score = np.where(letters > 0, 1 / (1 + np.exp(-np.minimum((second - least) * np.sqrt(n), 50))), 0.0)
            rejected = (letters == 0) | (least > mean * (1 + most + SHORT / np.sqrt(n)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(lang, pa.string()), pa.array(score), pa.array(np.where(letters > 0, least, np.nan)), pa.array(rejected)], schema=schema)

    return run


def identify(docs: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, cross_entropy, rejected.

    Rows where ``train`` holds, with an id, a text and a language, are learned from; predictions read only texts.
    A null text or one without a letter is ``und`` with score 0, cross-entropy NaN, and rejected; so is every
    text if nothing could be learned. score is 1 / (1 + exp(-margin * sqrt(characters))) of the two best languages,
    ties go to the language first by name. Repeated rows and null ids stay; other columns are never read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    last = None
    for fitted in fit(docs.where(train), id_col, text_col, lang_col):
        if last is not None:
            if len(rows.columns) == 3:
                rows = rows.select("*", F.lit(UNKNOWN).alias("lang"), *(F.lit(x).alias(c) for c, x in (("least", float("inf")), ("second", float("inf")), ("mean", 0.0), ("most", 0.0))))
            rows = materialize(rows.mapInArrow(_narrow(last), STATE), "languages-so-far")
            last.unpersist()
        last = fitted
    return rows.mapInArrow(_predict(last), OUT)


def heldout(id_col: str = "doc_id", mod: int = 5, rest: int = 0) -> Column:
    """Whether an id belongs to the held-out rows; a null id doesn't."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rest, F.lit(False))
