import collections
import math
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF001
from tokenloom.llm import language_id as li
from tokenloom.llm import lm_score as lm


def brute(rows, train):
    """The model's definition with plain dictionaries."""
    seqs = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"], train(d)) for d, t in rows]
    one, two, left = collections.Counter(), collections.Counter(), collections.Counter()
    for _, s, ok in seqs:
        if ok:
            one.update(s)
            two.update(zip([None, *s], s))  # noqa: B905
            left.update([None, *s[:-1]])
    left["</s>"] = 0
    n, v, out = one.total(), len(one), []
    for d, s, ok in seqs:
        base = [(one[w] + 1) / (n + v + 1) for w in s]
        p = [two[a, w] / (left[a] + lm.MU) + lm.MU / (left[a] + lm.MU) * q for a, w, q in zip([None, *s], s, base)]  # noqa: B905
        out.append((d, not ok, len(s), sum(one[w] > 0 for w in s), n, sum(map(math.log10, base)), sum(map(math.log10, p))))
    return sorted(out, key=str)


def same(got, want):
    got = sorted((tuple(r) for r in got), key=lambda r: str(r[:5]))
    want = sorted(want, key=lambda r: str(r[:5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], abs=1e-4 * w[2] + 1e-9)


def train(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 != 2


@pytest.mark.parametrize("size", [1 << 21, 5000])
def test_documents_against_dictionaries(spark, monkeypatch, size):
    monkeypatch.setattr(lm, "SHARD_ITEMS", size)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = lm.score_texts(docs, ~li.heldout("doc_id", 7, 2)).collect()
    same(out, brute([(r.doc_id, r.text) for r in docs.collect()], train))
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_trie():
    r = np.random.default_rng(2)
    pairs = np.unique(r.integers(0, 60, (800, 2)).astype(np.uint64), axis=0)
    p = r.random(len(pairs)) * 0.9 + 1e-6
    t = lm.Trie(lm.Trie.build(pairs[:, 0], pairs[:, 1], p))
    assert np.allclose(lm.probability(t.find(pairs[:, 0], pairs[:, 1])), p, rtol=2e-3)
    every = np.array([(a, b) for a in range(70) for b in range(70)], dtype=np.uint64)
    have = {tuple(x) for x in pairs.tolist()}
    assert ((t.find(every[:, 0], every[:, 1]) > 0) == [tuple(x) in have for x in every.tolist()]).all()


def test_odd_rows(spark):
    rows = [(1, "a b A  b"), (2, None), (3, ""), (1, "a b A  b"), (None, "b zz"), (9, "w " * 50000), (10, "a b\nc"), (16, "b a")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, score int")
    from pyspark.sql import functions as F
    held = li.heldout("doc_id", 7, 2)
    same(lm.score_texts(df, ~held & F.col("doc_id").isNotNull()).collect(), brute(rows, train))
    none = lm.score_texts(df, F.lit(None).cast("boolean")).collect()
    same(none, brute(rows, lambda d: False))
    assert lm.score_texts(df.limit(0), ~held).count() == 0
