import math
import random

import duckdb
import numpy as np
import pytest

from tests.conftest import SF01
from tokenloom.llm import hard_negatives as hn

NAMES = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"


def brute(rows):
    kept = []
    for i, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((i, [math.floor(256 * c) for c in x], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for i, x, label in kept:
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, y)), j is None, j or 0, m) for j, y, m in kept))
        for ps, pnull, p, _ in [s for s in scored if s[3] == label and (s[1] or s[2] != i)][:5]:
            fits = [s for s in scored if s[3] != label and -30 * ps <= -100 * s[0] <= -90 * ps][:10]
            out += [(i, None if pnull else p, k, None if n[1] else n[2], -ps, -n[0]) for k, n in enumerate(fits, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(NAMES.split(", ")).collect()), key=str)


def vectors(n, dim, seed, labels=10):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) + 3 * r.normal(size=(6, dim))[r.integers(0, 6, n)]
    return [(i, [float(c) for c in np.float32(v)], int(r.integers(0, labels))) for i, v in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], m, 1, "x", 0) for i, v, m in rows], "vec_id long, embedding array<float>, label int, cell int, vec string, anchor long")


def test_table_and_sql(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want = brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert got(hn.mine(df)) == want and want
    duckdb.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    assert sorted(duckdb.sql(f"SELECT {NAMES} FROM ({hn.SQL})").fetchall(), key=str) == want


@pytest.mark.parametrize("shard,block", [(50, 3), (1000, 1000)])
def test_cells(spark, monkeypatch, shard, block):
    """Several shards and blocks give what one does, in few steps and many."""
    for name, value in (("SHARD", shard), ("BLOCK", block), ("STEP", 16), ("CLUSTERS", 3)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(900, 8, 5)
    assert got(hn.mine(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(420, 6, 9, labels=3)
    nan, inf = float("nan"), float("inf")
    rows += [(500, [1.0, nan, 0, 0, 0, 0], 1), (600, None, 1), (700, [1.0] * 6, None), (800, [inf] + [0.0] * 5, 2), (900, [None] + [1.0] * 5, 2),
             (1000, [0.0] * 6, 1), (1100, [], 1), (1200, [3.0] * 9, 2), (1300, [-2.0, 5.0], 0), (None, [2.0] * 6, 1), (None, [2.0] * 6, 2), (None, None, None)]
    rows += [(2000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0], i % 2) for i in range(40)]  # ties
    rows += [rows[200], rows[200], rows[13], rows[13]] + [(100, rows[100][1], 4)]  # repeats, and an id with two rows
    random.Random(3).shuffle(rows)
    assert got(hn.mine(frame(spark, rows))) == brute(rows)
    assert hn.mine(frame(spark, rows).limit(0)).count() == 0
    assert hn.mine(frame(spark, rows).where("vec_id % 100 != 0")).count() == 0


def test_large_components(spark):
    rows = [(i, [c * 2.0 ** 20 for c in v], m) for i, v, m in vectors(230, 4, 2, labels=2)]
    assert got(hn.mine(frame(spark, rows))) == brute(rows)
    rows[100] = (100, [2.0 ** 40] * 4, 0)
    rows[3] = (3, [2.0 ** 40] * 4, 0)
    with pytest.raises(Exception, match="too large"):
        hn.mine(frame(spark, rows)).collect()


def test_walk_ends_early(monkeypatch):
    """Certified termination: with clustered directions most of the list is never scored."""
    seen = []
    scores = hn._scores
    monkeypatch.setattr(hn, "_scores", lambda a, b: seen.append(len(a) * len(b)) or scores(a, b))
    r = np.random.default_rng(1)
    base = r.normal(size=(20, 16))
    x = np.floor(256 * (base[np.arange(20_000) % 20] + 0.05 * r.normal(size=(20_000, 16)))).astype(np.int64)
    a, at = x[:40], hn._unit(base)[0]
    cluster = (hn._unit(a)[0] @ at.T).argmax(axis=1)
    labels = np.arange(20_000) % 3
    got = hn.walk(a, cluster, np.arange(40), labels[:40], x, np.arange(20_000), labels, at, 5)
    assert sum(seen) < 0.2 * 40 * 20_000
    s = a @ x.T
    for g in range(40):
        ok = np.flatnonzero((labels == labels[g]) & (np.arange(20_000) != g))
        want = ok[np.lexsort((ok, -s[g, ok]))[:5]]
        assert [r for m, _, _, r in got if m == g] == want.tolist()
