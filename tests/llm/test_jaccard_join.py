import random
import re

import pytest

from tests.conftest import SF001
from tokenloom.llm import jaccard_join as jj


def brute(rows, k=4, percent=85):
    """Components from all pairs of plain Python sets."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * len(a | sets[j]) and root(i) != root(j):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return {(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)}


def got(df):
    return {tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()}


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got(jj.jaccard_components(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("weight", [1 << 20, 600])
def test_near_copies_over_many_blocks(spark, monkeypatch, weight):
    monkeypatch.setattr(jj, "BLOCK_WEIGHT", weight)
    monkeypatch.setattr(jj, "QUERY_WEIGHT", weight)
    r = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"w{r.randrange(400)}" for _ in range(r.randrange(20, 90))]
        for _ in range(r.choice([3, 40])):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"x{r.randrange(99999)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", " \n", None, "a b", "A  b", "a", "b a", "a b c d", "a b c d e"])]
    r.shuffle(rows)
    assert got(jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, "a b c d e", "x"), (1, "a b c d e", "y"), (None, "a b c d e", None), (None, "q r", None), (7, "z " * 30000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    assert sorted(map(str, jj.jaccard_components(df).collect())) == sorted(map(str, spark.createDataFrame(
        [(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (7, 1, 7)], "doc_id long, n_shingles long, component_id long").collect()))
    assert jj.jaccard_components(df.limit(0)).count() == 0


def test_divide_skip():
    import numpy as np
    r = random.Random(1)
    for _ in range(200):
        lists = [np.array(sorted(r.sample(range(30), r.randrange(1, 25)))) for _ in range(r.randrange(1, 9))]
        need = r.randrange(1, 9)
        full = {x: sum(x in s for s in lists) for x in range(30)}
        assert jj.divide_skip(lists, need) == {x: c for x, c in full.items() if c >= need}


def test_questions_by_shuffle_and_by_broadcast(spark, monkeypatch):
    """Small blocks that ask each other: the same components whether places and questions are broadcast or shuffled."""
    r = random.Random(4)
    base = [[f"w{r.randrange(400)}" for _ in range(60)] for _ in range(8)]
    rows = []
    for d in range(90):
        w = list(base[d % 8])
        for _ in range(r.randrange(4)):
            w[r.randrange(60)] = f"x{r.randrange(50)}"
        rows.append((d, " ".join(w)))
    monkeypatch.setattr(jj, "BLOCK_WEIGHT", 300)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jj.jaccard_components(df)) == brute(rows)
    monkeypatch.setattr(jj, "BROADCAST_ROUTES", 0)
    assert got(jj.jaccard_components(df)) == brute(rows)
