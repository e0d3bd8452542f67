import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.conftest import SF001
from tokenloom.llm import divergence as dv

NAMES = "lang, source, part, item, value, rank"


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, count, groups = defaultdict(set), defaultdict(Counter), set()
    for n, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower)):
            held[lang, t].add(n)
            count[lang, source][t] += 1
    kept = defaultdict(list)
    for (lang, t), docs in held.items():
        if len(docs) >= 3:
            kept[lang].append(t)

    def shares(c, terms):
        total = sum(c[t] for t in terms) + len(terms)
        return {t: 1 + 10**9 * (c[t] + 1) // total for t in terms}

    p = {g: shares(count[g], kept[g[0]]) for g in groups}
    out = []
    for lang, source in groups:
        own = p[lang, source]
        pairs = [(-sum((own[t] - p[h][t]) ** 2 // p[h][t] for t in own), h[1].encode()) for h in groups if h[0] == lang and h[1] != source]
        everyone = sum((count[h] for h in groups if h[0] == lang), Counter())
        q = shares(everyone, kept[lang])
        terms = [(-((own[t] - q[t]) ** 2 // q[t]), t.encode()) for t in own if count[lang, source][t] and own[t] > q[t]]
        for part, found in (("pair", pairs), ("term", sorted(terms)[:200])):
            out += [(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found), 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(NAMES.split(", ")).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "text string, lang string, source string, term string, count int, n int")


def random_rows(seed, n=400):
    r = random.Random(seed)
    words = ["".join(r.choice("abéñ語AB") for _ in range(r.choice((1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 70, 140)))) for _ in range(150)]
    words += [w + x for w in words[:60] for x in "aB"]
    return [(" ".join(r.choices(words, k=r.randrange(0, 30))), r.choice(("en", "en", "de", None)), r.choice(("s0", "s0", "s1", "é", None, "s10"))) for _ in range(n)]


@pytest.mark.parametrize("block", [1 << 24, 2000])
def test_against_brute_force(spark, monkeypatch, block):
    """One block a language, and many, so that documents of a term or prefix add up over blocks."""
    monkeypatch.setattr(dv, "BLOCK_BYTES", block)
    rows = random_rows(block)
    assert got(dv.audit(frame(spark, rows).repartition(3))) == brute(rows)


def test_full_bitmap_drops_nothing(spark, monkeypatch):
    """With hardly any bit for the prefixes the last count still decides alone."""
    monkeypatch.setattr(dv, "MOST_BITS", 6)
    monkeypatch.setattr(dv, "PAIRS", 7)
    rows = random_rows(8, 120)
    assert got(dv.audit(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    long = "word" * 50_000
    rows = [(None, "en", "a"), ("", "en", "b"), ("12 _ 3", "fr", "only"), (None, None, None), ("", "", "x"), ("solo text", "es", "c"), ("solo text", "es", "c"), ("other", "es", "d")]
    rows += [("same words Same wordS", "en", "a")] * 4 + [(f"{long} {long}x tail", "en", "c")] * 3 + [(long + "y", "en", "d")] * 2 + [("Éa éa ÉA", "de", s) for s in "aab"]
    assert got(dv.audit(frame(spark, rows))) == brute(rows)
    assert dv.audit(frame(spark, rows).limit(0)).count() == 0
    assert got(dv.audit(frame(spark, rows[:8]))) == brute(rows[:8])


def test_sql(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    assert got(dv.audit(docs)) == want
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    assert sorted(duckdb.sql(f"SELECT {NAMES} FROM ({dv.SQL})").fetchall()) == want


def test_prefix_hashes():
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "x" * 16, "x" * 17, "x" * 32, "x" * 33, "x" * 70, "x" * 69 + "y"]
    t = dv.Terms("en", len(words), "".join(words).encode(), dv._packed(np.array([len(w) for w in words])))
    for size in (4, 8, 16, 32, 64, 128):
        h = t.prefix(np.arange(len(words)), size)
        key = [(w[:size], len(w) <= size) for w in words]
        assert all((h[i] == h[j]) == (key[i] == key[j]) for i in range(len(words)) for j in range(len(words)))
    assert dv.Terms("de", 1, b"a", b"\x01").prefix(np.arange(1), 4)[0] != dv.Terms("en", 1, b"a", b"\x01").prefix(np.arange(1), 4)[0]
