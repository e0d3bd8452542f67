import collections
import math
import re

import pyarrow.parquet as pq
import pytest

from tests.conftest import SF001, SF01
from tokenloom.llm import bm25_search as bm
from tokenloom.llm import queries


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, asked, k):
    tfs = [(d, collections.Counter(words(t))) for d, t in docs]
    n, mean = len(tfs), sum(c.total() for _, c in tfs) / max(1, len(tfs)) or 1
    df = collections.Counter(w for _, c in tfs for w in c)
    out = []
    for q, t in asked:
        scored = []
        for d, c in tfs:
            s = sum(m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for w, m in collections.Counter(words(t)).items() if c[w])
            if round(s, 6) > 0:
                scored.append((-round(s, 6), bm.LAST if d is None else d))
        out += [(q, i + 1, None if d == bm.LAST else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return out


def same(got, want):
    got, want = sorted(map(tuple, got), key=str), sorted(want, key=str)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(g[3] == pytest.approx(w[3], abs=2e-6) for g, w in zip(got, want, strict=True))
    assert sum(g[2] != w[2] for g, w in zip(got, want, strict=True)) <= len(want) // 500  # scores that round apart


@pytest.mark.parametrize("size", [8 << 20, 60000])
def test_documents_as_queries(spark, monkeypatch, size):
    monkeypatch.setattr(bm, "SHARD_BYTES", size)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = bm.top_k(bm.build_index(docs), docs.where("doc_id % 20 = 0"), 5, "doc_id").collect()
    same(got, brute(rows, [r for r in rows if r[0] % 20 == 0], 5))


def test_benchmark_query(spark):
    read = lambda t: [tuple(r)[:2] for r in spark.read.parquet(f"{SF01}/{t}.parquet").collect()]
    same(queries.op2_bm25_search(spark, SF01).collect(), brute(read("documents"), [r for r in read("benchmark") if r[0] % 20 == 0], 10))


def test_blocks_of_queries_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bm, "QUERIES", 2)
    docs = [(i, " ".join(f"w{i * j % 17}" for j in range(1, 9 + i % 5))) for i in range(150)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2"), (900, None), (901, ""), (902, "w3 " * 40000)]
    asked = [(1, "w1 w2 w2"), (2, None), (3, ""), (None, "W3"), (5, "nothing here"), (1, "w1 w2 w2"), (6, "w16 w5 w0 w4")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, query long")
    q = spark.createDataFrame(asked, "item_id long, text string")
    index = bm.build_index(d)
    got = bm.top_k(index, q, 7).collect()
    same(got, brute(docs, asked, 7))
    assert {r.doc_id for r in got if r.query_id == 1} >= {7, None}
    assert bm.top_k(index, q.limit(0)).count() == 0 and bm.top_k(bm.build_index(d.limit(0)), q).count() == 0


def test_registered_documents_query(spark):
    assert [q for q in queries.registry() if q.startswith("op2_")][0] == "op2_bm25_documents"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    same(queries.registry()["op2_bm25_documents"](spark, SF001).collect(), brute(rows, [r for r in rows if r[0] % 20 == 0], 10))


def test_copies_are_one_bag(spark, monkeypatch):
    for name, value in (("ROWS", 3), ("PAIRS", 10), ("BLOCK", 4), ("DENSE", 0.3), ("QUERY_BYTES", 200)):
        monkeypatch.setattr(bm, name, value)
    texts = ["the one and the two", "two THE and one the", "only here"] * 60 + [f"the w{i % 23} and w{i * i % 29} w{i}" for i in range(120)]
    docs = [(i * 7 % 311 if i % 50 else None, t) for i, t in enumerate(texts)]
    asked = [(i, t) for i, t in enumerate(texts) if i % 9 == 0] + [(5, "the"), (6, "w1 w1 and"), (7, "the w4 " * 60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index = bm.build_index(d)
    assert [len(r.lengths) // 4 for r in index.collect()] == [122]
    for k in (1, 10, 400):
        same(bm.top_k(index, spark.createDataFrame(asked, "item_id long, text string"), k).collect(), brute(docs, asked, k))


def test_shards_are_bounded_by_rows_and_sent_one_by_one(spark, monkeypatch):
    """Short texts fill a shard by rows, and a worker gets a few shards at a time, not a whole partition of them."""
    monkeypatch.setattr(bm, "SHARD_ROWS", 30)
    monkeypatch.setattr(bm, "BATCH", {k: "1" for k in bm.BATCH})
    docs = [(i, f"w{i % 7} w{i * i % 11} x{i}") for i in range(400)]
    monkeypatch.setattr(bm, "GROUPS", bm.GROUPS | {"parquet.block.size": 1})
    index = bm.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).coalesce(1)
    assert [pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in index.inputFiles()] == [14]
    assert index.count() == 14 and index.selectExpr("max(length(docs) / 8)").first()[0] == 30
    held = spark.sparkContext.accumulator(0)

    def answers(queries, k, mean, made=bm._answers):
        def run(frames):
            def seen():
                for f in frames:
                    held.add(len(f) > 1)
                    yield f

            yield from made(queries, k, mean)(seen())

        return run

    monkeypatch.setattr(bm, "_answers", answers)
    key, before = [*bm.BATCH][0], spark.conf.get([*bm.BATCH][0])
    got = bm.top_k(index, spark.createDataFrame(docs[:9], "item_id long, text string"), 5).collect()
    same(got, brute(docs, docs[:9], 5))
    assert held.value == 0 and spark.conf.get(key) == before
