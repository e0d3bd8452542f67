import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF01
from tokenloom.llm import language_id as li


def test_probabilities_sum_to_one():
    texts = ["abra cadabra", "banana band abba", "cab"]
    sym, offs, _ = li.symbols(texts)
    m = li.KneserNey(li.grams(sym, offs))
    seen = np.unique(sym).astype(np.uint64)
    for ctx in ("ana", "abr", "zzz", "  a"):
        c = [0 if x == " " else ord(x) for x in ctx]
        key = np.array([(c[0] << 36) | (c[1] << 24) | (c[2] << 12) | int(s) for s in seen], dtype=np.uint64)
        # one share of the uniform floor is left to unseen characters
        assert 0.5 < m.probability(key, 4).sum() <= 1 + 1e-9


def test_distinct_matches_unique():
    sym, offs, _ = li.symbols(["Hello, wörld!", "", "日本語 abc", "x" * 50])
    key = li.grams(sym, offs)
    keys, back = li._distinct(key)
    assert (keys[back] == key).all() and (np.unique(key, return_inverse=True)[0] == np.sort(keys)).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = li.identify(docs, ~li.heldout(), li.heldout())
    r = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int")), F.min("score"), F.max("score")).first()
    assert out.count() == docs.count()
    assert r[0] > 0.97 and r[1] < 0.02 and 0 <= r[2] <= r[3] <= 1


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat " * 9, "en", 1) for i in range(30)] + [(100 + i, "der hund und die katze " * 9, "de", 1) for i in range(30)]
    odd = [(1000, None, "en", 2), (1001, "12 34!", None, 2), (1002, "", "de", 2), (None, "the mat", None, 2), (1004, "katze " * 60000, None, 2), (1004, "katze " * 60000, None, 2)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    got = sorted(((r.doc_id, r.lang_pred, r.score > 0) for r in li.identify(df, ~li.heldout(), li.heldout()).collect()), key=str)
    assert {(1000, "und", False), (1001, "und", False), (1002, "und", False), (None, "en", True), (1004, "de", True)} <= set(got)
    assert len(got) == len(rows + odd)
    none = li.identify(df.where("score = 2 and lang is null"), ~li.heldout(), li.heldout()).collect()
    assert {r.lang_pred for r in none} == {"und"} and all(r.rejected for r in none)
    assert li.identify(df.limit(0), ~li.heldout(), li.heldout()).count() == 0


def test_rejects_what_no_language_fits(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    r = np.random.default_rng(1)
    junk = [(-1 - i, "".join(r.choice(list("abcdefghijklmnopqrstuvwxyz   "), 300)), None) for i in range(5)] + [(-10, "北京大学是中国的一所大学" * 3, None)]
    out = li.identify(docs.unionByName(spark.createDataFrame(junk, docs.schema)), ~li.heldout(), li.heldout())
    got = {r.doc_id for r in out.where("rejected").collect()}
    assert {j[0] for j in junk} <= got and len(got) <= len(junk) + 2


def test_many_rows_of_a_language(spark):
    """More labelled rows of one language than are sampled, so that only low hashes are ranked."""
    words = {"en": "the cat sat on the mat", "de": "der hund und die katze"}
    df = spark.range(9000).selectExpr("id as doc_id", "if(id % 3 = 0, 'de', 'en') as lang").selectExpr("doc_id", "lang", f"concat(if(lang = 'de', '{words['de']}', '{words['en']}'), ' ', doc_id) as text")
    out = li.identify(df, ~li.heldout(), li.heldout())
    assert out.join(df, "doc_id").where("lang = lang_pred and not rejected").count() == 9000
    (fitted,) = li.fit(df, "doc_id", "text", "lang")
    assert sorted(fitted.value[0]) == ["de", "en"]


def test_groups_of_languages(spark, monkeypatch):
    """Languages learned in groups give what they give in one group; none is left out."""
    scripts = [chr(0x4E00 + 7 * i) for i in range(60)]
    rows = [(100 * i + k, "".join(chr(ord(c) + (j * k) % 5) for j in range(40)), f"l{i:02d}") for i, c in enumerate(scripts) for k in range(6)]
    rows += [(-1, None, None), (-2, "12", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    never = F.lit(False)
    one = sorted(map(str, li.identify(df, F.lit(True), never).collect()))
    monkeypatch.setattr(li, "LANGUAGES", 25)
    assert len(list(li.fit(df, "doc_id", "text", "lang"))) == 3
    assert sorted(map(str, li.identify(df, F.lit(True), never).collect())) == one
    assert len({x.split("lang_pred=")[1].split(",")[0] for x in one}) == 61


def test_memory_of_a_scoring_task():
    """Arrays stay small next to an executor's memory, whatever the batch holds and whatever letters there are."""
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(3)
    letters = [chr(97 + i) for i in range(26)] + [chr(0xE0 + i) for i in range(23)] + [" "] * 6
    texts = ["".join(r.choice(letters, 2000)) for _ in range(2000)]
    sym, offs, _ = li.symbols(texts[:50])

    class Fitted:
        value = ({"xx": li.KneserNey(li.grams(sym, offs))}, {"xx": (3.0, 0.9)})

    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts), pa.array([False] * 2000)], names=["doc_id", "text", "held_out"])
    li._letters()
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in li._predict(Fitted)(iter([batch]))) == 2000
        assert tracemalloc.get_traced_memory()[1] < 80 << 20
    finally:
        tracemalloc.stop()
