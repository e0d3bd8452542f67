import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF01
from tokenloom.llm import language_id as li
from tokenloom.llm import toxicity as tx


def held():
    return li.heldout("doc_id", 3, 1)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = tx.score_toxicity(docs, labels, ~held(), held())
    rows = out.join(labels, "doc_id").where("held_out").select("score", "toxic", "predicted").toPandas()
    assert out.count() == docs.count() and rows["score"].between(0, 1).all()
    pos, neg = rows.loc[rows["toxic"] == 1, "score"].to_numpy(), rows.loc[rows["toxic"] == 0, "score"].to_numpy()
    auc = (pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2
    assert auc > 0.9, auc
    assert (rows.loc[rows["toxic"] == 0, "predicted"].mean()) < 0.05


def test_word_facts():
    f = dict(zip(tx.WORD, tx.word_facts("1d10t!!", frozenset()), strict=True))
    assert f["disguised"] and f["exclaimed"] == 2 and not f["seed"]
    assert dict(zip(tx.WORD, tx.word_facts("Stuuupid,", frozenset()), strict=True))["disguised"]
    assert dict(zip(tx.WORD, tx.word_facts("YOU", frozenset()), strict=True))["you"]


def test_isotonic_rises():
    r = np.random.default_rng(1)
    x = r.normal(size=500)
    y = (r.random(500) < 1 / (1 + np.exp(-3 * x))).astype(float)
    at, level = tx.isotonic(x, y)
    assert (np.diff(at) > 0).all() and (np.diff(level) >= 0).all() and level[0] < 0.1 and level[-1] > 0.9


def test_odd_rows(spark):
    rows = [(i, "you are a total idiot " * 3 if i % 3 == 0 else "a quiet walk in the park " * 4, 1) for i in range(120)]
    odd = [(500, None, 2), (501, "", 2), (None, "idiot", 2), (503, "park " * 50000, 2), (503, "park " * 50000, 2)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] * 2 + [(None, 1), (1, None)], "doc_id long, toxic int")
    out = tx.score_toxicity(df, labels, ~held(), held()).collect()
    assert len(out) == len(rows + odd)
    say = {r.doc_id: r.predicted for r in out}
    assert all(say[i] == (i % 3 == 0) for i in range(120)) and say[503] == 0
    none = tx.score_toxicity(df, labels.limit(0), ~held(), held())
    assert none.agg(F.max("score")).first()[0] == 0.0
    assert tx.score_toxicity(df.limit(0), labels, ~held(), held()).count() == 0
