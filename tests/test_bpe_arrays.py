"""Byte-pair ids by arrays against the row-per-piece form and Python; a long line runs in bounded groups."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import bpe as BP

MERGES = [("t", "h"), ("th", "e"), ("Ġ", "the"), ("Ã", "©"), ("a", "a"), ("aa", "aa"), ("Ġ", "a")]
LINES = "doc_id long, line_no int, line string, has_newline boolean"


def assets(spark):
    merges = spark.createDataFrame([(i, *m) for i, m in enumerate(MERGES)], "rank int, left string, right string")
    return merges, BP.piece_ids_from_merges(merges)


def test_same_as_rows(spark, monkeypatch):
    r = random.Random(5)
    words = ["the", "é", "aaaa", "aaaaa", "x1", "'s", "  ", "日本", "!?", "\t", "then"]
    rows = [(d, n, " ".join(r.choices(words, k=r.randrange(0, 40))), r.random() < 0.8) for d in range(20) for n in range(3)] + [(99, 0, "", False), (99, 1, "", True)]
    lines = spark.createDataFrame(rows, LINES).repartition(3)
    merges, ids = assets(spark)
    key = ["doc_id", "line_no"]
    want = {(x.doc_id, x.line_no): x.ids for x in BP.encoded_lines(BP.bpe_encode(BP.bpe_pretokens(lines, key), key, merges, ids), key).collect()}
    for size, cached in ((1 << 17, 1 << 18), (5, 2)):
        monkeypatch.setattr(BP, "CHUNK_CHARS", size)
        monkeypatch.setattr(BP, "CACHED_TOKENS", cached)
        enc = BP.bpe_encode_lines(lines, key, merges, ids)
        got, texts = {}, {}
        for x in sorted(enc.collect(), key=lambda x: x.chunk):
            got.setdefault((x.doc_id, x.line_no), []).extend(x.ids)
        assert {k: v for k, v in got.items() if v} == want and len(got) == len(rows)
        for x in sorted(BP.bpe_decode_lines(enc, [*key, "chunk"], ids).collect(), key=lambda x: x.chunk):
            texts[x.doc_id, x.line_no] = texts.get((x.doc_id, x.line_no), "") + x.text
        assert texts == {(d, n): t + "\n" * nl for d, n, t, nl in rows}


def test_tokens_of_many_bytes(spark):
    """Pre-tokens above LONG_TOKEN bytes, between shorter ones and alone."""
    merges, ids = assets(spark)
    rows = [(1, 0, "the " + "a" * 301 + " then " + "日" * 40 + "é x", True), (2, 0, "a" * 99, False), (3, 0, "the", False)]
    lines, key = spark.createDataFrame(rows, LINES).coalesce(1), ["doc_id", "line_no"]
    want = {x.doc_id: x.ids for x in BP.encoded_lines(BP.bpe_encode(BP.bpe_pretokens(lines, key), key, merges, ids), key).collect()}
    assert {x.doc_id: x.ids for x in BP.bpe_encode_lines(lines, key, merges, ids).collect()} == want


def test_merges_and_ids_read_the_written_tokens(spark, monkeypatch):
    """The pre-tokens that bpe_examples writes serve its merges and its ids: lines are matched once, and long ones in chunks give the same merges."""
    from tests.conftest import SF001
    from tokenloom.plans import queries as Q
    Q.clear_corpus_cache()
    want = [tuple(x) for x in Q.q_load_merges(spark, SF001).orderBy("rank").collect()]
    Q.clear_corpus_cache()
    matched, made = [], BP.bpe_pretokenize
    monkeypatch.setattr(BP, "bpe_pretokenize", lambda c: matched.append(c) or made(c))
    monkeypatch.setattr(BP, "CHUNK_CHARS", 40)
    Q.q_bpe_examples(spark, SF001)
    assert [tuple(x) for x in Q.q_load_merges(spark, SF001).orderBy("rank").collect()] == want and len(matched) == 1
    Q.clear_corpus_cache()


def test_decode_malformed_and_unknown(spark):
    _, ids = assets(spark)
    df = spark.createDataFrame([(1, [0xC3, 0x28]), (2, [0xE6, 0x97]), (3, []), (4, None)], "k long, ids array<long>")
    got = {x.k: x.text for x in BP.bpe_decode_lines(df, ["k"], ids).collect()}
    assert got == {1: b"\xc3\x28".decode("utf-8", "replace"), 2: b"\xe6\x97".decode("utf-8", "replace"), 3: "", 4: ""}
    with pytest.raises(Exception):
        BP.bpe_decode_lines(spark.createDataFrame([(1, [99999])], "k long, ids array<long>"), ["k"], ids).collect()
    with pytest.raises(Exception, match="unknown piece"):
        BP.bpe_encode_lines(spark.createDataFrame([(1, 0, "the", False)], LINES), ["doc_id"], assets(spark)[0], ids.where("piece != 'the'")).collect()


def test_long_line(spark):
    """A line of 50 MB: arrays of bounded length, and no exchange in the plan."""
    merges, ids = assets(spark)
    lines = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(0).alias("line_no"), F.expr("repeat('the quick aaaa ', 3400000)").alias("line"), F.lit(False).alias("has_newline"))
    enc = BP.bpe_encode_lines(lines, ["doc_id", "line_no"], merges, ids)
    assert "Exchange" not in enc._jdf.queryExecution().executedPlan().toString()
    n = enc.select(F.size("ids").alias("n")).agg(F.max("n"), F.sum("n"), F.count("*")).first()
    # "the" first, then " the", " quick", " aaaa": 1 + 6 + 2 ids a repeat, and the last blank
    assert n[0] <= BP.CHUNK_CHARS and n[1] == 9 * 3_400_000 + 1 and n[2] > 300


def test_merger_equals_merge_word():
    """Rounds over many words give what each word's own merges give: overlaps, pairs of a rank below that of their parts, words that end early."""
    import numpy as np
    r, chars = random.Random(7), dict(BP.byte_char_table())
    for k in range(60):
        pieces, ranks = list("abc"), {}
        for _ in range(r.choice((0, 1, 6, 25))):
            pair = (r.choice(pieces), r.choice(pieces))
            if pair not in ranks:
                ranks[pair] = len(ranks)
                pieces.append("".join(pair))
        numbers = [*range(len(ranks))]
        r.shuffle(numbers)  # a pair may come before those that make its parts
        ranks = {p: 3 * n for p, n in zip(ranks, numbers, strict=True)}
        words = ["".join(r.choice("aabbc" if k % 2 else "a") for _ in range(r.randrange(1, 30))) for _ in range(50)]
        m = BP.Merger(ranks, chars)
        names = [*m.symbols]
        sym, n = m.merge(np.frombuffer("".join(words).encode(), np.uint8).astype(np.int64), np.array([len(w) for w in words]))
        ends = [0, *np.cumsum(n).tolist()]
        assert [[names[s] for s in sym[a:b]] for a, b in zip(ends, ends[1:])] == [BP.merge_word(w, ranks) for w in words]
