import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tokenloom.llm import token_file as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


def want(rows):
    lib = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [tf.END], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def key(r):
    return r[1]


@pytest.mark.parametrize("limit", [8, 18])
def test_codes_round_trip(limit):
    r = np.random.default_rng(limit)
    for n, size in ((0, 3), (1, 1), (5, 2), (5000, 200), (70000, 256)):
        ids = (r.zipf(1.3, n) % size).astype(np.int64)
        counts = np.bincount(ids, minlength=size)
        lengths = tf.code_lengths(counts, limit)
        used = lengths[lengths > 0].astype(float)
        assert used.max(initial=0) <= limit and (len(used) < 2 or (2.0 ** -used).sum() == 1)
        code = tf.Code(lengths)
        bits, points = code.encode(ids)
        assert (code.decode(bits, points, n) == ids).all()
        k = len(points) // 2  # a block alone, from its checkpoint
        if n:
            part = ids[k * tf.BLOCK:(k + 1) * tf.BLOCK]
            assert (code.decode(bits, points[k:k + 1], len(part)) == part).all()


def test_lengths_are_optimal():
    import heapq
    r = random.Random(6)
    for _ in range(30):
        counts = np.array([r.randrange(1, 1000) for _ in range(r.randrange(2, 40))])
        heap = [(int(c), i, [i]) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
        assert int((tf.code_lengths(counts, 40) * counts).sum()) == cost


def test_documents_as_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = sorted((tuple(r) for r in tf.round_trip(docs, PATH).collect()), key=key)
    assert got == want([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, monkeypatch):
    rows = [(5, "b"), (2, None), (9, ""), (7, "x y " * 20000), (7, "x y " * 20000), (None, "first <|endoftext|>Case"), (3, "q" * 30000), (4, " 　 \x1c ")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    got = sorted((tuple(r) for r in tf.round_trip(df, PATH, with_ids=True).collect()), key=key)
    assert [r[:4] for r in got] == want(rows) and all(len(r[4]) == r[2] for r in got)
    assert tf.round_trip(df.limit(0), PATH).count() == 0


def test_segments_of_null_ids(spark, monkeypatch):
    """Several segments, the first of them with null ids only, in one range of ids."""
    monkeypatch.setattr(tf, "SEGMENT", 6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    text = "one two three four"
    try:
        for parts in ("1", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = [(None, text), (None, text), (None, text + " five"), (1, text), (2, text), (2, text)]
            got = sorted((tuple(r) for r in tf.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()), key=key)
            assert [r[:2] for r in got] == [r[:2] for r in want(rows)] and sorted(r[3] for r in got) == sorted(r[3] for r in want(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pieces_go_to_the_library_once():
    """Words of Latin characters share their pieces; others, special tokens and odd characters go whole."""
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    lib, bpe = Tokenizer.from_str(spec), tf.Bpe(spec)
    words = ["Word,", "word.", "WORD", "don't", "'s's", "a1b22", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>,", "Été,", "été", "İstanbul.", "ŞIŞ!", "ΣΑΣ", "日本語,", "éa", "½kg²", "a­b", "ǅ-Ⱥ", "«où»", "ªµ"]
    encode = tf.library_encoder(spec)
    for some in (words, words[::-1] + ["word!", "new"]):
        ids, n = encode(some)
        want = [lib.encode(w, add_special_tokens=False).ids for w in some]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    calls = []
    bpe.split = lambda w: calls.append(w) or [w]
    assert bpe.pieces("Été") == ["été".encode()] and not calls


def test_pieces_pass_the_normaliser(monkeypatch):
    """Texts of pieces alone aren't normalised again; ids stay those of the library, and a word's pieces are counted once."""
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    lib, counted, own = Tokenizer.from_str(spec), [], tf.Bpe.pieces
    monkeypatch.setattr(tf.Bpe, "pieces", lambda bpe, w: counted.append(w) or own(bpe, w))
    words = [f"{a}{b}" for a in ("Word", "ÉTÉ", "x1", "ⱥⱥ", "日本", "éa", "Ⱥb", "Å") for b in ("", ".", "'s", "<", "12", "ß")] + [f"W{i}" for i in range(600)]
    encode = tf.library_encoder(spec)
    for some in (words, words[::-1]):
        ids, n = encode(some)
        want = [lib.encode(w, add_special_tokens=False).ids for w in some]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(counted) == len(set(counted)) and not any(w.isascii() and "<" not in w for w in counted)
    monkeypatch.setattr(tf, "JOINED", 1)
    calls = []

    class Seen:
        def __init__(self, lib):
            self.__dict__["lib"] = lib

        def __getattr__(self, name):
            return getattr(self.lib, name)

        def __setattr__(self, name, value):
            setattr(self.lib, name, value)

        def encode_batch_fast(self, texts, **more):
            calls.extend((t, self.lib.normalizer is None) for t in texts)
            return self.lib.encode_batch_fast(texts, **more)

    monkeypatch.setattr("tokenizers.Tokenizer.from_str", lambda s: Seen(lib), raising=False)
    tf.library_encoder(spec)(["Plain", "日本."])
    assert calls == [("plain", True), ("日本.", False)]
