import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tokenloom.llm import bpe_codec as bc

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as f:
        return Tokenizer.from_file(PATH), bc.Bpe(f.read())


def coded(bpe, text):
    import pyarrow as pa
    from tokenloom.llm import textkernel as tk
    from tokenloom.llm.wordtable import WordTable
    ids, _ = WordTable(bpe.encode).ids(*tk.string_buffers(pa.array([text])))
    return ids.tolist()


def test_random_texts_as_the_library(pair):
    lib, bpe = pair
    r = random.Random(3)
    chars = list("aabcdeehiillmnorssttuvwz 'AEST  \n\t.,!?-0123<|>") + list("éÉüßÑİıΣσς日本語🙂 ́̈ᲀ \x1c\x85ǅﬁ가각ᄀᅠำⅧ²½‍")
    for _ in range(1500):
        text = "".join(r.choice(chars) for _ in range(r.randrange(60)))
        if r.random() < 0.2:
            text = text.replace("a", "<|endoftext|>", 1).replace("e", "<|startoftext|>", 1)
        want = lib.encode(text, add_special_tokens=False).ids
        assert coded(bpe, text) == want, repr(text)
        assert bpe.decode(want) == lib.decode(want, skip_special_tokens=False)


def test_long_pieces(pair):
    lib, bpe = pair
    r = random.Random(4)
    for alphabet in ("a", "ab", "the", "abcdefghijklmnopqrstuvwxyz", "=-"):
        text = "".join(r.choice(alphabet) for _ in range(3000))
        assert coded(bpe, text) == lib.encode(text, add_special_tokens=False).ids
        short = text[:200]
        assert bpe.merge(bpe._symbols(short.encode(), np.array([200])), np.array([200]))[0].tolist() == bpe.merge_long(bpe._symbols(short.encode(), np.array([200]))).tolist()


def digest(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_documents_as_the_library(spark, pair):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {(r.doc_id, *digest(pair[0], r.text)) for r in docs.collect()}
    assert {tuple(r) for r in bc.encode_decode(docs, PATH).collect()} == want


def test_odd_rows(spark, pair):
    rows = [(1, None, 3), (2, "", 3), (None, "a b", 3), (5, "x " * 40000, 3), (5, "x " * 40000, 3), (6, "q" * 70000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bc.encode_decode(df, PATH, with_ids=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(((d, *digest(pair[0], t)) for d, t, _ in rows), key=str)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bc.encode_decode(df.limit(0), PATH).count() == 0
