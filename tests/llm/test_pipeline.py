import re

import corpus_pipeline as cp
from tests.conftest import SF001
from tests.llm import test_bpe_codec, test_decontaminate, test_jaccard_join, test_line_dedup
from tokenizers import Tokenizer
from tokenloom.llm import language_id as li
from tokenloom.llm import line_dedup as ld

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rejected = {r.doc_id for r in li.identify(docs, ~li.heldout(), li.heldout()).where("rejected").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rejected) <= 2 and all(t is None or not re.search(r"[^\W\d_]", t) or d in rejected for d, t in rows if d in rejected)
    rows = [r for r in rows if r[0] not in rejected]
    kept = test_line_dedup.brute(rows)
    cut = []
    for d, t in rows:
        lines = t.split("\n")
        words = [bool(re.search(f"[^{ld.SPACE}]", s)) for s in lines]
        if not any(words) or any((d, i) in kept for i in range(len(lines))):
            cut.append((d, "\n".join(s for i, s in enumerate(lines) if not words[i] or (d, i) in kept) if any(words) else t))
    same = {d: c for d, _, c in test_jaccard_join.brute(cut)}
    one = [(d, t) for d, t in cut if same[d] == d]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    hit = {d for d, _ in test_decontaminate.brute(one, items)}
    lib = Tokenizer.from_file(test_bpe_codec.PATH)
    want = {(d, *test_bpe_codec.digest(lib, t)) for d, t in one if d not in hit}
    out = cp.run(spark, SF001)
    assert {tuple(r)[:4] for r in out.collect()} == want and hit
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_stages_keep_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the quick brown fox jumps over the lazy dog and runs away "
    rows = [(1, text + "one", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "12 34", "en", "b", 5), (5, text + "one", "en", "c", 1),
            (5, text + "one", "en", "c", 1), (None, "a text without an id but with some words in it", "en", None, None), (6, text * 3000, "en", "a", 9)]
    docs = spark.createDataFrame(rows, schema)
    for data in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            data = stage(spark, data, SF001)
            assert data.columns == COLUMNS
        left = {r.doc_id for r in cp.STAGES[-1][1](spark, data, SF001).collect()}
        # 6 repeats the 11 words that row 1 has beside "one": a similarity of 11/12, so its only line goes
        assert left in ({1, None}, set())


def test_rows_not_ids(spark):
    """Of rows that share an id, or have none, each goes or stays by its own text; one row of each group stays."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key int"
    item = next(r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect())
    clean = "a plain text about rivers and hills that nobody has copied from any list of questions so far"
    other = "quite another story of ships at sea and of the weather that they met on the way to the north"
    rows = [(1, clean, "en", "a", 1, 0), (1, item, "en", "b", 1, 1), (None, item, "en", "c", 1, 2), (None, other, "en", "d", 1, 3)]
    docs = spark.createDataFrame(rows, schema)
    assert {r.row_key for r in cp.decontamination(spark, docs, SF001).collect()} == {0, 3}

    twins = [(7, clean, "en", "x", 1, 0), (5, clean, "en", "x", 1, 1), (5, clean, "en", "a", 1, 2), (5, other, "en", "a", 1, 3), (None, other, "en", "a", 1, 4), (None, "", "en", "a", 1, 5),
             (None, "", "en", "a", 1, 6), (9, None, "en", "a", 1, 7), (None, "nothing like it anywhere else in all of this small table", "en", "a", 1, 8)]
    left = {r.row_key for r in cp.jaccard(spark, spark.createDataFrame(twins, schema), SF001).collect()}
    assert left == {2, 3, 5, 6, 7, 8}

    plain = [(i, clean + f" number {i}", "en", "a", 1, i) for i in range(40)]
    odd = [(1, "12 34", "en", "a", 1, 100), (None, "", None, None, None, 101)]
    out = cp.language(spark, spark.createDataFrame(plain + odd, schema), SF001)
    assert {r.row_key for r in out.collect()} == set(range(40)) and out.columns[-1] == "row_key"
