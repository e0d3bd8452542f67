"""Text lines, tokenisation, byte characters and byte-pair encoding against Python."""

from pyspark.sql import functions as F

from tests import model
from tokenloom.functions import text as TX

CASES = ["", "   ", "a  b", "\ta b ", "a\r", "İstanbul ΣΑΣ", "don't DON'T", "naïve 12ab--", "日本語 🙂",
         "x y z", "p\x1cq"]


def _df(spark, vals):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, line string")


def test_tokenize_matches_python(spark):
    df = _df(spark, CASES)
    rows = df.select("i", TX.tokenize(F.col("line")).alias("w"), TX.tokenize(F.col("line"), delimiter="").alias("c"),
                     TX.tokenize(F.col("line"), delimiter=" ").alias("d"), TX.tokenize(F.col("line"), eos=True).alias("e"),
                     TX.tokenize(F.col("line"), double_eos=True).alias("s")).collect()
    for r in rows:
        line = CASES[r["i"]]
        assert r["w"] == line.strip().split(), line
        assert r["c"] == list(line.strip()), line
        assert r["d"] == line.strip().split(" "), line
        assert r["e"] == line.strip().split() + ["<eos>"]
        assert r["s"] == ["<S>"] + line.strip().split() + ["<S>"]


def test_lower_matches_python(spark):
    df = _df(spark, ["İstanbul ΣΑΣ", "ÉCOLE Straße", "DON'T"])
    rows = df.select("i", TX.tokenize(F.col("line"), lower=True).alias("w")).collect()
    vals = ["İstanbul ΣΑΣ", "ÉCOLE Straße", "DON'T"]
    for r in rows:
        assert r["w"] == vals[r["i"]].strip().lower().split()


def test_space_chars(spark):
    rows = _df(spark, ["ab c", "", "日本 x"]).select("i", TX.space_chars(F.col("line")).alias("s")).collect()
    vals = ["ab c", "", "日本 x"]
    for r in rows:
        assert r["s"] == " ".join("_" if c == " " else c for c in vals[r["i"]])


def test_read_lines(spark):
    from tokenloom.sources.text import read_lines
    docs = spark.createDataFrame([(0, "a\n\nb\n", "s"), (1, "a\nb", "s"), (2, "", "s"), (3, "x\r\ny", "s")],
                                 "doc_id bigint, text string, source string")
    got = sorted((r["doc_id"], r["line_no"], r["line"], r["has_newline"]) for r in read_lines(docs).collect())
    assert got == [(0, 0, "a", True), (0, 1, "", True), (0, 2, "b", True), (1, 0, "a", True), (1, 1, "b", False),
                   (3, 0, "x\r", True), (3, 1, "y", False)]
    got = sorted((r["doc_id"], r["line"]) for r in read_lines(docs, universal_newlines=True).filter("doc_id = 3").collect())
    assert got == [(3, "x"), (3, "y")]


def test_byte_chars_bijective(spark):
    table = dict(TX.byte_char_table())
    assert len(set(table.values())) == 256
    vals = CASES + ["".join(chr(c) for c in range(1, 300))]
    rows = _df(spark, vals).select("i", TX.byte_chars(F.col("line")).alias("bc"),
                                   TX.byte_chars_inverse(TX.byte_chars(F.col("line"))).alias("back")).collect()
    for r in rows:
        v = vals[r["i"]]
        assert r["bc"] == "".join(table[b] for b in v.encode("utf-8"))
        assert r["back"] == v


def test_bpe_pretokens_match_regex(spark):
    import regex
    vals = CASES + ["He's  here, isn't he?\n", "a   b\n", "x 123 45.6!!\n"]
    rows = _df(spark, vals).select("i", TX.bpe_pretokenize(F.col("line")).alias("t")).collect()
    pat = regex.compile(TX.BPE_PATTERN.replace(r"\p{L}", r"\p{L}"))
    for r in rows:
        assert r["t"] == pat.findall(vals[r["i"]]), vals[r["i"]]


def test_bpe_encode_decode(spark):
    from tokenloom.operators import bpe as BP
    from tokenloom.sources.text import read_lines
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = read_lines(docs, universal_newlines=True)
    key = ["doc_id", "line_no"]
    toks = BP.bpe_pretokens(lines, key).cache()
    merges = BP.learn_merges(toks, rounds=60, per_round=1).cache()
    ranks = BP.merge_ranks(merges)
    counts = {r["bc"]: r["cnt"] for r in toks.groupBy("token").count().select(TX.byte_chars(F.col("token")).alias("bc"), F.col("count").alias("cnt")).collect()}
    assert [(k, *m) for m, k in sorted(ranks.items(), key=lambda x: x[1])] == model.learn_merges(list(counts), list(counts.values()), 60)
    # pieces equal a second, differently written loop
    d = BP.bpe_pieces(BP.distinct_tokens(toks), merges).limit(400).collect()
    for r in d:
        assert r["pieces"] == model.bpe(r["bc"], ranks)
        assert "".join(r["pieces"]) == r["bc"]
    ids = BP.piece_ids_from_merges(merges).cache()
    enc = BP.encoded_lines(BP.bpe_encode(toks, key, merges, ids), key)
    dec = BP.bpe_decode(enc, key, ids)
    want = BP.line_text(lines).select(*key, F.col("text").alias("want"))
    bad = dec.join(want, key).filter(F.col("text") != F.col("want")).count()
    assert bad == 0
    assert dec.count() == lines.count()
    # merges file and id JSON written and read back
    from tokenloom.sources.text import load_merges, load_piece_ids
    back = {(r["left"], r["right"]): r["rank"] for r in load_merges(BP.merges_file_lines(merges)).collect()}
    assert back == ranks
    ids2 = {r["piece"]: r["id"] for r in load_piece_ids(BP.piece_ids_json(ids)).collect()}
    assert ids2 == {r["piece"]: r["id"] for r in ids.collect()}


def test_merge_word_long_and_random():
    import random
    from tokenloom.operators.bpe import merge_word
    rnd = random.Random(5)
    for _ in range(300):
        parts = ["a", "b", "c"]
        ranks = {}
        for k in range(rnd.randint(1, 25)):
            pair = (rnd.choice(parts), rnd.choice(parts))
            ranks.setdefault(pair, k)
            parts.append("".join(pair))
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 40)))
        assert merge_word(word, ranks) == model.bpe(word, ranks)
    assert merge_word("a" * 200_000, {("a", "a"): 0, ("aa", "aa"): 1})[:2] == ["aaaa", "aaaa"]


def test_bytes_that_are_no_text(spark):
    import random
    from tokenloom.functions.text import byte_char_table, byte_chars_inverse
    rnd = random.Random(9)
    raws = [bytes(rnd.choice([rnd.randrange(256), 0xE2, 0x82, 0xAC, 0x41]) for _ in range(rnd.randrange(12))) for _ in range(400)]
    chars = dict(byte_char_table())
    rows = [(i, "".join(chars[b] for b in r)) for i, r in enumerate(raws)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", byte_chars_inverse(F.col("t")).alias("text"))
    assert {r["i"]: r["text"] for r in df.collect()} == {i: r.decode("utf-8", "replace") for i, r in enumerate(raws)}



def test_byte_chars_of_every_ascii_character(spark):
    from tokenloom.functions.text import byte_char_table, byte_chars
    table = dict(byte_char_table())
    words = [chr(b) for b in range(128)] + ["".join(map(chr, range(128))), "", " aé\x00 b", " plain"]
    got = spark.createDataFrame(list(enumerate(words)), "i int, token string").select("i", byte_chars(F.col("token")).alias("bc")).collect()
    assert {x.i: x.bc for x in got} == {i: "".join(table[b] for b in w.encode()) for i, w in enumerate(words)}


def test_byte_runs(spark):
    """Runs of a key's bytes; rows that share a key, a null one too, are one. The old plan made a row for each byte."""
    from tokenloom.operators import bpe as BP
    rows = [(1, 0, "héllo woréld"), (2, 0, "abcd"), (2, 0, "AB"), (None, 1, "x" * 7), (3, 0, "")]
    lines = spark.createDataFrame(rows, "doc_id long, line_no int, text string")
    df = BP.byte_runs(lines, ["doc_id", "line_no"], 3)
    raw = list(rows[0][2].encode())
    want = {(1, 0, k): raw[3 * k:3 * k + 3] for k in range(-(-len(raw) // 3))} | {(None, 1, k): [120] * n for k, n in enumerate((3, 3, 1))}
    want |= {(2, 0, 0): [65, 97, 66, 98, 99], (2, 0, 1): [100]}
    assert {(x.doc_id, x.line_no, x.run): x.ids for x in df.collect()} == want
    assert df._jdf.queryExecution().executedPlan().toString().count("Generate") == 0
