import re

from pyspark.sql import functions as F

from tests.conftest import SF01
from tokenloom.llm import decontaminate as dc


def brute(docs, items):
    """{(doc, item)} by plain Python, straight from the definition."""
    def words(t):
        return re.findall(r"[^\W_]+", t)

    def canon(ws, names):
        return [dc.NUM if w[0].isdigit() else dc.UNIT if w.lower() in dc.UNITS and i and ws[i - 1][0].isdigit() else dc.NAME if names and w != w.lower() else w.lower() for i, w in enumerate(ws)]

    out = set()
    for names in (False, True):
        index, total, known = {}, {}, {}
        for k, t in items:
            w = words(t)
            c = canon(w, names)
            known[k] = w, c
            for i in range(len(c) - dc.WINDOW + 1):
                win = tuple(c[i:i + dc.WINDOW])
                if sum(x not in (dc.NUM, dc.NAME, dc.UNIT) for x in win) >= dc.LITERALS:
                    index.setdefault(win, []).append((k, i))
                    total[k] = total.get(k, 0) + 1
        for d, t in docs:
            w = words(t or "")
            c = canon(w, names)
            hits = {}
            for p in range(len(c) - dc.WINDOW + 1):
                for k, i in index.get(tuple(c[p:p + dc.WINDOW]), ()):
                    hits.setdefault(k, {}).setdefault(i, p)
            for k, h in hits.items():
                if len(h) < dc.COVERAGE * total[k]:
                    continue
                spots = sorted({(i + x, p + x) for i, p in h.items() for x in range(dc.WINDOW)})
                pairs = [(known[k][0][i].lower(), w[p].lower()) for i, p in spots if known[k][1][i] in (dc.NUM, dc.NAME, dc.UNIT)]
                first = {}
                for a, b in pairs:
                    first.setdefault(a, b)
                if not pairs or sum(first[a] == b for a, b in pairs) >= dc.CONSISTENT * len(pairs):
                    out.add((d, k))
    return out


def got(docs, items):
    return {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}


def test_documents_against_plain_python(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert want and got(docs, items) == want


ITEM = "Tom has 3 apples and buys 12 more at the market before Tom gives 5 kg of pears to Anna who walks 7 miles home"


def test_templates_and_slots(spark):
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "too short to match")], "item_id long, text string")
    swap = ITEM.replace("Tom", "Ben").replace("Anna", "Lucy").replace("12", "40").replace("miles", "km")
    rows = [(1, "x y z " + ITEM + " q"), (2, swap), (3, swap.replace("Ben gives", "Zoe gives", 1).replace("Ben", "Ivo")),
            (4, ITEM.lower()), (5, "Tom has 3 apples and that is all there is to say about it"), (6, None), (7, ""), (1, "x y z " + ITEM + " q"), (None, ITEM), (8, "word " * 30000 + ITEM)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    assert got(df, items) == {(1, 1), (2, 1), (3, 1), (4, 1), (None, 1), (8, 1)}
    # slots that contradict each other everywhere: the frame matches, the values don't
    frame = "the A1 and the A1 with the A1 for the A1 of the A1".replace("A1", "Xx")
    odd = " ".join(["the", "Aa", "and", "the", "Bb", "with", "the", "Cc", "for", "the", "Dd", "of", "the", "Ee"])
    a, b = spark.createDataFrame([(9, frame)], "item_id long, text string"), spark.createDataFrame([(1, odd), (2, frame.replace("Xx", "Yy"))], "doc_id long, text string")
    assert got(b, a) == {(2, 9)}
    assert got(df.limit(0), items) == set() and got(df, items.limit(0)) == set()


def test_repeated_frames_and_variants(spark):
    frames = "The red box in the first room holds 5 balls and the red box in the next room holds 7 balls and the red box in the next room holds 9 balls and the red box in the next room holds 11 balls so how many balls are there"
    swap = frames.replace("5", "50").replace("7", "70").replace("9", "90").replace("11", "30")
    torn = "The red box in the next room holds 1 balls and the red box in the next room holds 2 balls and the red box "
    items = spark.createDataFrame([(1, frames), (2, ITEM)], "item_id long, text string")
    wrong = ITEM.replace("Tom", "Al", 1).replace("before Tom", "before Cy")
    rows = [(1, frames), (2, "some words " + swap), (3, torn * 3 + frames), (None, torn + swap), (4, wrong + " . " + ITEM.replace("12", "40")),
            (5, torn + swap.replace("red box in the next room holds 90", "very red box in the next room holds 90"))]
    got_ = got(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert got_ >= {(1, 1), (2, 1), (3, 1), (None, 1), (4, 2), (5, 1)} and (4, 1) not in got_


def test_short_items_and_scripts_without_blanks(spark):
    texts = ["What is 12 times 7?", "12 7", "day one of 5 and 5 days", "小明有3个苹果他又买了12个苹果一共有几个", "สมชายมีแอปเปิ้ล 3 ผล", "..."]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(1, "so what is 15 times 9 then"), (2, "What is 12 times x"), (3, "12 7"), (4, "13 7"), (5, "3 day one of 6 and 6 days"), (6, "day one of 6 and 8 days"),
            (7, "问题:小明有5个苹果他又买了40个苹果一共有几个?"), (8, "สมชายมีแอปเปิ้ล 8 ผล"), (9, None), (None, "what is 12 times 7"), (10, "")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), items) == {(1, 0), (3, 1), (5, 2), (7, 3), (8, 4), (None, 0)}


def test_pairs_of_words_sieve_places_without_losing_windows(spark):
    """The bitmap of first pairs drops places before they are hashed; every window of an item stays, in both forms."""
    text = "the old Mill by river 12 miles from Town was sold again in spring"
    docs = spark.createDataFrame([(1, f"noise words here {text} and more noise follows it at once"), (2, "nothing of it " * 5)], "doc_id long, text string")
    hashed = dc._hashes(docs.select("doc_id", dc._words(docs.text).alias("words")))
    items = dc._hashes(spark.createDataFrame([(7, text)], "item_id long, text string").select("item_id", dc._words(F.col("text")).alias("words")))
    parts = dc._windows(items)
    pairs = items.select(F.explode(F.array(*[dc._pair(F.get(f"h_{f}", F.lit(i)), F.get(f"h_{f}", F.lit(i + 1))) for f in dc.FORMS for i in range(13 - dc.WINDOW + 2)])).alias("pair"))
    want = {r.h for r in parts.collect()}
    every = {(r.doc_id, r.form, r.pos, r.h) for r in dc._windows(hashed).collect()}
    some = {(r.doc_id, r.form, r.pos, r.h) for r in dc._windows(hashed, None, dc._bitmap(pairs, "pair")).collect()}
    assert {x for x in every if x[3] in want} <= some < every and len(some) < len(every) / 2
    assert {x[3] for x in some} >= want
