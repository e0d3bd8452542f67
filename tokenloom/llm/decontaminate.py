"""Operator 3, benchmark decontamination by template canonicalisation, in DataFrame functions only.

Words are runs of letters and digits, or single characters of scripts without blanks. A text gets two canonical forms: ``literal`` replaces numbers, and unit
words after a number, by typed placeholders; ``template`` replaces words with a capital too, as names. Windows of
``WINDOW`` canonical words of the benchmark items, with ``LITERALS`` words that aren't placeholders at least, are hash-joined
with all windows of the documents. Along the matched windows the values behind placeholders are compared: within a
document and item, a value of the item must stand for the same value of the document wherever it occurs, or the match is a
chance one of the frame words. A document is contaminated by an item if ``COVERAGE`` of the item's windows
match in one form with ``CONSISTENT`` of its slots agreeing, either with each window at its first place or in one alignment
of item and document (``_alignments``). An item without such a window, as it is short or mostly placeholders, is one window of
its whole length (``_whole``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.session import materialize

WINDOW = 8
LITERALS = 4
COVERAGE = 0.3
CONSISTENT = 0.8
BROADCAST_WINDOWS = 500_000  # item windows (24 bytes each) that are broadcast at most; more are joined by a shuffle
FORMS = ("literal", "template")
SIEVE_HASHES, SIEVE_BITS = 20_000, 16  # up to so many item windows, a bitmap of so many bits for each sorts out the documents' windows in place
BROADCAST_IDS = 2_000_000  # contaminated texts (16 bytes each) that are broadcast at most, to read them again
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
BREAK = r"[^\p{L}\p{M}\p{N}]+"
# scripts written without blanks (Thai to Myanmar, Khmer, Han and kana): each character is a word, with its marks
UNSPACED = r"[\u0E00-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
# fixed values: unit words
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons lb lbs pound pounds ounce ounces ml l liter liters litre "
         "litres second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees").split()


def _words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    each = rf"{BREAK}|(?<={UNSPACED})(?!\p{{M}})|(?=[{UNSPACED}&&[^\p{{M}}]])"
    return F.array_remove(F.when(text.rlike(UNSPACED), F.split(text, each)).otherwise(F.split(text, BREAK)), "")


def _number(w: Column) -> Column:
    return (w >= "0") & (w < ":")


def _forms(words: Column) -> dict[str, Column]:
    """Canonical words of each form, from the words as written."""
    def canon(names: bool):
        def one(w: Column, i: Column) -> Column:
            low = F.lower(w)
            unit = low.isin(UNITS) & F.coalesce(_number(F.get(words, i - 1)), F.lit(False))
            out = F.when(_number(w), NUM).when(unit, UNIT)
            return (out.when(low != w, NAME) if names else out).otherwise(low)
        return F.transform(words, one)

    return {"literal": canon(False), "template": canon(True)}


def _hashes(rows: DataFrame) -> DataFrame:
    """``rows`` with the hashes of the canonical words of both forms in place of ``words``: the same as hashing the
    words of ``_forms``, but each word is lower-cased and hashed once."""
    names = [c for c in rows.columns if c != "words"]
    num, unit, name = (F.xxhash64(F.lit(x)) for x in (NUM, UNIT, NAME))
    # no filter by length here: it would be pushed below and have each text split again for it
    low = rows.select(*names, "words", F.transform("words", lambda w: F.lower(w)).alias("low"))

    def literal(w: Column, i: Column) -> Column:
        return F.when(_number(w), num).when(w.isin(UNITS) & F.coalesce(_number(F.get("low", i - 1)), F.lit(False)), unit).otherwise(F.xxhash64(w))

    def template(w: Column, i: Column) -> Column:
        h = F.get("h_literal", i)
        return F.when((F.get("low", i) == w) | (h == num) | (h == unit), h).otherwise(name)

    low = low.select(*names, "words", "low", F.transform("low", literal).alias("h_literal"))
    return low.select(*names, "h_literal", F.transform("words", template).alias("h_template"))


def _pair(first: Column, second: Column) -> Column:
    return first.bitwiseXOR(F.shiftrightunsigned(second, 1))


def _bitmap(parts: DataFrame, h: str = "h") -> Column | None:
    """Bits of the hashes ``h`` in ``parts`` as a literal array (SIEVE_BITS a hash), or None if there are many."""
    hashes = [r.h for r in parts.select(F.col(h).alias("h")).distinct().limit(SIEVE_HASHES + 1).collect()]
    if len(hashes) > SIEVE_HASHES:
        return None
    words = [0] * max(64, 1 << (max(1, len(hashes)) * SIEVE_BITS // 64).bit_length())
    for h in hashes:
        words[(h >> 6) % len(words)] |= 1 << (h & 63)
    return F.expr("cast(split('" + ",".join(str(w - (1 << 64) if w >> 63 else w) for w in words) + "', ',') as array<bigint>)")


def _hit(sieve: Column, h: Column) -> Column:
    return F.call_function("getbit", F.get(sieve, F.shiftright(h, 6).bitwiseAND(F.size(sieve) - 1).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _windows(hashed: DataFrame, sieve: Column | None = None, pairs: Column | None = None) -> DataFrame:
    """(form, pos, h) for each window of each form, in place of the word hashes (columns h_<form>); with ``sieve`` (``_bitmap``) only those whose bit
    is set, so hardly any window becomes a row, and with ``pairs``, the bitmap of the windows' first two words, only those of places where either form has
    such a pair are hashed at all.

    All of it stands in the generator: a projection before it would be merged with that of the word hashes, and have them worked out again for
    each window. An outer one, as the filter that Spark puts below an inner one would do the same work once more."""
    names = [c for c in hashed.columns if not c.startswith("h_")]
    n = F.size(f"h_{FORMS[0]}")
    one = lambda i: F.array(*[F.struct(F.lit(f).alias("form"), (i - 1).cast("int").alias("pos"), F.xxhash64(F.slice(f"h_{f}", i, WINDOW)).alias("h")) for f in FORMS])
    at = F.sequence(F.lit(1), n - (WINDOW - 1))
    if pairs is not None:
        literal, template = (lambda i, f=f: _hit(pairs, _pair(F.get(f"h_{f}", i - 1), F.get(f"h_{f}", i))) for f in FORMS)
        at = F.filter(at, lambda i: literal(i) | template(i))
    each = F.flatten(F.transform(at, one))
    if sieve is not None:
        each = F.filter(each, lambda x: _hit(sieve, x.h))
    return hashed.select(*names, F.explode_outer(F.when(n >= WINDOW, each)).alias("x")).where("x is not null").select(*names, "x.*")


def _placeholder(w: Column) -> Column:
    return w.isin(NUM, NAME, UNIT)


def _texts(words: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``words`` whose text ``found`` names."""
    ids = found.select("doc_id", "th").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return words.join(ids, words.doc_id.eqNullSafe(ids.doc_id) & (words.th == ids.th), "left_semi")


def _judged(found: DataFrame, words: DataFrame, items: DataFrame) -> DataFrame:
    """``found`` with coverage, n_slots and consistency in place of ``at``: the values behind the placeholders of the matched windows."""
    low = _texts(words, found).select("doc_id", "th", F.transform("words", lambda w: F.lower(w)).alias("dwords")).dropDuplicates(["doc_id", "th"])
    both = found.alias("f").join(low.alias("w"), F.expr("f.doc_id <=> w.doc_id and f.th = w.th")).select("f.*", "w.dwords")
    both = both.join(items.select("item_id", "form", "canon", F.col("words").alias("iwords")), ["item_id", "form"])
    spots = F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda m: F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: F.struct((m.ipos + k).alias("i"), (m.dpos + k).alias("d")))))))
    slots = F.transform(F.filter(spots, lambda s: _placeholder(F.get("canon", s.i))), lambda s: F.struct(F.get("iwords", s.i).alias("i"), F.get("dwords", s.d).alias("d")))
    both = both.withColumn("slots", slots)
    agree = F.size(F.filter("slots", lambda s: F.get(F.filter("slots", lambda t: t.i == s.i), F.lit(0)).d == s.d))
    return both.select("doc_id", "th", "item_id", "form", "n_matched", "n_windows", (F.col("n_matched") / F.col("n_windows")).alias("coverage"), F.size("slots").alias("n_slots"),
                       F.when(F.size("slots") == 0, F.lit(1.0)).otherwise(agree / F.size("slots")).alias("consistency"))


def _alignments(rest: DataFrame, words: DataFrame, parts: DataFrame, items: DataFrame, few: bool) -> DataFrame:
    """One row, as ``found``, per alignment of each match in ``rest`` that covers the item.

    An alignment is an offset (dpos - ipos) of a matched window; each item window stands at its match nearest to the offset,
    no further from it than the item is long, so texts with words put in keep together and repeated frames stay apart."""
    key = ["doc_id", "th", "item_id", "form"]
    at = _windows(_hashes(_texts(words, rest).dropDuplicates(["doc_id", "th"]))).withColumnRenamed("pos", "dpos").join(F.broadcast(parts) if few else parts, ["form", "h"])
    rows = rest.join(items.select("item_id", "form", F.size("canon").alias("long")), ["item_id", "form"])
    at = at.alias("a").join(rows.alias("r"), F.expr("a.doc_id <=> r.doc_id and a.th = r.th and a.item_id = r.item_id and a.form = r.form"))
    at = at.select(*[f"r.{k}" for k in key], "r.n_windows", "r.long", "a.ipos", "a.dpos", F.expr("a.dpos - a.ipos").alias("off"))
    at = materialize(at.withColumn("band", F.floor(F.col("off") / F.col("long"))), "dc-hits")
    offs = at.select(*key, "off", "band").distinct().select(*key, "off", F.explode(F.expr("sequence(band - 1, band + 1)")).alias("band"))
    near = offs.alias("o").join(at.alias("a"), F.expr(" and ".join([f"o.{k} <=> a.{k}" for k in [*key, "band"]] + ["abs(a.off - o.off) <= a.long"])))
    near = near.groupBy(*[f"o.{k}" for k in key], "o.off", "a.n_windows", "a.ipos").agg(F.min(F.expr("struct(abs(a.off - o.off) as far, a.dpos)")).alias("m"))
    near = near.groupBy(*key, "off", "n_windows").agg(F.count("*").alias("n_matched"), F.collect_list(F.struct("ipos", "m.dpos")).alias("at"))
    return near.drop("off").where(F.col("n_matched") >= COVERAGE * F.col("n_windows"))


def _short(items: DataFrame) -> DataFrame:
    """(item_id, form, n, h, canon, iwords): the whole length of items without windows as one.

    The literal form needs one word that isn't a placeholder, the template form half of them; numbers only match as written."""
    solid = F.size(F.filter("canon", lambda w: ~_placeholder(w)))
    lit = F.col("form") == "literal"
    items = items.where(F.size("words") > 0).withColumn("as_is", lit & (solid == 0)).where(lit | (2 * solid >= F.size("canon")))
    items = items.select("item_id", F.when(F.col("as_is"), "verbatim").otherwise(F.col("form")).alias("form"), F.when(F.col("as_is"), F.col("words")).otherwise(F.col("canon")).alias("canon"), F.col("words").alias("iwords"))
    return items.select("item_id", "form", F.size("canon").alias("n"), F.transform("canon", lambda w: F.xxhash64(w)).alias("hs"), "canon", "iwords").withColumn("h", F.xxhash64("hs")).drop("hs")


def _whole(words: DataFrame, short: DataFrame) -> DataFrame:
    """The judged matches of the items in ``short``: every place of a document counts, and all its slots must agree."""
    lengths = sorted(r.n for r in short.select("n").distinct().collect())
    rows = words.withColumn("raw", F.col("words")).withColumn("said", F.transform("words", lambda w: F.lower(w)))
    rows = _hashes(rows).withColumn("h_verbatim", F.transform("said", lambda w: F.xxhash64(w)))
    unit, name = F.xxhash64(F.lit(UNIT)), F.xxhash64(F.lit(NAME))

    def window(form: str, n: int):
        def at(i: Column) -> Column:
            low, own = F.get("said", i - 1), F.get(f"h_{form}", i - 1)
            plain = F.when(low != F.get("raw", i - 1), name).otherwise(F.xxhash64(low)) if form == "template" else F.xxhash64(low)
            first = F.when(own == unit, plain).otherwise(own)  # no number stands before the first word of an item
            h = F.xxhash64(F.concat(F.array(first), F.slice(f"h_{form}", i + 1, n - 1)))
            return F.struct(F.lit(form).alias("form"), F.lit(n).alias("n"), h.alias("h"), F.slice("said", i, n).alias("dwords"))
        return F.transform(F.filter(F.sequence(F.lit(1), F.size("said")), lambda i: i <= F.size("said") - (n - 1)), at)

    each = F.flatten(F.array(*[window(form, n) for form in (*FORMS, "verbatim") for n in lengths]))
    found = rows.select("doc_id", "th", F.explode(each).alias("x")).select("doc_id", "th", "x.*")
    found = found.join(F.broadcast(short) if short.count() <= BROADCAST_WINDOWS else short, ["form", "n", "h"])
    pairs = F.transform("canon", lambda c, k: F.struct(c.alias("c"), F.get("iwords", k).alias("i"), F.get("dwords", k).alias("d")))
    found = found.withColumn("slots", F.filter(pairs, lambda p: _placeholder(p.c)))
    found = found.where(F.forall("slots", lambda p: F.get(F.filter("slots", lambda t: t.i == p.i), F.lit(0)).d == p.d))
    one = F.lit(1).cast("long")
    return found.select("doc_id", "th", "item_id", "form", one.alias("n_matched"), one.alias("n_windows"), F.lit(1.0).alias("coverage"), F.size("slots").alias("n_slots"), F.lit(1.0).alias("consistency"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, form, n_matched, n_windows, coverage, n_slots, consistency.

    Items of equal text are one, named by the least id. An item without words isn't found;
    a null or empty text matches nothing. Repeated rows of a document give one row; a null id
    is a document as any other (all rows with it are told apart by text, and come out with a null id).
    """
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    items = items.groupBy("text").agg(F.min("item_id").alias("item_id")).select("item_id", _words(F.col("text")).alias("words"))
    items = items.select("item_id", "words", *[c.alias(f) for f, c in _forms(F.col("words")).items()])
    items = materialize(items, "dc-forms")
    both = [items.select("item_id", F.lit(f).alias("form"), F.col(f).alias("canon"), F.transform("words", lambda w: F.lower(w)).alias("words")) for f in FORMS]
    parts = _windows(items.select("item_id", *[F.transform(f, lambda w: F.xxhash64(w)).alias(f"h_{f}") for f in FORMS])).withColumnRenamed("pos", "ipos")
    items = materialize(both[0].unionByName(both[1]), "dc-items")
    parts = parts.join(items.drop("words"), ["item_id", "form"])
    parts = parts.where(F.size(F.filter(F.expr(f"slice(canon, ipos + 1, {WINDOW})"), lambda w: ~_placeholder(w))) >= LITERALS)
    parts = parts.withColumn("pair", _pair(F.xxhash64(F.get("canon", "ipos")), F.xxhash64(F.get("canon", F.col("ipos") + 1)))).drop("canon")
    parts = materialize(parts, "dc-windows")
    few = parts.count() <= BROADCAST_WINDOWS
    totals = parts.groupBy("item_id", "form").agg(F.count("*").alias("n_windows"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    words = rows.select("doc_id", F.xxhash64("text").alias("th"), _words(F.col("text")).alias("words"))
    found = _windows(_hashes(words), _bitmap(parts), _bitmap(parts, "pair")).withColumnRenamed("pos", "dpos").join(F.broadcast(parts) if few else parts, ["form", "h"])
    found = found.groupBy("doc_id", "th", "item_id", "form", "ipos").agg(F.min("dpos").alias("dpos"))
    found = (found.groupBy("doc_id", "th", "item_id", "form").agg(F.count("*").alias("n_matched"), F.collect_list(F.struct("ipos", "dpos")).alias("at"))
             .join(F.broadcast(totals) if few else totals, ["item_id", "form"]).where(F.col("n_matched") >= COVERAGE * F.col("n_windows")))
    found = materialize(found, "dc-found")

    first = materialize(_judged(found, words, items), "dc-first")
    rest = first.where(F.col("consistency") < CONSISTENT).select("doc_id", "th", "item_id", "form", "n_windows")
    passed = first.where(F.col("consistency") >= CONSISTENT)
    rest = materialize(rest, "dc-rest")
    if rest.limit(1).count():
        placed = materialize(_alignments(rest, words, parts, items, few), "dc-aligned")
        passed = passed.unionByName(_judged(placed, words, items).where(F.col("consistency") >= CONSISTENT))
    short = materialize(_short(items.join(parts.select("item_id").distinct(), "item_id", "left_anti")), "dc-short")
    if short.limit(1).count():
        passed = passed.unionByName(_whole(words, short))
    best = F.max(F.struct("coverage", "consistency", "form", "n_matched", "n_windows", "n_slots")).alias("b")
    return passed.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.form", "b.n_matched", "b.n_windows", "b.coverage", "b.n_slots", "b.consistency")
