"""Operator 10, line dedup by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct shingles of ``words`` lower-cased words (1: the words themselves, as the registered query and the
pipeline have it, unless said); a shorter line is one token. A line is removed if an earlier line, by (document id, line number), has
a token set with a Jaccard similarity of ``PERCENT`` or more; the earlier line may itself be removed.

1. Rarity: the words of all texts are counted in ``COUNTERS`` counters. A token's key orders by the class of its first word's
   counter (two classes to a doubling), then by hash, so a line's sorted keys start with the tokens of its rarest words. A token whose counter is 1 is in no other line.
2. Lines with equal sets are one set, standing for its first line; the others are removed.
3. Prefix filter: the first ``n - ceil(0.8 n) + 1`` keys of each set are posted, but those of counter 1. Sets that reach the similarity
   share one of them. Along the postings of each set's first ``PILOT`` keys, in line order, a streaming window pairs each
   set with the first one and with the ``BEFORE`` before it. Pairs must pass the length filter, the positional
   filter and a parity bitmap of the symmetric difference. Each set's nearest partner by bitmap is verified on the full sets.
4. Sets not removed so far meet all earlier postings of their keys, under the same filters, and the pairs are verified. Sets that share a
   run of keys meet where it starts. Most of a large group of near copies is removed in step 3; those that stay meet those that their bitmaps can't tell apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.session import materialize

PERCENT = 80
WORDS = 1
COUNTERS = 1 << 21  # a byte each, in one row of a table
SLOTS = 1 << 10  # rows that the counters are put together from
LAST_ID = (1 << 63) - 1  # stands for a null id: after all others
BROADCAST_LINES = 2_000_000  # (id, line) rows, 12 bytes each, that are broadcast at most; more go through a shuffle
SPACE = r" \t\x0B\f\r\n"
HASH = (1 << 57) - 1
NARROW = 32  # tokens of a set up to which its parity bitmap has 64 bits; 128 beyond
NO_KEY = -1  # stands for the key before a set's first posted one; keys are 0 or more
PILOT = 4  # posted tokens of a set that look for its likeliest partner
BEFORE = 4  # sets before it that each of them looks at, besides the first


def _blank(line: Column) -> Column:
    return F.when(line.rlike(r"[\t\x0B\f\r]"), F.regexp_replace(line, r"[\t\x0B\f\r]", " ")).otherwise(line)


def _words(line: Column) -> Column:
    """The lower-cased words of a line. Splitting at one literal character is several times as fast as at a class of them."""
    return F.array_remove(F.split(F.lower(_blank(line)), " "), "")


def _texts_to_lines(docs: DataFrame) -> DataFrame:
    """(id, line, w): the lower-cased words of each line that has some."""
    lines = docs.select("id", F.posexplode(F.split("text", "\n")).alias("line", "s")).where(F.col("s").rlike(f"[^{SPACE}]"))
    return lines.select("id", "line", _words(F.col("s")).alias("w"))


def _classes(docs: DataFrame) -> DataFrame:
    """One row (v): the counters' classes, an array of bytes: 0 up to a count of 1, then two to a doubling. The byte at p (from 0) is counter p + 1's; counters
    0 and 1 are one. A written table: as a literal, its text would stand in every plan that the driver keeps."""
    words = docs.select(F.explode(F.split(F.lower(F.replace(_blank(F.col("text")), F.lit("\n"), F.lit(" "))), " ")).alias("w")).where("w != ''")
    counts = words.groupBy(F.expr(f"cast(greatest((xxhash64(w) & {COUNTERS - 1}) - 1, 0) as int)").alias("b")).agg(F.count("*").alias("c")).where("c > 1")
    slots = min(SLOTS, COUNTERS)
    width = COUNTERS // slots
    rank = F.expr("cast(least(cast(floor(2 * log2(c)) as int) - 1, 63) as tinyint)")
    known = counts.groupBy(F.expr(f"cast(b div {width} as long)").alias("id")).agg(F.array_sort(F.collect_list(F.struct((F.col("b") % width).alias("o"), rank.alias("r")))).alias("e"))
    gap = lambda x, i: x.o - F.coalesce(F.get("e", i - 1).o, F.lit(-1)) - 1
    none = F.lit(0).cast("tinyint")
    each = F.coalesce(F.flatten(F.transform("e", lambda x, i: F.concat(F.array_repeat(none, gap(x, i)), F.array(x.r)))), F.array().cast("array<tinyint>"))
    rows = docs.sparkSession.range(0, slots, 1, 1).join(known, "id", "left").select("id", each.alias("s"))
    rows = rows.select(F.struct("id", F.concat("s", F.array_repeat(none, F.lit(width) - F.size("s"))).alias("s")).alias("s"))
    rows = rows.groupBy().agg(F.array_sort(F.collect_list("s")).alias("s"))
    return materialize(rows.select(F.flatten(F.transform("s", lambda x: x.s)).alias("v")), "ld-classes")


def _sets(lines: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(id, line, n, keys): keys sorted from the rarest token."""
    def rarity(h: Column) -> Column:
        at = h.bitwiseAND(COUNTERS - 1).cast("int")
        return F.shiftleft(F.get("v", F.greatest(at - 1, F.lit(0))).cast("long"), 57)

    hashed = lines.select("id", "line", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    hashed = hashed.select("*", classes.scalar().alias("v"))  # v has one use below, so it is looked up in place and no line carries it
    if words == 1:
        keys = F.transform(F.array_distinct("h"), lambda h: rarity(h) + F.shiftrightunsigned(h, 7))
    else:
        starts = F.sequence(F.lit(1), F.greatest(F.size("h") - (words - 1), F.lit(1)))
        keys = F.array_distinct(F.transform(starts, lambda i: rarity(F.get("h", i - 1)) + F.shiftrightunsigned(F.xxhash64(F.slice("h", i, words)), 7)))
    return hashed.select("id", "line", F.sort_array(keys).alias("keys")).withColumn("n", F.size("keys"))


def _apart(x: str, y: str) -> str:
    """How far sets x and y are apart at least, by their bitmaps (columns n, sig, sig2). Bitmaps of unequal widths are folded to 64 bits."""
    return (f"if(least({x}.n, {y}.n) > {NARROW}, bit_count({x}.sig ^ {y}.sig) + bit_count({x}.sig2 ^ {y}.sig2),"
            f" bit_count({x}.sig ^ {y}.sig ^ {x}.sig2 ^ {y}.sig2))")


def _near(x: str, y: str) -> str:
    """Bitmap, length and positional filter of postings x and y (columns n, pos, sig, sig2): an intersection of at least PERCENT / (100 + PERCENT) of
    both sizes' sum, and so a symmetric difference of the rest at most."""
    both = f"({x}.n + {y}.n)"
    return (f"{100 + PERCENT} * {_apart(x, y)} <= {100 - PERCENT} * {both}"
            f" and 100 * least({x}.n, {y}.n) >= {PERCENT} * greatest({x}.n, {y}.n)"
            f" and {100 + PERCENT} * (least(abs({x}.pos), abs({y}.pos)) + least({x}.n - abs({x}.pos), {y}.n - abs({y}.pos))) >= {PERCENT} * {both}")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(id, line) of the sets x for which a pair (id, line, yid, yline) reaches the similarity."""
    pairs = materialize(pairs.distinct(), "ld-pairs")
    places = materialize(pairs.select("id", "line").union(pairs.select("yid", "yline")).distinct(), "ld-places")
    held = places.count()
    if not held:
        return pairs.select("id", "line")
    ids = places.select("id").distinct()
    if held <= BROADCAST_LINES:
        ids, places = F.broadcast(ids), F.broadcast(places)
    lines = _texts_to_lines(docs.join(ids, "id", "left_semi")).join(places, ["id", "line"], "left_semi")
    sets = materialize(_sets(lines, classes, words).dropDuplicates(["id", "line", "keys"]), "ld-sets")
    both = (pairs.join(sets, ["id", "line"])
            .join(sets.select(F.col("id").alias("yid"), F.col("line").alias("yline"), F.col("n").alias("m"), F.col("keys").alias("ykeys")), ["yid", "yline"]))
    same = F.size(F.array_intersect("keys", "ykeys"))
    return both.where(100 * same >= PERCENT * (F.col("n") + F.col("m") - same)).select("id", "line").distinct()


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, kept): the numbers, from 0 and sorted, of the kept lines that have words, for ids that keep any.

    A null text has no lines; a null id counts as later than all others. Rows that share an id are one
    document: equal (id, number) are not earlier than each other. Lines without words are never removed. Other columns, whatever their names, aren't read.
    """
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    classes = _classes(docs)
    prefix = F.expr(f"slice(keys, 1, n - cast(ceil(n * {PERCENT} / 100) as int) + 1)")
    shared = F.filter(prefix, lambda k: k > HASH)  # the tokens of counter 1 stand before the others

    def parity(keys: Column) -> Column:
        return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))))

    odd = parity(F.filter("keys", lambda k: k.bitwiseAND(F.lit(64)) > 0))
    sig2 = F.when(F.col("n") > NARROW, odd).otherwise(F.lit(0).cast("long"))
    lines = _sets(_texts_to_lines(docs), classes, words).select("*", parity(F.col("keys")).alias("all"), sig2.alias("sig2"))
    lines = lines.select("id", "line", "n", F.col("all").bitwiseXOR(F.col("sig2")).alias("sig"), "sig2", F.xxhash64("keys").alias("fp"), F.hash("keys").alias("fp2"),
                                                               F.size(prefix).alias("last"), shared.alias("prefix"))
    first = lines.groupBy("fp", "fp2", "n").agg(F.min(F.struct("id", "line", "sig", "sig2", "last", "prefix")).alias("f"))
    first = materialize(first.select("f.id", "f.line", "n", "f.sig", "f.sig2", "f.last", "f.prefix"), "ld-first")

    def postings(sets: DataFrame, sign: Column, tokens: Column) -> DataFrame:
        at = (F.col("pos") + 1 + F.col("last") - F.size("prefix")) * F.col("sign")
        own = ["id", "line", "n", "sig", "sig2"]
        before = F.coalesce(F.get("prefix", F.col("pos") - 1), F.lit(NO_KEY))
        return sets.select(*own, "last", "prefix", sign.alias("sign"), F.posexplode(tokens).alias("pos", "key")).select("key", before.alias("before"), at.alias("pos"), *own)

    w = W.partitionBy("key").orderBy("id", "line")
    me = F.struct("id", "line", "n", "pos", "sig", "sig2")
    ys = [f"y{i}" for i in range(BEFORE + 1)]
    met = (postings(first, F.lit(1), F.slice("prefix", 1, PILOT))
           .select(me.alias("x"), F.first(me).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("y0"), *[F.lag(me, i).over(w).alias(f"y{i}") for i in range(1, BEFORE + 1)])
           .where("y1 is not null").where(" or ".join(f"({_near('x', y)})" for y in ys)).select("x", F.explode(F.array_distinct(F.array(*ys))).alias("y"))
           .where(f"{_near('x', 'y')} and (y.id, y.line) < (x.id, x.line)")
           .select("x.id", "x.line", F.expr(f"{100 + PERCENT} * {_apart('x', 'y')} / (x.n + y.n)").alias("d"), F.col("y.id").alias("yid"), F.col("y.line").alias("yline")))
    best = met.groupBy("id", "line").agg(F.min(F.struct("d", "yid", "yline")).alias("y")).select("id", "line", "y.yid", "y.yline")
    best = materialize(best, "ld-best")
    gone = materialize(_verified(best, docs, classes, words), "ld-gone")
    few = gone.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    marked = first.join((F.broadcast if few else lambda d: d)(gone.withColumn("out", F.lit(True))), ["id", "line"], "left")
    # the sign of a place tells whether its set is out; a condition on both sides, so that one exchange serves them, unfiltered
    dealt = postings(marked, F.when(F.col("out"), -1).otherwise(1), F.col("prefix"))
    still = "x.pos + abs(y.pos) > abs(y.pos)"
    earlier = "(y.id < x.id or y.id = x.id and y.line < x.line)"
    # sets that share the keys before, too, have met there: a run of shared keys counts once, where it starts
    fresh = f"(x.before != y.before or x.before = {NO_KEY})"
    more = dealt.alias("x").join(dealt.alias("y"), F.expr(f"x.key = y.key and {still} and {fresh} and {earlier} and {_near('x', 'y')}"))
    more = more.select("x.id", "x.line", F.col("y.id").alias("yid"), F.col("y.line").alias("yline"))
    more = materialize(more.distinct().join(best, ["id", "line", "yid", "yline"], "left_anti"), "ld-more")
    gone = gone.union(_verified(more, docs, classes, words))
    return first.select("id", "line").join(gone, ["id", "line"], "left_anti").groupBy("id").agg(F.array_sort(F.collect_set("line")).alias("kept"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (lines with words), kept_lines (their numbers), n_removed. A null, empty or wordless text has
    no lines; ids, ties and other columns as in ``kept_lines``; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.split(F.col(text_col).cast("string"), "\n").alias("lines"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.coalesce(F.filter(F.transform("lines", lambda s, i: F.when(s.rlike(f"[^{SPACE}]"), i)), lambda i: i.isNotNull()), F.array().cast("array<int>")).alias("own"))
    rows = rows.join(kept_lines(docs, id_col, text_col, words), "id", "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    kept = F.array_intersect("own", "kept")
    return rows.select("doc_id", F.size("own").alias("n_lines"), kept.alias("kept_lines"), (F.size("own") - F.size(kept)).alias("n_removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with the removed lines cut from its texts, and without the rows that lost all their lines with words.

    A null text, an empty one and one without words stay as they are. Other columns are carried along, whatever their names.
    """
    free = "line_id"
    while any(c.startswith(free) for c in docs.columns):
        free += "_"
    held = f"{free}k"
    kept = kept_lines(docs, id_col, text_col, words).select(F.col("id").alias(free), F.col("kept").alias(held))
    out = docs.withColumn(free, F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))).join(kept, free, "left")
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda s, i: ~s.rlike(f"[^{SPACE}]") | F.array_contains(held, i))
    wordless = ~F.coalesce(F.col(text_col).rlike(f"[^{SPACE}]"), F.lit(False))
    out = out.where(wordless | F.col(held).isNotNull())
    return out.select(*[F.when(wordless, F.col(c)).otherwise(F.array_join(lines, "\n")).alias(c) if c == text_col else F.col(c) for c in docs.columns])
