"""Operator 11, source divergence audit by iceberg prefix refinement.

Terms are maximal runs of letters A-Z, a-z and characters beyond ASCII, A-Z lower-cased. A language keeps the terms that at least ``KEPT``
of its documents hold; a row of the table is a document. They are found by refinement: texts are read once and packed into
blocks (a language's distinct terms of some megabytes of text, their counts by source, and the documents of terms that fewer than
``KEPT`` documents of the block hold). Level by level the blocks' terms are cut to longer byte prefixes; a prefix goes on only if
``KEPT`` distinct documents hold it, as no extension of another can be kept. A bitmap of fixed size carries the prefixes from level to
level: a clash in it lets a prefix through, never drops one, and the last step counts whole terms exactly.

For the kept terms each (lang, source) group is then held against each other source and against its language, all in integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.session import materialize

KEPT = 3
TOP = 200
BLOCK_BYTES = 16 << 20  # of text in a block, about; a longer text is a block of its own
LEVELS = (4, 8, 16, 32)  # bytes of a prefix; doubled from there on while a longer one lives
MOST_BITS = 26  # log2 of the bits of the bitmap, at most: 8 MB
PAIRS = 1 << 20  # pairs of sources that are worked off at a time

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms in order, document of each) of texts as UTF-8 bytes; a text's end ends a term."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    start = np.flatnonzero(first)
    kept = tk._LOWER[data[inside]]
    place = np.flatnonzero(first[inside])
    ends = np.concatenate([place, [len(kept)]]).astype(np.int64)
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())])
    return terms, np.searchsorted(offs, start, side="right") - 1


def _packed(x: np.ndarray) -> bytes:
    top = int(x.max(initial=0))
    return x.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{max(1, len(raw) // max(n, 1))}").astype(np.int64)


BLOCK = "lang string, sources array<string>, n_terms long, terms binary, lens binary, seen binary, docs binary, kinds binary, source binary, count binary"


def _block(rows: pa.RecordBatch) -> pa.RecordBatch:
    """One language's rows, in the order of their sources."""
    sources = rows.column(2).to_pylist()
    names = sorted(set(sources))
    number = {s: i for i, s in enumerate(names)}
    of = np.array([number[s] for s in sources], dtype=np.int64)
    terms, doc = terms_of(*tk.string_buffers(rows.column(0)))
    words = terms.dictionary_encode()
    nd = rows.num_rows
    pair, times = np.unique(words.indices.to_numpy().astype(np.int64) * nd + doc, return_counts=True)
    term, doc = pair // nd, pair % nd
    first = np.flatnonzero(np.diff(term, prepend=-1))
    seen = np.minimum(np.diff(np.append(first, len(term))), KEPT)
    few = np.flatnonzero(seen[term] < KEPT) if len(term) else np.zeros(0, np.int64)
    run = np.flatnonzero(np.diff(term * len(names) + of[doc], prepend=-1)) if len(term) else np.zeros(0, np.int64)
    count = np.add.reduceat(times, run) if len(run) else np.zeros(0, np.int64)
    lens = np.diff(np.frombuffer(words.dictionary.buffers()[1], dtype=np.int64)[:len(words.dictionary) + 1]) if len(words.dictionary) else np.zeros(0, np.int64)
    flat = words.dictionary.buffers()[2].to_pybytes()[:int(lens.sum())] if len(words.dictionary) else b""
    row = [rows.column(1)[0].as_py(), names, len(lens), flat, _packed(lens), _packed(seen), _packed(doc[few]),
           _packed(np.bincount(term[run], minlength=len(lens))), _packed(of[doc[run]]), _packed(count)]
    kinds = [pa.string(), pa.list_(pa.string()), pa.int64()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])


def _blocks(batches):
    for b, _, _ in tk.chunks(batches, chunk_bytes=BLOCK_BYTES):
        order = pc.sort_indices(b, sort_keys=[("lang", "ascending"), ("source", "ascending")])
        b = b.take(order)
        langs = b.column(1).to_pylist()
        cut = [0] + [i for i in range(1, len(langs)) if langs[i] != langs[i - 1]] + [len(langs)]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            yield _block(b.slice(lo, hi - lo))


class Terms:
    """The terms of a block: their bytes, and the hash of any prefix of theirs."""

    def __init__(self, lang: str, n: int, flat: bytes, lens: bytes):
        self.flat, self.lens = flat, _unpacked(lens, n)
        self.start = np.cumsum(self.lens) - self.lens
        raw = np.frombuffer(flat + bytes(8), dtype=np.uint8)
        self.word = np.ndarray((max(len(raw) - 7, 0),), dtype="<u8", buffer=raw, strides=(1,))
        self.seed = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), dtype=np.uint64)

    def prefix(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of the terms ``at``; one that ends there or before has a hash of its own."""
        lens, start = self.lens[at], self.start[at]
        h = np.repeat(self.seed, len(at))
        for k in range(0, min(size, 32), 8):
            more = np.flatnonzero(lens > k)
            rest = np.minimum(np.minimum(lens[more], size) - k, 8)
            word = self.word[start[more] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * rest).astype(np.uint64))
            h[more] = tk.mix(h[more] + np.uint64(k + 1) ^ word)
        if size > 32:
            for i in np.flatnonzero(lens > 32).tolist():  # hardly any term
                cut = self.flat[start[i]:start[i] + min(lens[i], size)]
                h[i] ^= np.frombuffer(hashlib.blake2b(cut, digest_size=8).digest(), dtype=np.uint64)[0]
        return tk.mix(h + (lens <= size).astype(np.uint64))


def _through(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(bits) * 64 - 1)
    return bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1) != 0


def _distinct_documents(h: np.ndarray, seen: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, distinct documents of each up to KEPT, one place of each); ``docs`` has the documents of terms seen in fewer, in order."""
    keys, place, of = np.unique(h, return_index=True, return_inverse=True)
    n = np.zeros(len(keys), dtype=np.int64)
    few = seen < KEPT
    owner = np.repeat(of[few], seen[few])
    pairs = np.unique(owner * (int(docs.max(initial=0)) + 1) + docs) // (int(docs.max(initial=0)) + 1)
    n += np.bincount(pairs, minlength=len(keys))
    n[of[~few]] = KEPT
    return keys, np.minimum(n, KEPT), place


def _rows(batches):
    """Blocks one by one: a batch may hold many."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _level(size: int, before: tuple | None):
    """Prefixes of ``size`` bytes of the terms whose prefix of the level before is alive and not the whole term."""
    def run(batches):
        for r in _rows(batches):
            terms = Terms(r["lang"], r["n_terms"], r["terms"], r["lens"])
            seen = _unpacked(r["seen"], r["n_terms"])
            at = np.arange(len(seen))
            if before is not None:
                at = np.flatnonzero(terms.lens > before[0])
                at = at[_through(before[1].value, terms.prefix(at, before[0]))]
            held = np.where(seen < KEPT, seen, 0)
            docs = _unpacked(r["docs"], int(held.sum()))
            if len(at) < len(seen):
                here = np.zeros(len(seen), dtype=bool)
                here[at] = True
                docs = docs[np.repeat(here, held)]
            h, n, place = _distinct_documents(terms.prefix(at, size), seen[at], docs)
            for lo in range(0, len(h), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(n[part]), pa.array(terms.lens[at[place[part]]] > size)], names=["h", "n", "more"])

    return run


def refine(blocks: DataFrame, bits: int) -> list[tuple]:
    """[(bytes of the prefixes, broadcast bitmap of the living ones)] of all levels, until no living prefix goes on."""
    spark, out, size = blocks.sparkSession, [], 0
    narrow = blocks.select("lang", "n_terms", "terms", "lens", "seen", "docs")
    slot = F.col("h").bitwiseAND((1 << bits) - 1)
    while True:
        size = LEVELS[len(out)] if len(out) < len(LEVELS) else 2 * size
        found = narrow.mapInArrow(_level(size, out[-1] if out else None), "h long, n long, more boolean").groupBy("h").agg(F.sum("n").alias("n"), F.max("more").alias("more"))
        alive = found.where(F.col("n") >= KEPT).groupBy(F.shiftright(slot, 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))).alias("set"), F.max("more").alias("more"))
        rows = alive.toArrow()  # 2^MOST_BITS bits at most
        bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
        bitmap[rows["word"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
        out.append((size, spark.sparkContext.broadcast(bitmap)))
        if not any(rows["more"].to_pylist()):
            return out


def _counts(levels: list[tuple]):
    """Rows (lang, source, term, count, seen) of the terms that live to their end; ``seen`` stands at one row of each term of a block."""
    def run(batches):
        for r in _rows(batches):
            n = r["n_terms"]
            terms, seen, kinds = Terms(r["lang"], n, r["terms"], r["lens"]), _unpacked(r["seen"], r["n_terms"]), _unpacked(r["kinds"], n)
            live, low = np.zeros(n, dtype=bool), 0
            for size, bitmap in levels:
                at = np.flatnonzero((terms.lens > low) & (terms.lens <= size))
                live[at] = _through(bitmap.value, terms.prefix(at, size))
                low = size
            total = int(kinds.sum())
            source, count = _unpacked(r["source"], total), _unpacked(r["count"], total)
            of = np.repeat(np.arange(n), kinds)
            first = np.diff(of, prepend=-1) != 0
            rows = np.flatnonzero(live[of])
            offs = np.concatenate([terms.start, [len(terms.flat)]]).astype(np.int64)
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(terms.flat)])
            names = pa.array(r["sources"], pa.string())
            for lo in range(0, len(rows), 1 << 16):
                at = rows[lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(at), pa.string()), names.take(pa.array(source[at])), text.take(pa.array(of[at])).cast(pa.binary()).cast(pa.string()),
                                                  pa.array(count[at]), pa.array(np.where(first[at], seen[of[at]], 0))], names=["lang", "source", "term", "count", "seen"])

    return run


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """p = 1 + floor(1000000000 * (count + 1) / (N + V)), exactly; null without kept terms."""
    over = (total + kinds).cast("decimal(20,0)")
    n = (count + 1).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.when(kinds > 0, 1 + F.call_function("div", n, over))


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _both(batches):
    """Of each term's sources: f(p, q) less what the sums over the single sources have for the pair, added up by pair."""
    for b in batches:
        sources = b.column(1)
        ends = sources.offsets.to_numpy().astype(np.int64)
        p, p0 = (b.column(i).flatten().to_numpy() for i in (2, 3))
        m = np.diff(ends)
        langs = b.column(0).dictionary_encode()
        names = sources.flatten().dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy().astype(np.int64), m)
        group, code = np.unique(lang * len(names.dictionary) + names.indices.to_numpy(), return_inverse=True)
        width, start = np.repeat(m, m), np.repeat(ends[:-1] - ends[0], m)
        upto = np.cumsum(width)
        keys, sums, lo = [], [], 0
        while lo < len(width):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
            left = np.repeat(np.arange(lo, hi), width[lo:hi])
            right = np.arange(len(left)) - np.repeat(np.cumsum(width[lo:hi]) - width[lo:hi], width[lo:hi]) + start[left]
            left, right = left[left != right], right[left != right]
            a, a0, q, q0 = p[left], p0[left], p[right], p0[right]
            value = (a - q) ** 2 // q - (a - q0) ** 2 // q0 - (a0 - q) ** 2 // q + (a0 - q0) ** 2 // q0
            key = code[left] * len(group) + code[right]
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            if len(first):
                keys.append(key[order][first])
                sums.append(np.add.reduceat(value[order], first))
            lo = hi
        if not keys:
            continue
        key, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, of, np.concatenate(sums))
        one, two = group[key // len(group)], group[key % len(group)]
        word = names.dictionary
        yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(one // len(word))), word.take(pa.array(one % len(word))), word.take(pa.array(two % len(word))), pa.array(total)],
                                         names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: see the contract of op11 in ``queries``.

    A null text, lang or source is ''. A repeated row is a document of its own, as its terms occur again. A group without terms, or a
    language without kept terms, has its pairs with what its counts of 0 give (0 without kept terms). Equal values are ranked by the item's bytes.
    No rows: no result. Other columns are never read; texts of any length are read whole."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    blocks = materialize(rows.mapInArrow(_blocks, BLOCK), "sd-blocks")
    n_terms = blocks.agg(F.sum("n_terms")).first()[0] or 0
    levels = refine(blocks, min(max(16, int(n_terms).bit_length()), MOST_BITS))
    counted = blocks.mapInArrow(_counts(levels), "lang string, source string, term string, count long, seen long").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("seen").alias("seen"))
    term = W.partitionBy("lang", "term")
    counted = counted.withColumn("documents", F.sum("seen").over(term)).withColumn("all", F.sum("count").over(term)).withColumn("first", F.row_number().over(term.orderBy("source")) == 1)
    kept = materialize(counted.where(F.col("documents") >= KEPT).select("lang", "source", "term", "count", "all", "first"), "sd-kept")

    occurring = blocks.select("lang", F.explode("sources").alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("count").alias("n_lang"), F.sum(F.col("first").cast("long")).alias("v"))
    zero = F.lit(0).cast("long")
    groups = occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n", "n_lang", "v"])
    groups = materialize(groups.withColumn("p0", _share(zero, F.col("n"), F.col("v"))), "sd-groups")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v")))
    terms = shares.withColumn("q", _share(F.col("all"), F.col("n_lang"), F.col("v"))).where("p > q").select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))

    # the sum of a pair: as if neither had any term, plus each source's terms against a count of 0, plus the terms of both
    item = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    p0, q0, p, n = F.col("p0"), F.col("q0"), F.col("p"), F.col("k")
    other = F.col("source") != F.col("item")
    neither = groups.join(item, "lang").where(other).select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * _f(p0, q0)).otherwise(zero).alias("value"))
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("k"))
    own = alike.join(item, "lang").where(other)
    mine = own.groupBy("lang", "source", "item").agg(F.sum(n * (_f(p, q0) - _f(p0, q0))).alias("value"))
    theirs = own.groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item")).agg(F.sum(n * (_f(q0, p) - _f(q0, p0))).alias("value"))
    lists = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "p0"))).alias("s")).where("size(s) > 1")
    both = lists.select("lang", F.col("s.source").alias("source"), F.col("s.p").alias("p"), F.col("s.p0").alias("p0")).mapInArrow(_both, "lang string, source string, item string, value long")
    pairs = neither.unionByName(mine).unionByName(theirs).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    by = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(by)).select(out)
    return pairs.unionByName(terms.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= TOP).select(out))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
o AS (SELECT n, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT n) >= 3),
c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, term, CAST(sum(c) AS BIGINT) AS c FROM c GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, CAST(coalesce(sum(c.c), 0) AS HUGEINT) AS n, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v
       FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
ln AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS n, max(v) AS v FROM gn GROUP BY lang),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.c, 0) AS c, CAST(1 + 1000000000 * (coalesce(c.c, 0) + 1)::HUGEINT // (gn.n + gn.v) AS BIGINT) AS p
      FROM gn JOIN kept k ON k.lang = gn.lang LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
pv AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
t AS (SELECT p.lang, p.source, p.term AS item, p.p, CAST(1 + 1000000000 * (l.c + 1)::HUGEINT // (ln.n + ln.v) AS BIGINT) AS q
      FROM p JOIN l ON l.lang = p.lang AND l.term = p.term JOIN ln ON ln.lang = p.lang WHERE p.c > 0),
r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pair LEFT JOIN pv USING (lang, source, item)
      UNION ALL SELECT lang, source, 'term', item, (p - q) * (p - q) // q FROM t WHERE p > q),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM k WHERE part = 'pair' OR rank <= 200"""
