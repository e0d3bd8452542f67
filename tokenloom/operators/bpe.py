"""Byte-pair encoding as DataFrame jobs.

Lines (with their newline) -> pre-tokens (regex, JVM) -> printable byte characters (JVM) ->
distinct pre-tokens -> merged pieces (``mapInPandas``, the one Python loop, bounded by the
number of *distinct* pre-tokens) -> joined back -> piece ids -> ordered ids per line.
Decoding joins ids to pieces, concatenates in order and maps characters back to bytes (JVM).
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import bpe_pretokenize, byte_char_table, byte_chars, byte_chars_hex
from tokenloom.operators.joins import lookup_join


def line_text(lines: DataFrame) -> DataFrame:
    """The text a byte-pair encoder sees for a line: the line plus its newline when it has one."""
    return lines.withColumn("text", F.when(F.col("has_newline"), F.concat(F.col("line"), F.lit("\n"))).otherwise(F.col("line")))


def bpe_pretokens(lines: DataFrame, key_cols: list[str]) -> DataFrame:
    """(key, tok_no, token) for every pre-token of every line."""
    return line_text(lines).select(*key_cols, F.posexplode(bpe_pretokenize(F.col("text"))).alias("tok_no", "token"))


def distinct_tokens(toks: DataFrame) -> DataFrame:
    """Distinct pre-tokens with their byte characters (P7 once per distinct token)."""
    return toks.select("token").distinct().withColumn("bc", byte_chars(F.col("token")))


def merge_word(word: str, ranks: dict) -> list[str]:
    """P8 on one pre-token: the lowest-ranked pair is joined wherever it occurs, left to right, until no
    ranked pair is left. A heap holds (rank, place) over a linked list of the parts, so a long
    unbroken run costs n log n; pairs made by a step wait until that step is through."""
    parts: list = list(word)
    after, before = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
    heapq.heapify(heap)
    while heap:
        rank, made = heap[0][0], []
        while heap and heap[0][0] == rank:
            i = heapq.heappop(heap)[1]
            j = after[i]
            if parts[i] is None or j < 0 or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            made += [before[i], i]
        for i in made:
            if i >= 0 and parts[i] is not None and after[i] >= 0 and (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(heap, (r, i))
    return [p for p in parts if p is not None]


LONG_TOKEN = 64  # bytes of a pre-token that is merged with others in rounds; a longer one has ``merge_word``
NONE = 1 << 40  # rank of a pair that isn't merged


class Merger:
    """P8 on many pre-tokens at once, ``merge_word`` in rounds of arrays: each joins the lowest-ranked pair of every word wherever it occurs, left to
    right. A symbol is a piece; those of the 256 bytes come first."""

    def __init__(self, ranks: dict, chars: dict):
        self.symbols = {chars[b]: b for b in range(256)}
        pairs = sorted((r, self._symbol(a), self._symbol(b), self._symbol(a + b)) for (a, b), r in ranks.items())
        rank, left, right, made = np.array(pairs, np.int64).reshape(-1, 4).T
        order = np.lexsort((right, left))
        self.keys, self.place = (left << 32 | right)[order], order  # a pair's place among the merges serves as its rank
        self.made = made

    def _symbol(self, piece: str) -> int:
        return self.symbols.setdefault(piece, len(self.symbols))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.place[at], NONE)

    def merge(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of ``size`` byte symbols, none empty: (symbols of the pieces, number of pieces of each word)."""
        word, done = np.repeat(np.arange(len(size)), size), []
        rank, inner = np.full(len(sym), NONE), np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        while len(sym):
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, head)
            best = np.repeat(best, np.diff(np.append(head, len(sym))))
            live = best < NONE
            if not live.all():
                done.append((word[~live], sym[~live]))
                word, sym, rank, best = word[live], sym[live], rank[live], best[live]
            at = np.flatnonzero(rank == best)
            if not len(at):
                break
            run = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))  # of pairs that overlap, every other one is joined
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            word, sym, rank = word[keep], sym[keep], rank[keep]
            rank[at] = NONE
            for i in (at[at > 0] - 1, at[at + 1 < len(sym)]):
                i = i[word[i] == word[i + 1]]
                rank[i] = self.rank(sym[i], sym[i + 1])
        word, sym = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 2
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(size))


def merge_ranks(merges: DataFrame) -> dict:
    """The merges table as a (left, right) -> rank dict. Its size is the merges file's line
    count (a fixed vocabulary asset), so it is shipped to the tasks with the function."""
    return {(r["left"], r["right"]): int(r["rank"]) for r in merges.select("rank", "left", "right").collect()}


def bpe_pieces(distinct: DataFrame, merges: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Adds ``pieces`` ARRAY<STRING> to each distinct pre-token (column ``bc``).

    The merge loop is CPU work on few bytes, so the distinct table is spread over a fixed
    number of partitions first (byte-size-based coalescing would leave one Python worker)."""
    ranks = merge_ranks(merges)
    cols = distinct.columns
    n = parallelism or int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            pdf["pieces"] = [merge_word(w, ranks) for w in pdf["bc"]]
            yield pdf

    schema = ", ".join(f"{c} string" for c in cols) + ", pieces array<string>"
    return distinct.repartition(n).mapInPandas(run, schema)


def piece_ids_from_merges(merges: DataFrame) -> DataFrame:
    """Id map for a merges table: the 256 byte characters in byte order, then each merge's
    result in rank order (first occurrence wins)."""
    spark = merges.sparkSession
    base = spark.createDataFrame([(ch, b) for b, ch in byte_char_table()], "piece string, id bigint")
    merged = merges.select(F.concat("left", "right").alias("piece"), "rank").groupBy("piece").agg(F.min("rank").alias("rank"))
    merged = merged.join(base.select("piece"), "piece", "left_anti")
    from tokenloom.operators.positions import ordered_index
    merged = ordered_index(merged, [], [F.col("rank")], F.expr(f"rank div {1 << 16}"), "idx")
    return base.unionByName(merged.select("piece", (F.col("idx") + 256).alias("id")))


BROADCAST_TOKENS = 200_000  # of a few dozen bytes each
HOT_TOKENS = 1000


def bpe_encode(toks: DataFrame, key_cols: list[str], merges: DataFrame, piece_ids: DataFrame) -> DataFrame:
    """P9 + J4: pre-tokens (``bpe_pretokens``; callers materialise them, they are read twice) ->
    one row per piece: (key, tok_no, piece_no, piece, id). An unknown piece raises.
    The distinct pre-token table is merged once, written and joined back: by broadcast up to
    ``BROADCAST_TOKENS`` rows; beyond, the ``HOT_TOKENS`` most common by broadcast and the rest, without
    hot keys, by a shuffle. The piece id map is bounded by the merges file and broadcast."""
    from tokenloom.session import materialize
    pieces = materialize(bpe_pieces(distinct_tokens(toks), merges).select("token", "pieces"), "bpe-pieces")
    j = lookup_join(toks, pieces, "token", broadcast_rows=BROADCAST_TOKENS, hot_keys=HOT_TOKENS)
    j = j.select(*key_cols, "tok_no", F.posexplode("pieces").alias("piece_no", "piece"))
    ids = F.broadcast(piece_ids.select(F.col("piece").alias("_p"), "id"))
    j = j.join(ids, j["piece"] == ids["_p"], "left").drop("_p")
    return j.withColumn("id", F.when(F.col("id").isNull(), F.raise_error(F.concat(F.lit("unknown piece: "), F.col("piece"))))
                        .otherwise(F.col("id")))


CHUNK_CHARS = 1 << 17  # of a line that are taken together, about
CACHED_TOKENS = 1 << 18  # pre-tokens whose ids a worker remembers
RUN_ROWS = 256  # lines whose bytes are cut at a time


def bpe_line_tokens(lines: DataFrame, key_cols: list[str]) -> DataFrame:
    """P6 by arrays: (key, chunk, tokens), one row for each ``CHUNK_CHARS`` characters of a line, ``chunk`` numbering them.

    A long line is cut before it is matched, in front of a blank that follows another character: no pre-token goes over such a place, so the cut
    changes none (a run without blanks stays whole)."""
    cuts = F.regexp_extract_all("text", F.lit(f"(?sU).{{1,{CHUNK_CHARS}}}\\s*\\S*"), 0)
    t = line_text(lines).select(*key_cols, F.posexplode(F.when(F.length("text") <= CHUNK_CHARS, F.array("text")).otherwise(cuts)).alias("chunk", "_text"))
    return t.select(*key_cols, "chunk", bpe_pretokenize(F.col("_text")).alias("tokens"))


def bpe_encode_lines(lines: DataFrame, key_cols: list[str], merges: DataFrame, piece_ids: DataFrame) -> DataFrame:
    """P6-P9 + J4 by arrays: (key, chunk, ids) of the chunks of ``bpe_line_tokens``."""
    return bpe_encode_tokens(bpe_line_tokens(lines, key_cols), [*key_cols, "chunk"], merges, piece_ids)


def bpe_encode_tokens(t: DataFrame, kept: list[str], merges: DataFrame, piece_ids: DataFrame) -> DataFrame:
    """P7-P9 + J4 on arrays of pre-tokens: (``kept`` columns, ids).

    A batch's pre-tokens are numbered once, each distinct one is merged (or remembered by the worker) and the lines' arrays are put together
    from the distinct ones by offsets: no row per pre-token or piece, no shuffle, and no group as long as a line. What goes to the tasks is bounded by
    the merges file. An unknown piece raises; a line without text has one empty array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    spark = t.sparkSession
    shared = spark.sparkContext.broadcast((merge_ranks(merges), {r["piece"]: int(r["id"]) for r in piece_ids.select("piece", "id").collect()}, dict(byte_char_table())))
    t = t.select(*kept, "tokens")
    schema = ", ".join(f"`{c}` {t.schema[c].dataType.simpleString()}" for c in kept) + ", ids array<bigint>"

    def run(batches):
        ranks, numbers, chars = shared.value
        merger = Merger(ranks, chars)
        ids_of = np.array([numbers.get(p, -1) for p in merger.symbols], np.int64)
        none = np.zeros(0, np.int64)
        known, flat, size = {}, none, none  # token -> number; ids of all by number, and how many each has

        def encode(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """(ids of all tokens, number of ids of each)."""
            raw = [t.encode() for t in tokens]
            long = np.fromiter(map(len, raw), np.int64, len(raw)) > LONG_TOKEN
            short = [x for x in raw if len(x) <= LONG_TOKEN]
            sym, n = merger.merge(np.frombuffer(b"".join(short), np.uint8).astype(np.int64), np.fromiter(map(len, short), np.int64, len(short)))
            ids = ids_of[sym]
            if (ids < 0).any():
                raise ValueError(f"unknown piece: {[*merger.symbols][sym[np.argmin(ids)]]}")
            if not long.any():
                return ids, n
            try:
                each = [[numbers[p] for p in merge_word("".join(map(chars.__getitem__, raw[i])), ranks)] for i in np.flatnonzero(long)]
            except KeyError as e:
                raise ValueError(f"unknown piece: {e.args[0]}") from None
            count = np.zeros(len(raw), np.int64)
            count[long], count[~long] = [len(x) for x in each], n
            of_long = np.repeat(long, count)
            out = np.zeros(len(of_long), np.int64)
            out[of_long], out[~of_long] = np.concatenate(each), ids
            return out, count

        for b in batches:
            col = b.column(len(kept))
            words = col.flatten().dictionary_encode()
            distinct = words.dictionary.to_pylist()
            new = [t for t in distinct if t not in known]
            if len(known) + len(new) > CACHED_TOKENS:
                known, flat, size, new = {}, none, none, distinct
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                flat, size = (np.concatenate(x) for x in zip((flat, size), encode(new), strict=True))
            at = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
            of = at[words.indices.to_numpy()] if len(at) else none
            n = size[of]
            ends = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.arange(ends[-1]) - np.repeat(ends[:-1] - (np.cumsum(size) - size)[of], n)]
            cut = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy())])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], pa.ListArray.from_arrays(pa.array(ends[cut], pa.int32()), pa.array(ids))], names=[*kept, "ids"])

    return t.mapInArrow(run, schema)


def bpe_decode_lines(encoded: DataFrame, key_cols: list[str], piece_ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """P10 by arrays: (key, text), each array's bytes put together in place; malformed bytes are replaced, an id that the (bounded) id map lacks raises.
    Pre-tokens are whole characters, so the chunks of a line made by ``bpe_encode_lines`` decode one by one."""
    import pyarrow as pa

    back = {ch: b for b, ch in byte_char_table()}
    table = encoded.sparkSession.sparkContext.broadcast({int(r["id"]): bytes(map(back.__getitem__, r["piece"])) for r in piece_ids.select("piece", "id").collect()})
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in key_cols) + ", text string"

    def run(batches):
        part = table.value
        for b in batches:
            texts = [b"".join(map(part.__getitem__, x or [])).decode("utf-8", "replace") for x in b.column(len(key_cols)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(key_cols)], pa.array(texts, pa.string())], names=[*key_cols, "text"])

    return encoded.select(*key_cols, ids_col).mapInArrow(run, schema)


def byte_runs(lines: DataFrame, key_cols: list[str], length: int) -> DataFrame:
    """(key, run, ids): the byte values of each key's ``text``, the first 256 piece ids, in runs of ``length``; no row for an empty text.

    Lines move once, whole; their bytes are cut in Arrow batches. Rows that share a key are one: at each place the bytes of all of them, in order."""
    import numpy as np
    import pyarrow as pa

    schema = ", ".join(f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in key_cols) + ", run bigint, ids array<bigint>"
    held = lines.repartition(*key_cols).groupBy(*key_cols).agg(F.collect_list("text").alias("_texts"))

    def places(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, place of each) of a key's texts."""
        each = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        if len(each) == 1:
            return each[0], np.arange(len(each[0]))
        values, at = np.concatenate(each), np.concatenate([np.arange(len(x)) for x in each])
        order = np.lexsort((values, at))
        return values[order], at[order]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, RUN_ROWS):
                part = b.slice(lo, RUN_ROWS)
                values, at = zip(*map(places, part.column(len(key_cols)).to_pylist()))
                row = np.repeat(np.arange(len(values)), [len(v) for v in values])
                values, k = np.concatenate(values), np.concatenate(at) // length
                head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (k[1:] != k[:-1])])) if len(values) else np.zeros(0, np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.append(head, len(values)), pa.int32()), pa.array(values.astype(np.int64)))
                of = pa.array(row[head])
                yield pa.RecordBatch.from_arrays([*[c.take(of) for c in part.columns[:len(key_cols)]], pa.array(k[head], pa.int64()), ids], names=[*key_cols, "run", "ids"])

    return held.mapInArrow(run, schema)


def encoded_lines(pieces: DataFrame, key_cols: list[str]) -> DataFrame:
    """Per line: ids ARRAY<BIGINT> in (tok_no, piece_no) order."""
    g = pieces.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct("tok_no", "piece_no", "id"))).alias("_t"))
    return g.select(*key_cols, F.transform("_t", lambda x: x["id"]).alias("ids"))


def bpe_decode(encoded: DataFrame, key_cols: list[str], piece_ids: DataFrame) -> DataFrame:
    """P10: ids -> pieces -> bytes -> UTF-8 text (bad bytes replaced). Each piece's bytes are
    worked out once on the (bounded, broadcast) piece table, not per token."""
    e = encoded.select(*key_cols, F.posexplode("ids").alias("k", "id"))
    m = F.broadcast(piece_ids.select(F.col("id").alias("_id"), byte_chars_hex(F.col("piece")).alias("hx")))
    j = e.join(m, e["id"] == m["_id"], "left")
    g = j.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct("k", "hx"))).alias("_t"))
    return g.select(*key_cols, F.make_valid_utf8(F.unhex(F.array_join(F.transform("_t", lambda x: x["hx"]), "")).cast("string")).alias("text"))


# ---------------------------------------------------------------------------------------------
# Fixture: no merges file is shipped and there is no network, so a small set of merges is
# learned from all pre-tokens of the given table. This stands in for the merges
# asset the encoder downloads; it is not one of the encoder's own operators.
# ---------------------------------------------------------------------------------------------

OPEN, CLOSE = "\ue000", "\ue001"  # around each piece of a word; no byte character is one of them
ROUNDS, PER_ROUND = 6, 10


def learn_merges(toks: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> DataFrame:
    """merges(rank, left, right) learned from every distinct pre-token, weighted by its count.

    Each round counts the adjacent pairs of all words in one aggregation and takes the ``per_round`` most
    common new ones (ties: the smaller pair); they are applied to the words in that order. Only those
    rows reach the driver."""
    from tokenloom.session import materialize
    words = toks.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    marked = F.concat(F.lit(OPEN), F.array_join(F.split(byte_chars(F.col("token")), ""), CLOSE + OPEN), F.lit(CLOSE))
    words = materialize(words.where("token != ''").select("cnt", marked.alias("s")), "bpe-words")
    merges: list[tuple[str, str]] = []
    for k in range(rounds):
        parts = F.split(F.regexp_replace("s", f"^{OPEN}|{CLOSE}$", ""), CLOSE + OPEN)
        pairs = words.select("cnt", parts.alias("x")).select("cnt", F.explode(F.transform(
            F.filter("x", lambda _, i: i > 0), lambda y, i: F.struct(F.get("x", i).alias("left"), y.alias("right")))).alias("p"))
        top = pairs.groupBy("p.left", "p.right").agg(F.sum("cnt").alias("n")).orderBy(F.col("n").desc(), "left", "right").limit(per_round + len(merges)).collect()
        new = [p for r in top if (p := (r["left"], r["right"])) not in merges][:per_round]
        merges += new
        text = F.col("s")
        for left, right in new:
            text = F.replace(text, F.lit(OPEN + left + CLOSE + OPEN + right + CLOSE), F.lit(OPEN + left + right + CLOSE))
        if k + 1 < rounds:  # written with this round's merges, so none is applied twice
            words = materialize(words.select("cnt", text.alias("s")), "bpe-words")
    return toks.sparkSession.createDataFrame([(i, *m) for i, m in enumerate(merges)], "rank int, left string, right string")


def merges_file_lines(merges: DataFrame) -> DataFrame:
    """Render merges as the lines of a merges file: a header line, one ``left right`` line per
    merge, and the empty text after the final newline."""
    spark = merges.sparkSession
    body = merges.select((F.col("rank") + 1).cast("bigint").alias("line_no"), F.concat_ws(" ", "left", "right").alias("line"))
    n = merges.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") + 1).cast("bigint").alias("line_no"), F.lit("").alias("line"))
    head = spark.createDataFrame([(0, "#version: 0.2")], "line_no bigint, line string")
    return head.unionByName(body).unionByName(n)


def piece_ids_json(piece_ids: DataFrame) -> DataFrame:
    """Render the id map as one JSON object (the encoder's id file)."""
    return piece_ids.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("piece", "id")))).alias("value"))
