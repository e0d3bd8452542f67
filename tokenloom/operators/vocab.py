"""Vocabulary: symbol counts (G1, G2, U1), ids (W5, W6, W9, T1, F1, U2), size (G3), file
vocabularies (A6), encoding (J1, J2, W1) and decoding (P11, J3).

Tie order follows ``Counter.most_common``: count descending, then first occurrence in the
concatenation order. The first occurrence is the smallest order key (``positions.order_key``, worked out
from a row alone), so the count is a plain hash aggregate with a map-side partial step: one scan, one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.operators.positions import coarser, order_bucket, ordered_index, rank_coarser


def symbol_counts(tokens: DataFrame, sym: str = "sym", order: str = "p") -> DataFrame:
    """(sym, cnt, first). ``order`` is the order key of each token."""
    return tokens.groupBy(F.col(sym).alias("sym")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(order).alias("first"))


def _dedup(seq) -> list[str]:
    out = []
    for s in seq:
        if s not in out:
            out.append(s)
    return out


def specials_table(spark: SparkSession, special) -> DataFrame:
    rows = [(s, i) for i, s in enumerate(_dedup(special))]
    return spark.createDataFrame(rows, "sym string, id bigint")


def build_vocab(counts: DataFrame, special=(), min_freq: int = 0, max_size: int | None = None,
                docs_bucket: int = 1000) -> DataFrame:
    """vocab(id, sym, cnt, is_special).

    Specials first (keep first on repeats). Then symbols by count descending, first occurrence
    ascending; ``max_size`` is taken before specials merge (so size <= max_size + specials);
    the ``min_freq`` cut stops at the first smaller count, which on a descending list is a filter;
    symbols already present as specials are skipped.

    With ``max_size`` the top-k is a TakeOrdered (k rows) and ids are a row number over k rows.
    Without it ids come from the rank over levels (W9): buckets of (count, documents of the first
    occurrence) never decrease along the order, so no single task sorts the vocabulary.
    """
    spark = counts.sparkSession
    specials_list = _dedup(special)
    sp = specials_table(spark, specials_list)
    k = len(specials_list)
    order = [F.col("cnt").desc(), F.col("first").asc()]
    ranked = counts
    if max_size is not None:
        ranked = ranked.orderBy(*order).limit(int(max_size))
    ranked = ranked.filter(F.col("cnt") >= F.lit(min_freq))
    if specials_list:
        ranked = ranked.filter(~F.col("sym").isin(specials_list))
    if max_size is not None:
        ranked = ranked.withColumn("idx", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    else:
        bucket = F.struct((-F.col("cnt")).alias("a"), order_bucket("first", docs_bucket).alias("b"))
        ranked = ordered_index(ranked, [], order, bucket, "idx", rank_coarser())
    words = ranked.select((F.col("idx") + F.lit(k)).alias("id"), "sym", F.col("cnt").cast("bigint").alias("cnt"),
                          F.lit(False).alias("is_special"))
    specials = sp.select("id", "sym", F.lit(None).cast("bigint").alias("cnt"), F.lit(True).alias("is_special"))
    return specials.unionByName(words)


def vocab_from_file(lines: DataFrame, unk: str | None = "<UNK>", bucket_lines: int = 1 << 16) -> DataFrame:
    """File lines (line_no, line) -> vocab(id, sym). Symbol = first whitespace-separated
    field; first occurrence wins; ids in file order. A blank line is an error (as in the
    reference); when ``unk`` is given it must be present."""
    from tokenloom.functions.text import tokenize
    fields = tokenize(F.col("line"))
    t = lines.select("line_no", F.when(F.size(fields) > 0, F.element_at(fields, 1))
                     .otherwise(F.raise_error(F.lit("blank line in vocabulary file"))).alias("sym"))
    first = t.groupBy("sym").agg(F.min("line_no").alias("line_no"))
    v = ordered_index(first, [], [F.col("line_no")], F.expr(f"line_no div {bucket_lines}"), "id", coarser())
    v = v.select("id", "sym")
    if unk is not None and v.filter(F.col("sym") == unk).limit(1).count() == 0:
        raise ValueError(f"vocabulary file has no {unk}")
    return v


def vocab_size(vocab: DataFrame, counts: DataFrame) -> DataFrame:
    """Vocabulary size and number of distinct counted symbols."""
    a = vocab.agg(F.count(F.lit(1)).alias("vocab_size")).withColumn("_k", F.lit(1))
    b = counts.agg(F.count(F.lit(1)).alias("unique_tokens")).withColumn("_k", F.lit(1))
    return a.join(b, "_k").drop("_k")


def encode(tokens: DataFrame, vocab: DataFrame, unk_id: int | None, bounded: bool, sym: str = "sym") -> DataFrame:
    """Symbol -> id; unknown symbols take ``unk_id``; without one a miss raises.

    A vocabulary limited by ``max_size`` has a proven row bound and is broadcast; otherwise the
    join is left to AQE (broadcast when the measured side is small, else a shuffle join whose
    hot keys AQE's skew handling splits)."""
    v = vocab.select(F.col("sym").alias("_vsym"), F.col("id"))
    v = F.broadcast(v) if bounded else v
    j = tokens.join(v, tokens[sym] == v["_vsym"], "left").drop("_vsym")
    if unk_id is None:
        idc = F.when(F.col("id").isNull(), F.raise_error(F.concat(F.lit("unknown symbol: "), F.col(sym)))).otherwise(F.col("id"))
    else:
        idc = F.coalesce(F.col("id"), F.lit(unk_id).cast("bigint"))
    return j.withColumn("id", idc.cast("bigint"))


ENCODE_BYTES = 64 << 20  # of a vocabulary's symbols, up to which it goes to every task for encoding whole arrays


def fits_tasks(vocab: DataFrame) -> bool:
    """Whether a vocabulary's measured size allows ``encode_arrays``."""
    n = vocab.agg(F.sum(F.octet_length("sym") + 12)).first()[0]
    return (n or 0) <= ENCODE_BYTES


def encode_arrays(lines: DataFrame, vocab: DataFrame, unk_id: int | None, sym: str = "symbols", out: str = "ids") -> DataFrame:
    """J1 / J2 on whole arrays: the column ``sym`` (array of symbols) becomes ``out`` (array of ids), all other columns stay.

    The vocabulary (``fits_tasks``) is looked up in Arrow batches by an exact hash of the symbols, so tokens are neither
    taken apart into rows nor regrouped, and nothing is shuffled. Without ``unk_id`` an unknown symbol raises."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    known = vocab.select("sym", "id").toArrow()
    table = lines.sparkSession.sparkContext.broadcast((known["sym"].combine_chunks(), known["id"].to_numpy().astype(np.int64)))
    kept = [c for c in lines.columns if c != sym]
    schema = ", ".join([f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out}` array<bigint>"])

    def run(batches):
        symbols, numbers = table.value
        for b in batches:
            col = b.column(len(kept))
            words = col.flatten().dictionary_encode()
            at = pc.index_in(words.dictionary, value_set=symbols.cast(words.dictionary.type))
            if at.null_count and unk_id is None:
                raise ValueError(f"unknown symbol: {words.dictionary.filter(at.is_null())[0].as_py()}")
            at = at.fill_null(-1).to_numpy().astype(np.int64)
            ids = np.where(at >= 0, numbers[np.maximum(at, 0)], unk_id if unk_id is not None else -1) if len(numbers) else np.full(len(at), unk_id if unk_id is not None else -1)
            ids = ids[words.indices.to_numpy()] if len(ids) else np.zeros(0, np.int64)
            sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], lists], names=[*kept, out])

    return lines.select(*kept, sym).mapInArrow(run, schema)


def decode_arrays(lines: DataFrame, vocab: DataFrame, exclude: list[int] | None = None, ids: str = "ids", out: str = "text") -> DataFrame:
    """P11 / J3 on whole arrays: ``ids`` becomes ``out``, the symbols joined by a blank, without those of ``exclude``; all other columns stay. An id out of
    range raises. The vocabulary (``fits_tasks``) goes to the tasks, so nothing is taken apart or grouped: a long line decodes by the pieces it
    was encoded in."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    known = vocab.select("id", "sym").toArrow().sort_by("id")
    table = lines.sparkSession.sparkContext.broadcast((known["id"].to_numpy().astype(np.int64), known["sym"].combine_chunks()))
    kept = [c for c in lines.columns if c != ids]
    schema = ", ".join([f"`{c}` {lines.schema[c].dataType.simpleString()}" for c in kept] + [f"`{out}` string"])
    dropped = np.array(exclude or [], dtype=np.int64)

    def run(batches):
        numbers, symbols = table.value
        for b in batches:
            col = b.column(len(kept))
            x = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(col)), pc.fill_null(pc.list_value_length(col), 0).to_numpy())
            use = ~np.isin(x, dropped)
            x, row = x[use], row[use]
            at = np.minimum(np.searchsorted(numbers, x), max(len(numbers) - 1, 0))
            bad = numbers[at] != x if len(numbers) else np.ones(len(x), dtype=bool)
            if bad.any():
                raise ValueError(f"id out of range: {x[bad][0]}")
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(col)))])
            words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), symbols.take(pa.array(at)) if len(at) else pa.array([], symbols.type))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], pc.binary_join(words, " ").cast(pa.string())], names=[*kept, out])

    return lines.select(*kept, ids).mapInArrow(run, schema)


def oov_report(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """The rows of a count table (sym, cnt, first) whose symbol the vocabulary lacks."""
    return counts.join(vocab.select("sym"), "sym", "left_anti")


def decode_words(tokens: DataFrame, vocab: DataFrame, key_cols: list[str], pos_col: str = "pos",
                 exclude: list[int] | None = None, bounded: bool = False) -> DataFrame:
    """Ids -> symbols joined by a space per key, excluded ids left out; an id out of range
    raises. A vocabulary ``bounded`` by max_size is broadcast, so hot ids aren't shuffled."""
    t = tokens
    if exclude:
        t = t.filter(~F.col("id").isin(list(exclude)))
    v = vocab.select(F.col("id").alias("_vid"), F.col("sym").alias("_vs"))
    j = t.join(F.broadcast(v) if bounded else v, t["id"] == v["_vid"], "left")
    s = F.when(F.col("_vs").isNull(), F.raise_error(F.concat(F.lit("id out of range: "), F.col("id").cast("string")))).otherwise(F.col("_vs"))
    g = j.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("k"), s.alias("s")))).alias("_a"))
    return g.select(*key_cols, F.array_join(F.transform("_a", lambda x: x["s"]), " ").alias("text"))


def unk_id_of(vocab: DataFrame, unk: str, special=None) -> int | None:
    """Id of the unknown symbol, or None. A built vocabulary numbers its specials first, so the
    id follows from the specials list; otherwise one scalar is looked up."""
    if special is not None and unk in special:
        return _dedup(special).index(unk)
    r = vocab.filter(F.col("sym") == unk).select("id").limit(1).collect()
    return int(r[0][0]) if r else None


def bin_of(id_col: Column, cutoffs: list[int]) -> Column:
    """Bin index of an id for cutoffs [c0, c1, ..., cm]: bin b is [c_b, c_{b+1})."""
    e = None
    for b in range(len(cutoffs) - 1):
        cond = (id_col >= F.lit(cutoffs[b])) & (id_col < F.lit(cutoffs[b + 1]))
        e = F.when(cond, F.lit(b)) if e is None else e.when(cond, F.lit(b))
    return e if e is not None else F.lit(None).cast("int")
