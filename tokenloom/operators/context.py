"""Context of a window: the memory before it (W7), the keys its positions see (W8), and embedding lookup.

A row of the batch grid is cut into segments of whole windows, each at least as long as the memory; a segment gets its own tokens and a halo, the
``mem_len`` tokens before it. So a token moves to two segments at most, however much longer than a window the memory
is, and a group holds ``mem_len`` tokens and a segment. Arrays are cut at segment edges before the one exchange by (row, segment).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 4096  # tokens of a segment at least


def segment_length(T: int, mem_len: int) -> int:
    """Whole windows, at least the memory."""
    return T * -(-max(mem_len, SEGMENT) // T)


def context_segments(lines: DataFrame, S: int, T: int, mem_len: int, B: int) -> DataFrame:
    """(r, seg, c, ids): arrays of encoded lines (start_p, ids) cut for the segments that need them, ``c`` the column of the first id.
    The last column of a row is a label only and stays out."""
    L = segment_length(T, mem_len)
    if S < 2:
        lines = lines.limit(0)
    S = max(S, 2)
    last = f"least(start_p + size(ids), {B * S}L) - 1"
    d = lines.select("start_p", "ids").where(F.expr(f"size(ids) > 0 and start_p < {B * S}"))
    d = d.select("*", F.explode(F.expr(f"sequence(start_p div {S}, ({last}) div {S})")).alias("r"))
    d = d.select("*", F.expr(f"greatest(start_p - r * {S}, 0L)").alias("_lo"), F.expr(f"least(({last}) - r * {S}, {S - 2}L)").alias("_hi")).where("_hi >= _lo")
    d = d.select("*", F.explode(F.expr(f"sequence(_lo div {L}, least((_hi + {mem_len}) div {L}, {(S - 2) // L}L))")).alias("seg"))
    lo, hi = f"greatest(_lo, seg * {L} - {mem_len})", f"least(_hi, seg * {L} + {L - 1})"
    return d.select("r", "seg", F.expr(lo).alias("c"), F.expr(f"slice(ids, cast(r * {S} + {lo} - start_p + 1 as int), cast({hi} - {lo} + 1 as int))").alias("ids"))


def context_windows(lines: DataFrame, S: int, T: int, mem_len: int, B: int) -> DataFrame:
    """(r, w, memory, inputs) of each window with inputs: ``memory`` is the ``mem_len`` tokens before it in its row (fewer at the row's start)."""
    L = segment_length(T, mem_len)
    d = context_segments(lines, S, T, mem_len, B).repartition("r", "seg").groupBy("r", "seg").agg(F.array_sort(F.collect_list(F.struct("c", "ids"))).alias("_t"))
    d = d.select("r", "seg", F.flatten(F.transform("_t", lambda x: x["ids"])).alias("_ids"), F.expr(f"greatest(seg * {L} - {mem_len}, 0L)").alias("_c"))
    last = "_c + size(_ids) - 1"
    d = d.select("*", F.explode(F.expr(f"sequence(seg * {L // T}, ({last}) div {T})")).alias("w"))
    lo = f"greatest(w * {T} - {mem_len}, 0L)"
    return d.select("r", "w", F.expr(f"slice(_ids, cast({lo} - _c + 1 as int), cast(w * {T} - {lo} as int))").alias("memory"),
                    F.expr(f"slice(_ids, cast(w * {T} - _c + 1 as int), {T})").alias("inputs"))


def visible_context(lines: DataFrame, S: int, T: int, mem_len: int, same_length: bool, clamp_len: int, B: int) -> DataFrame:
    """Per window (r, w): a position sees the memory and the window up to itself (anchored), or only the last ``mem_len + 1`` keys (same
    length). ``visible`` = keys seen by all positions, ``repeats`` = positions whose id occurs among their earlier visible keys, ``dist_sum`` = sum
    over those of the distance to the nearest such occurrence, at most ``clamp_len`` each.

    The nearest earlier place of an id is one ``lag`` per (row, segment, id) over the exchange by (row, segment); no array is cut per position."""
    L = segment_length(T, mem_len)
    t = context_segments(lines, S, T, mem_len, B).repartition("r", "seg").select("r", "seg", "c", F.posexplode("ids").alias("_i", "id"))
    t = t.select("r", "seg", (F.col("c") + F.col("_i")).alias("c"), "id")
    t = t.withColumn("_prev", F.lag("c").over(Window.partitionBy("r", "seg", "id").orderBy("c"))).where(F.expr(f"c >= seg * {L}"))
    t = t.withColumn("w", F.expr(f"c div {T}"))
    lo = F.expr(f"greatest(c - {mem_len}, 0L)" if same_length else f"greatest(w * {T} - {mem_len}, 0L)")
    if same_length:  # the memory reaches back from the window's start, so it bounds early positions too
        lo = F.greatest(lo, F.expr(f"greatest(w * {T} - {mem_len}, 0L)"))
    t = t.withColumn("_lo", lo)
    seen = F.col("_prev") >= F.col("_lo")
    return t.groupBy("r", "seg", "w").agg(
        F.sum(F.col("c") - F.col("_lo") + 1).cast("bigint").alias("visible"), F.count_if(seen).cast("bigint").alias("repeats"),
        F.sum(F.when(seen, F.least(F.col("c") - F.col("_prev"), F.lit(clamp_len))).otherwise(0)).cast("bigint").alias("dist_sum")).drop("seg")


BROADCAST_VECTORS = 100_000  # of some hundred doubles each: tens of MB


def embedding_lookup(tokens: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     dim: int | None = None, scale: bool = True) -> DataFrame:
    """Each token with its vector times sqrt(d), null where the table has none. The vectors are scaled
    before the join, once each; a table of at most ``BROADCAST_VECTORS`` rows is broadcast, so a hot id needs no
    shuffle, and a larger one is joined by a shuffle whose skewed partitions AQE splits."""
    factor = F.sqrt(F.size(vec_col).cast("double")) if dim is None else F.lit(math.sqrt(dim))
    vec = F.transform(vec_col, lambda x: x.cast("double") * factor) if scale else F.col(vec_col)
    v = vectors.select(F.col(id_col).alias("_vid"), vec.alias("vector"))
    if vectors.count() <= BROADCAST_VECTORS:
        v = F.broadcast(v)
    return tokens.join(v, tokens["id"] == v["_vid"], "left").drop("_vid")


def binned_vectors(tables: list[DataFrame], projections: list | None, d_proj: int, scale: bool = True) -> DataFrame:
    """(bin, row, vector of ``d_proj`` doubles) from one table (row, embedding) for each bin, of a width of its own.

    A bin's projection (a matrix of its width by ``d_proj``, a parameter of the model) is applied once to each row of the table, before any token is
    seen; without one the width must be ``d_proj``. Vectors are scaled by sqrt(d_proj)."""
    import numpy as np
    import pyarrow as pa

    spark = tables[0].sparkSession
    shared = spark.sparkContext.broadcast([None if m is None else np.array(m, dtype=float) for m in projections or [None] * len(tables)])
    factor = math.sqrt(d_proj) if scale else 1.0

    def run(batches):
        for b in batches:
            rows = []
            for k, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                x = np.array(v, dtype=float)
                m = shared.value[k]
                if (x.shape != (d_proj,)) if m is None else (m.shape != (len(x), d_proj)):
                    raise ValueError(f"a vector of {len(x)} doesn't fit the projection of bin {k}")
                rows.append((x if m is None else x @ m) * factor)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))], names=["bin", "row", "vector"])

    every = None
    for k, t in enumerate(tables):
        one = t.select(F.lit(k).alias("bin"), F.col("row").cast("bigint").alias("row"), F.col("embedding").cast("array<double>").alias("embedding"))
        every = one if every is None else every.unionByName(one)
    return every.mapInArrow(run, "bin int, row bigint, vector array<double>")


def binned_lookup(tokens: DataFrame, vectors: DataFrame, cutoffs: list[int]) -> DataFrame:
    """J8 with a table for each bin: an id of bin b = [cutoffs[b], cutoffs[b + 1]) takes row id - cutoffs[b] of the bin's table (``binned_vectors``,
    written before); adds ``bin`` and ``vector``, null where the table lacks the row. Hot ids by broadcast, see ``joins.lookup_join``."""
    from tokenloom.operators.joins import lookup_join
    from tokenloom.operators.vocab import bin_of
    b = bin_of(F.col("id"), cutoffs)
    low = F.element_at(F.array(*[F.lit(int(c)).cast("bigint") for c in cutoffs]), b + 1)
    t = tokens.withColumn("bin", b).withColumn("_at", F.struct(F.col("bin").alias("bin"), (F.col("id") - low).alias("row")))
    return lookup_join(t, vectors.select(F.struct("bin", "row").alias("_at"), "vector"), "_at", "left", broadcast_rows=BROADCAST_VECTORS).drop("_at")
