"""Positions in a concatenation order without one big sort (W1, W9), batch grid (W2, F2),
rotated passes (J7, U4).

The reference concatenates every encoded line into one vector in one process. Here the start
of every row in the concatenation is a multi-level prefix sum:

1. a *bucket* column that never decreases along the order (e.g. ``doc_id div 1000``) groups
   rows; the per-bucket totals form a small table whose running sum gives each bucket's offset;
2. inside a bucket a windowed running sum (partitioned by the bucket) gives the offset of
   each row. With ``coarsen`` the bucket table's own running sum is computed the same way over
   coarser buckets (a third level).

Both levels are data-derived, so retries and re-reads give the same numbers (no partition ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def doc_bucket(col: str = "doc_id", size: int = 1000) -> Column:
    """Default bucket: ``size`` consecutive document ids."""
    return F.expr(f"{col} div {size}")


# places of the counting order key: token number in its line, line number, document id, split order
POS_PLACES, LINE_PLACES, DOC_PLACES = 9, 8, 19


def order_key(split_ord: Column, doc: Column, line: Column) -> Column:
    """A number (decimal(38, 0)) that grows along (split order, document, line), with room for the token's
    number in the line to be added. It is worked out from the row alone, so an order of first occurrence needs no
    positions, and its minimum stays in a hash aggregate."""
    def at(c: Column, places: int) -> Column:
        return c.cast("decimal(38,0)") * F.lit("1" + "0" * places).cast("decimal(38,0)")
    key = at(split_ord, POS_PLACES + LINE_PLACES + DOC_PLACES) + at(doc, POS_PLACES + LINE_PLACES) + at(line, POS_PLACES)
    return key.cast("decimal(38,0)")


def order_bucket(key: str, docs: int = 1000) -> Column:
    """Of an order key: ``docs`` consecutive documents of a split."""
    return F.expr(f"{key} div {docs}{'0' * (POS_PLACES + LINE_PLACES)}BD")


def prefix_offsets(df: DataFrame, weight: Column, part_cols: list[str], order_cols: list[Column],
                   bucket: Column, out: str, coarsen=None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows before this one in the order ``order_cols``
    within ``part_cols``. ``bucket`` must be non-decreasing along the order.

    Plan: one aggregate of df to the bucket table (small: rows / bucket size; map-side partial
    aggregation), a running sum over that table, then one windowed running sum partitioned by
    (part, bucket). The join of the bucket offsets is left to AQE (broadcast when the measured
    bucket table is small, shuffle join otherwise).

    ``coarsen`` (a function of the bucket column, non-decreasing) adds a level: the bucket
    table's own running sum is computed the same way with coarser buckets, so no single task
    holds the whole bucket table however large the input grows.

    df is read twice (bucket totals, then rows); when its upstream is expensive (tokenising)
    the caller passes a written table, so the second read is a pruned Parquet scan.
    """
    d = df.withColumn("_w", weight.cast("bigint")).withColumn("_bk", bucket)
    keys = list(part_cols) + ["_bk"]
    sizes = d.groupBy(*keys).agg(F.sum("_w").alias("_bn"))
    if coarsen is None:
        wb = Window.partitionBy(*part_cols).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        offs = sizes.select(*keys, F.coalesce(F.sum("_bn").over(wb), F.lit(0)).cast("bigint").alias("_boff"))
    else:
        sz = sizes.withColumnRenamed("_bk", "_bk1")
        offs = prefix_offsets(sz, F.col("_bn"), part_cols, [F.col("_bk1")], coarsen(F.col("_bk1")), "_off1")
        offs = offs.select(*part_cols, F.col("_bk1").alias("_bk"), F.col("_off1").alias("_boff"))
    wi = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    res = d.join(offs, keys).withColumn(out, (F.col("_boff") + F.coalesce(F.sum("_w").over(wi), F.lit(0))).cast("bigint"))
    return res.drop("_w", "_bk", "_boff")


def coarser(factor: int = 1024):
    """Level above a numeric bucket: ``factor`` (a power of two) consecutive buckets."""
    return lambda b: F.shiftright(b, factor.bit_length() - 1)


def rank_coarser(factor: int = 1024):
    """Level above a (count, bucket) struct: ``factor`` consecutive buckets of a count."""
    return lambda b: F.struct(b["a"].alias("a"), F.shiftright(b["b"], factor.bit_length() - 1).alias("b"))


def ordered_index(df: DataFrame, part_cols: list[str], order_cols: list[Column], bucket: Column,
                  out: str = "idx", coarsen=None) -> DataFrame:
    """0-based rank of each row in a total order, computed with the same scheme of levels
    (the order must be strict, e.g. end in a unique key)."""
    return prefix_offsets(df, F.lit(1), part_cols, order_cols, bucket, out, coarsen)


def token_positions(lines: DataFrame, symbols_col: str, part_cols: list[str], order_cols: list[str],
                    bucket: Column, keep: list[str] | None = None, coarsen=None) -> DataFrame:
    """One row per token with its position ``p`` in the concatenation of lines (per part).

    The line starts come from ``prefix_offsets`` on line lengths; ``posexplode`` adds the offset
    inside the line. Output: part cols, keep cols, p, pos, sym.
    """
    keep = keep or []
    t = prefix_offsets(lines.withColumn("_n", F.size(symbols_col)), F.col("_n"), part_cols,
                       [F.col(c) for c in order_cols], bucket, "_start", coarsen)
    t = t.select(*part_cols, *keep, "_start", F.posexplode(symbols_col).alias("pos", "sym"))
    return t.select(*part_cols, *keep, (F.col("_start") + F.col("pos")).alias("p"), "pos", "sym")


def batch_grid(stream: DataFrame, B: int, N: int, p_col: str = "p") -> DataFrame:
    """W2 + F2: S = N div B; keep p < B*S; r = p div S, c = p mod S."""
    S = N // B
    p = F.col(p_col)
    return (stream.filter(p < F.lit(B * S))
            .withColumn("r", F.expr(f"{p_col} div {S}") if S > 0 else F.lit(None).cast("bigint"))
            .withColumn("c", F.pmod(p, F.lit(S)) if S > 0 else F.lit(None).cast("bigint")))


def rotated_passes(stream: DataFrame, starts: list[int], N: int, p_col: str = "p") -> DataFrame:
    """``len(starts)`` copies of the stream, copy k rotated to begin at ``starts[k]``
    (position ``(p - start) mod N``) and placed after the previous copies.

    Each row is copied by exploding the (parameter-sized) list of passes: no join.
    """
    passes = F.array(*[F.struct(F.lit(k).alias("pass"), F.lit(int(s)).cast("bigint").alias("start"))
                       for k, s in enumerate(starts)])
    j = stream.withColumn("_pass", F.explode(passes)).select("*", "_pass.pass", "_pass.start").drop("_pass")
    newp = F.col("pass").cast("bigint") * F.lit(N) + F.pmod(F.col(p_col) - F.col("start"), F.lit(N))
    return j.withColumn(p_col, newp).drop("start")
