"""Training windows (G7, W3, F3), bin features (P13, P14, W4, G8) and dense permutations.

The stream comes as id arrays, one per line, with the position of the first id. Row r of the batch grid is
positions [rS, rS + S); window w of the row has inputs at columns [wT, min(wT + T, S - 1)) and labels one column
later, so it covers T + 1 positions and shares one with the next window. Each line's array is cut at the window
edges before the shuffle: about tokens / T + lines records move, not one per token. One shuffle groups
(w, core, r); each group holds at most T + 1 tokens, so no group grows with the data. The running bin counters of
W4 restart per (window, core group) and are a running sum over rows of that group, computed on
per-window arrays (no per-token window function).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def num_windows(S: int, T: int, fixed: bool) -> int:
    """Windows per row: ceil((S-1)/T), or floor with fixed length; 0 when S <= 1."""
    if S <= 1:
        return 0
    return (S - 1) // T if fixed else -(-(S - 1) // T)


def windows_of(lines: DataFrame, S: int, T: int, fixed: bool, B: int, C: int = 1) -> DataFrame:
    """W3 + G7 + F3: (w, r, core, sample_id, inputs, labels) from lines (start_p, ids).

    ``core = r div (B div C)``; ``sample_id = w*B + r`` (window-major, then row).
    The shuffle is hash-partitioned on (w, core) so the later per-core running counters
    (``bin_features``) need no second exchange.
    """
    W = num_windows(S, T, fixed)
    b = max(B // C, 1)
    lines = lines.filter((F.size("ids") > 0) & (F.col("start_p") < F.lit(B * S))) if W else lines.limit(0)
    S, W = max(S, 1), max(W, 1)

    def number(p: str, before: int) -> str:
        """Of the window (all rows' windows in a row) that holds position p; with ``before``, the first that does."""
        return f"(({p}) div {S}) * {W} + greatest(least((({p}) % {S} - {before}) div {T}, {W - 1}), 0)"

    last = f"least(start_p + size(ids), {B * S}) - 1"
    cut = lines.select("start_p", "ids", F.explode(F.sequence(F.expr(number("start_p", 1)), F.expr(number(last, 0)))).alias("g"))
    cut = cut.select("start_p", "ids", F.expr(f"g % {W}").alias("w"), F.expr(f"g div {W}").alias("r"))
    lo, hi = f"greatest(r * {S} + w * {T}, start_p)", f"least(r * {S} + least(w * {T} + {T + 1}, {S}), start_p + size(ids))"
    cut = cut.filter(F.expr(f"{hi} > {lo}")).select("w", "r", F.expr(f"r div {b}").alias("core"), F.expr(lo).alias("p"),
                                                    F.expr(f"slice(ids, cast({lo} - start_p + 1 as int), cast({hi} - {lo} as int))").alias("part"))
    g = cut.repartition("w", "core").groupBy("w", "core", "r").agg(F.array_sort(F.collect_list(F.struct("p", "part"))).alias("_t"))
    g = g.select("w", "core", "r", F.flatten(F.transform("_t", lambda x: x["part"])).alias("_ids"))
    n = F.size("_ids")
    return g.filter(n > 1).select("w", "r", "core", (F.col("w") * F.lit(B) + F.col("r")).alias("sample_id"),
                                  F.slice("_ids", 1, n - 1).alias("inputs"), F.slice("_ids", 2, n - 1).alias("labels"))


def tail_bins(cutoffs: list[int]) -> list[tuple[int, int, int]]:
    """(bin, lo, hi) of the tail bins, numbered from 0."""
    return [(b, cutoffs[b + 1], cutoffs[b + 2]) for b in range(len(cutoffs) - 2)]


def in_bin(x: Column, lo: int, hi: int) -> Column:
    return (x >= F.lit(lo)) & (x < F.lit(hi))


def bin_mask(arr: Column, cutoffs: list[int]) -> Column:
    """1.0 where the id is in the head bin [c0, c1)."""
    return F.transform(arr, lambda x: in_bin(x, cutoffs[0], cutoffs[1]).cast("float"))


def head_labels(labels: Column, cutoffs: list[int]) -> Column:
    """Head ids kept; an id in tail bin b becomes cutoffs[1] + b."""
    def f(x):
        e = None
        for b, lo, hi in tail_bins(cutoffs):
            cond = in_bin(x, lo, hi)
            e = F.when(cond, F.lit(cutoffs[1] + b).cast("bigint")) if e is None else e.when(cond, F.lit(cutoffs[1] + b).cast("bigint"))
        return x if e is None else e.otherwise(x)
    return F.transform(labels, f)


def bin_positions(arr: Column, lo: int, hi: int) -> Column:
    """0-based positions of ids in [lo, hi)."""
    return F.filter(F.sequence(F.lit(0), F.size(arr) - 1), lambda i: in_bin(F.get(arr, i), lo, hi))


def bin_features(windows: DataFrame, cutoffs: list[int], bin_sizes: list[int], keys: tuple[str, ...] = ()) -> DataFrame:
    """P13 + P14 + W4 + G8 on (w, core, r, inputs, labels), of each stream that ``keys`` name.

    For each tail bin b and each of inputs / labels: the positions holding a bin-b id get slot
    numbers that run over the rows of one (window, core group) in row order and stop at
    ``bin_sizes[b]``; kept (position, slot) pairs are flattened into ``tup``.
    The running count before a row is ``min(bin_size, sum of earlier rows' counts)``.
    """
    if len(cutoffs) - len(bin_sizes) != 2:
        raise ValueError(f"{len(cutoffs)} cutoffs make {max(len(cutoffs) - 2, 0)} tail bins, but {len(bin_sizes)} capacities are given")
    d = windows.withColumn("inp_mask", bin_mask(F.col("inputs"), cutoffs)) \
               .withColumn("tgt_mask", bin_mask(F.col("labels"), cutoffs)) \
               .withColumn("head_labels", head_labels(F.col("labels"), cutoffs))
    before = Window.partitionBy(*keys, "w", "core").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    tails = [(b, (lo, hi)) for b, lo, hi in tail_bins(cutoffs)]
    sides = (("inp", "inputs"), ("tgt", "labels"))
    # positions of every tail bin first, then all running counters in one select (one window)
    d = d.select("*", *[bin_positions(F.col(src), lo, hi).alias(f"_{side}_pos{b}")
                        for side, src in sides for b, (lo, hi) in tails])
    d = d.select("*", *[F.least(F.lit(bin_sizes[b]).cast("bigint"),
                                F.coalesce(F.sum(F.size(f"_{side}_pos{b}")).over(before), F.lit(0)).cast("bigint")).alias(f"_{side}_off{b}")
                        for side, _ in sides for b, _ in tails])
    for side, _ in sides:
        structs = []
        for b, _ in tails:
            pos, off = f"_{side}_pos{b}", f"_{side}_off{b}"
            keep = F.greatest(F.lit(0), F.least(F.size(pos), F.lit(bin_sizes[b]) - F.col(off)))
            kept = F.slice(F.col(pos), 1, keep.cast("int"))
            tup = F.flatten(F.transform(kept, _pair_maker(off)))
            structs.append(F.struct(F.lit(b).alias("bin"), F.size(kept).cast("bigint").alias("cnt"), tup.alias("tup")))
        d = d.withColumn(f"{side}_bins", F.array(*structs))
    return d.drop(*[c for c in d.columns if c.startswith("_")])


def _pair_maker(off: str):
    def pair(p, k):
        return F.array(p.cast("bigint"), F.col(off) + k)
    return pair


def dense_perm(tup: Column, T: int, bin_size: int) -> Column:
    """[T, bin_size] 0/1 matrix from flattened (pos, slot) pairs. The slot of a position is looked
    up once (pairs are in position order, each position once); its row is that slot's unit vector."""
    pairs = F.transform(F.filter(tup, lambda x, i: i % 2 == 0), lambda p, i: F.struct(p.alias("p"), F.get(tup, i * 2 + 1).alias("k")))
    slots = F.transform(F.sequence(F.lit(0), F.lit(T - 1)), lambda p: F.get(F.filter(pairs, lambda x: x["p"] == p), F.lit(0))["k"])
    return F.transform(slots, lambda s: F.transform(F.sequence(F.lit(0), F.lit(bin_size - 1)), lambda k: F.coalesce((k == s).cast("float"), F.lit(0.0).cast("float"))))


DENSE_ROWS = 1024  # tuples whose matrices are made at a time


def dense_perms(tups: pa.ListArray, T: int, bin_size: int) -> np.ndarray:
    """``dense_perm`` of many tuples at once, in a task: a [rows, T, bin_size] array of zeros with a one at each (pos, slot)."""
    out = np.zeros((len(tups), T, bin_size), dtype=np.float32)
    flat = tups.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(tups)), pc.fill_null(pc.list_value_length(tups), 0).to_numpy() // 2)
    pos, slot = flat[::2], flat[1::2]
    fits = (pos >= 0) & (pos < T) & (slot >= 0) & (slot < bin_size)
    out[row[fits], pos[fits], slot[fits]] = 1
    return out
