"""Frequency bins: id -> bin range join (J6, F5), per-batch bin shares (G4), capacity per bin
(G5), batches per file (G6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.windows import in_bin, num_windows, tail_bins


def bins_table(spark: SparkSession, cutoffs: list[int], tail_only: bool = False) -> DataFrame:
    """(bin, lo, hi): bin b = [cutoffs[b], cutoffs[b+1]); with ``tail_only`` the tail bins are
    numbered from 0 ([cutoffs[1], cutoffs[2]) is tail bin 0). One row per cutoff: a parameter."""
    if tail_only:
        rows = tail_bins(cutoffs)
    else:
        rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(cutoffs[:-1], cutoffs[1:]))]
    return spark.createDataFrame(rows, "bin int, lo bigint, hi bigint")


def bin_join(stream: DataFrame, cutoffs: list[int], tail_only: bool = False, id_col: str = "id") -> DataFrame:
    """Range join of ids to the (broadcast, parameter-sized) bins table on [lo, hi)."""
    bins = F.broadcast(bins_table(stream.sparkSession, cutoffs, tail_only))
    return stream.join(bins, (F.col(id_col) >= bins["lo"]) & (F.col(id_col) < bins["hi"])).drop("lo", "hi")


def bin_counts(stream: DataFrame, N: int, b: int, T: int, cutoffs: list[int], with_zeros: bool = True) -> DataFrame:
    """The first b*n*T tokens (n = N div b div T) seen as b rows of n batches of T; for each
    batch j and tail bin: count and share = count / (b*T). Zeros included when ``with_zeros``
    (the full batch x bin grid is generated from a range, not joined)."""
    nb = N // b // T
    spark = stream.sparkSession
    t = stream.filter(F.col("p") < F.lit(b * nb * T)).withColumn(
        "j", F.expr(f"(p % {max(nb * T, 1)}) div {T}"))
    cnt = t.withColumn("bin", tail_bin(F.col("id"), cutoffs)).where("bin is not null").groupBy("j", "bin").agg(F.count(F.lit(1)).alias("n"))
    if with_zeros:
        nbins = len(cutoffs) - 2
        grid = spark.range(nb).select(F.col("id").alias("j"), F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"))
        cnt = grid.join(cnt, ["j", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return cnt.withColumn("share", F.col("n") / F.lit(b * T))


def tail_bin(x, cutoffs: list[int]):
    """Number of the tail bin that an id is in, null for a head id: a row-local chain, no join."""
    e = F.lit(None).cast("int")
    for b, lo, hi in reversed(tail_bins(cutoffs)):
        e = F.when(in_bin(x, lo, hi), F.lit(b)).otherwise(e)
    return e


def bin_sizes(stream: DataFrame, N: int, b: int, T: int, cutoffs: list[int],
              std_mult: tuple = (2.5, 2.5, 2.5)) -> DataFrame:
    """Per tail bin ``ceil(T*b*(mean + std_mult*std))`` of the batch shares (population std,
    zero batches included), rounded to the nearest multiple of 8 (halves up), 8 at least. Mean and variance come from the sums
    over non-zero batches divided by the batch count, so the zero grid is never built.
    Output (bin, raw, size)."""
    nb = N // b // T
    nbins = len(cutoffs) - 2
    if nbins <= 0 or nb <= 0:
        return stream.sparkSession.createDataFrame([], "bin int, raw double, size bigint")
    s = bin_counts(stream, N, b, T, cutoffs, with_zeros=False)
    n = F.col("n").cast("decimal(38,0)")
    agg = s.groupBy("bin").agg(F.sum(n).alias("s1"), F.sum(n * n).alias("s2"))  # exact, so the order of rows doesn't matter
    allb = stream.sparkSession.createDataFrame([(i, float(std_mult[i])) for i in range(nbins)], "bin int, mult double")
    agg = F.broadcast(allb).join(agg, "bin", "left")
    s1, s2 = (F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)")) for c in ("s1", "s2"))
    spread = (s2 * nb - s1 * s1).cast("double")  # nb^2 times the variance of the counts
    raw = (s1.cast("double") + F.col("mult") * F.sqrt(F.greatest(F.lit(0.0), spread))) / F.lit(nb)
    size = "greatest(8, 8 * ((cast(ceil(round(raw, 9)) as bigint) + 4) div 8))"
    return agg.select("bin", raw.alias("raw")).withColumn("size", F.expr(size))


def collect_bin_sizes(sizes: DataFrame) -> list[int]:
    """The (at most three) bin sizes as a list, to parameterise example building."""
    return [int(r["size"]) for r in sizes.orderBy("bin").collect()]


def num_batches(N: int, B: int, T: int, fixed: bool) -> int:
    """Windows per file."""
    return num_windows(N // B if B else 0, T, fixed)
