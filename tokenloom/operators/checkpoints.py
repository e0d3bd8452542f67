"""Checkpoint selection and averaging."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def eligible_checkpoints(ckpts: DataFrame, record: DataFrame, start: int, interval: int,
                         max_step: int | None = None, step: str = "step") -> DataFrame:
    """F6 + J5: step >= start and step % interval == 0 (or start <= step <= max_step in the
    other variant), and not already in the evaluation record (anti-join)."""
    c = ckpts.filter(F.col(step) >= F.lit(start))
    if max_step is not None:
        c = c.filter(F.col(step) <= F.lit(max_step))
    else:
        c = c.filter(F.pmod(F.col(step), F.lit(interval)) == 0)
    return c.join(record.select(step), step, "left_anti")


def best_checkpoint(results: DataFrame, metric: str = "perplexity", step: str = "step") -> DataFrame:
    """T5: lowest metric (ties: earliest step); no row for an empty result list."""
    return results.orderBy(F.col(metric).asc(), F.col(step).asc()).limit(1)


def last_checkpoints(ckpts: DataFrame, n: int, step: str = "step") -> DataFrame:
    """The last ``n`` checkpoints, oldest to newest (``ord`` 0..n-1)."""
    last = ckpts.orderBy(F.col(step).desc()).limit(n)
    return last.withColumn("ord", (F.row_number().over(Window.orderBy(step)) - 1).cast("bigint"))


def params_from_vectors(vectors: DataFrame, n: int = 5, id_col: str = "vec_id",
                        values_col: str = "embedding") -> DataFrame:
    """Stand-in parameters of ``n`` checkpoints: checkpoint = id mod n, variable = id div n, so
    checkpoints hold the same variables where n divides the number of rows."""
    return vectors.select(F.pmod(F.col(id_col), F.lit(n)).alias("ckpt"), F.format_string("v%05d", F.expr(f"{id_col} div {n}")).alias("name"),
                          F.col(values_col).alias("values"))


CHUNK = 4096  # values of a parameter that are averaged together


def average_chunks(params: DataFrame, ckpts: list, skip_prefix: str = "global_step", missing: str = "raise") -> DataFrame:
    """Element-wise mean over the given checkpoints as (name, chunk, values), ``CHUNK`` values to a row. Names come from the first checkpoint
    (``skip_prefix`` left out) and must exist, equally long, in every one. With ``missing`` "zero" what a later
    checkpoint lacks adds nothing, and what any repeats adds each time: the sum is divided by the number of checkpoints all the same.

    A parameter's array is cut into chunks, a chunk's arrays meet in one group (one for each checkpoint) and are added as arrays in the order of the
    checkpoints, so there is no row per value, no parameter is gathered whole, and the sum doesn't depend on the partitioning."""
    n = len(ckpts)
    p = params.filter(F.col("ckpt").isin(list(ckpts))).filter(~F.col("name").startswith(skip_prefix))
    order = F.create_map(*[x for k, c in enumerate(ckpts) for x in (F.lit(c), F.lit(k))])
    cuts = f"transform(sequence(0, greatest(size(values) - 1, 0) div {CHUNK}), k -> slice(values, cast(k as int) * {CHUNK} + 1, {CHUNK}))"
    e = p.select("name", order[F.col("ckpt")].alias("_c"), F.posexplode(F.expr(cuts)).alias("chunk", "part"))
    g = e.groupBy("name", "chunk").agg(F.array_sort(F.collect_list(F.struct("_c", "part"))).alias("_t"), F.min("_c").alias("_first"), F.count(F.lit(1)).alias("_k"),
                                       F.min(F.size("part")).alias("_lo"), F.max(F.size("part")).alias("_hi"))
    zero = F.array_repeat(F.lit(0.0), F.col("_hi"))
    # behind the end of a shorter array there is nothing to add; a null in it stays one
    total = F.aggregate("_t", zero, lambda acc, x: F.transform(acc, lambda a, i: a + F.when(i < F.size(x["part"]), F.get(x["part"], i).cast("double")).otherwise(F.lit(0.0))))
    mean = F.transform(total, lambda v: v / F.lit(n))
    g = g.where("_first = 0")
    if missing == "zero":
        return g.select("name", "chunk", mean.alias("values"))
    whole = (F.col("_k") == n) & (F.col("_lo") == F.col("_hi"))
    return g.select("name", "chunk", F.when(whole, mean).otherwise(
        F.raise_error(F.concat(F.lit("missing or of another size in a checkpoint: "), F.col("name")))).alias("values"))


def average_params(params: DataFrame, ckpts: list, skip_prefix: str = "global_step", missing: str = "raise") -> DataFrame:
    """``average_chunks`` with one value to a row: (name, pos, value)."""
    e = average_chunks(params, ckpts, skip_prefix, missing).select("name", "chunk", F.posexplode("values").alias("_i", "value"))
    return e.select("name", (F.col("chunk") * CHUNK + F.col("_i")).alias("pos"), "value")
