"""Feeding examples to replicas and hosts: replica slots (P16), full per-core batches (F4),
host ranges (T4), file order per epoch (T3), padding of the last batch (P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replica_slots(examples: DataFrame, b: int, C: int) -> DataFrame:
    """Each host pulls one batch of ``b`` samples per replica in turn:
    chunk j = sample_id div b, replica = j mod C, step = j div C."""
    return (examples.withColumn("chunk", F.expr(f"sample_id div {b}")).withColumn("replica", F.pmod("chunk", F.lit(C)))
            .withColumn("step", F.expr(f"chunk div {C}")))


def full_batches(examples: DataFrame, b: int, total: int) -> DataFrame:
    """drop the last incomplete per-core batch (chunks of ``b`` consecutive samples). Sample ids
    run from 0 to ``total`` - 1 without gaps, so this is a filter."""
    return examples.filter(F.col("sample_id") < F.lit(total - total % b)).withColumn("chunk", F.expr(f"sample_id div {b}"))


def host_ranges(examples: DataFrame, num_batch: int, hosts: int, C: int, b: int) -> DataFrame:
    """T4: with one train file and several hosts, host h takes samples [h*k, (h+1)*k) with
    k = (num_batch div hosts) * C * b; the rest is dropped. Adds ``host``."""
    k = (num_batch // hosts) * C * b
    if k <= 0:
        return examples.limit(0).withColumn("host", F.lit(None).cast("bigint"))
    d = examples.filter(F.col("sample_id") < F.lit(hosts * k))
    return d.withColumn("host", F.expr(f"sample_id div {k}"))


def file_order(files: DataFrame, seed: int, epochs: int, file_col: str = "file") -> DataFrame:
    """Shard-file order per epoch by a seeded hash (deterministic, engine-independent md5).
    The file list has one row per file; each row is repeated per epoch by exploding a range."""
    d = files.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(file_col)))
    w = Window.partitionBy("epoch").orderBy(key, F.col(file_col))
    return d.withColumn("rank", (F.row_number().over(w) - 1).cast("bigint"))


def pad_last_batch(examples: DataFrame, size: int, T: int, total: int) -> DataFrame:
    """Samples in batches of ``size`` (batch = sample_id div size). Sample ids run from 0 to
    ``total`` - 1 without gaps, so only the last batch is short: its missing slots, ``size`` - 1 rows at
    most, come from a range and get zero inputs and ``is_padding`` = true."""
    place = (F.expr(f"sample_id div {size}").alias("batch"), F.expr(f"sample_id % {size}").alias("slot"))
    rows = examples.select(*place, F.lit(False).alias("is_padding"), "inputs", "labels")
    zeros = F.array_repeat(F.lit(0).cast("bigint"), T)
    pads = examples.sparkSession.range(total, total + -total % size).withColumnRenamed("id", "sample_id")
    return rows.unionByName(pads.select(*place, F.lit(True).alias("is_padding"), zeros.alias("inputs"), zeros.alias("labels")))
