"""Sharded corpora: seeded sentence shuffles per (shard, shuffle) (T2) and the concatenated
stream of each shuffled shard (U3).

A shard may hold a third of all sentences, so neither the shuffle rank nor the stream
positions sort a whole shard in one task: the shuffle key is an md5 hex string, and its first
hex digits form a bucket that never decreases along the key order (two-level rank, W9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.positions import ordered_index, prefix_offsets


def shuffle_key(seed: int, *cols) -> F.Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def shuffled_sentences(lines: DataFrame, num_shuffle: int, seed: int, bucket_hex: int = 4) -> DataFrame:
    """Every sentence of a shard once per shuffle, ranked by md5(seed, shard, shuffle,
    doc_id, line_no): (shard, shuffle, rank, ...line columns)."""
    d = lines.withColumn("shuffle", F.explode(F.sequence(F.lit(0), F.lit(num_shuffle - 1))))
    d = d.withColumn("_key", shuffle_key(seed, "shard", "shuffle", "doc_id", "line_no"))
    d = ordered_index(d, ["shard", "shuffle"], [F.col("_key")], F.substring("_key", 1, bucket_hex), "rank")
    return d.drop("_key")


def shard_streams(shuffled: DataFrame, symbols_col: str = "symbols", bucket_rows: int = 1 << 14) -> DataFrame:
    """Start position of each sentence in the concatenation of its (shard, shuffle) in rank
    order; adds ``start_p`` and ``n``."""
    d = shuffled.withColumn("n", F.size(symbols_col).cast("bigint"))
    return prefix_offsets(d, F.col("n"), ["shard", "shuffle"], [F.col("rank")],
                          F.expr(f"rank div {bucket_rows}"), "start_p")
