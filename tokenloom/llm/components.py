"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node links its neighbours (the larger ones, or itself and the smaller
    ones) to the least node it sees. Minima are hash aggregates; neighbours are never gathered."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(node, root)`` for every linked node, root the component's least node.

    Ends when a round changes nothing; each round is a written table, so lineage stays short and
    a lost executor replays one round at most. Self links and repeats are ignored.
    """
    cur = materialize(edges.where(F.col("a") != F.col("b")).distinct(), "cc")
    mark = None
    while True:
        cur = materialize(_star(_star(cur, True), False), "cc")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(now)
