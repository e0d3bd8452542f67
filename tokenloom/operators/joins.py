"""Joins of many rows to a table with one row per key, whose size decides how."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import materialize

BROADCAST_ROWS = 200_000  # of a few dozen bytes each
HOT_KEYS = 1000


def lookup_join(rows: DataFrame, table: DataFrame, on: str, how: str = "inner", broadcast_rows: int = BROADCAST_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined (inner or left) to ``table``, which holds each value of ``on`` once and is read several times: callers write it before.

    Up to ``broadcast_rows`` rows it is broadcast. Beyond, the ``hot_keys`` most common values of ``rows`` are joined by a broadcast of their part
    of the table, and the rest, which then has no hot value, by a shuffle. Null keys have no partner and stay out of the shuffle."""
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), on, how)
    hot = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), on).limit(hot_keys).select(on)
    hot = materialize(hot, "hot-keys")
    common = F.broadcast(hot)
    known = F.broadcast(materialize(table.join(common, on, "left_semi"), "hot-rows"))  # HOT_KEYS rows at most
    known_part = rows.join(common, on, "left_semi").join(known, on, how)
    rest = rows.where(F.col(on).isNotNull()).join(common, on, "left_anti").join(table.hint("shuffle_hash"), on, how)
    out = known_part.unionByName(rest)
    if how == "left":
        out = out.unionByName(rows.where(F.col(on).isNull()), allowMissingColumns=True)
    return out
