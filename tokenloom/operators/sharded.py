"""Examples of many streams at once (A8, A9, U3, U4, J7): every shard and shuffle of a corpus is a stream with its own batch
grid, windows, bin counters and file.

A stream is a row of a small table (one row per example file): its tokens, the starts of its rotated passes, and
the columns S and W of its grid. Pieces of encoded lines meet that table by a join on the stream (broadcast behind a
check of its size), are cut at the wrap of each pass and at window edges, and move once, to (stream, chunk of windows): no
loop over shards, and a shard that holds a third of all tokens spreads over its chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.positions import prefix_offsets
from tokenloom.operators.shards import shuffle_key
from tokenloom.operators.windows import bin_features

STREAM = ["split", "basename"]
BROADCAST_STREAMS = 200_000  # rows of the stream table, of some hundred bytes each
CHUNK_BYTES = 64 << 20  # of ids in a chunk of windows, about: the rows of an output file


def shuffled_pieces(pieces: DataFrame, num_shuffle: int, seed: int, bucket_hex: int = 4) -> DataFrame:
    """T2 + U3 on encoded pieces (shard, doc_id, line_no, start_pos, ids): each sentence of a shard once per shuffle, in the order of
    md5(seed, shard, shuffle, doc_id, line_no), with ``start_p`` in the stream of its (shard, shuffle).

    The key's first hex digits are the bucket, so neither rank nor position sorts a shard in one task; pieces of a long sentence stay in order."""
    d = pieces.withColumn("shuffle", F.explode(F.sequence(F.lit(0), F.lit(num_shuffle - 1))))
    d = d.withColumn("_key", shuffle_key(seed, "shard", "shuffle", "doc_id", "line_no"))
    order = [F.col(c) for c in ("_key", "doc_id", "line_no", "start_pos")]
    d = prefix_offsets(d, F.size("ids"), ["shard", "shuffle"], order, F.substring("_key", 1, bucket_hex), "start_p")
    return d.drop("_key")


def stream_table(pieces: DataFrame, B: int, T: int, fixed: bool, starts: DataFrame | None = None) -> DataFrame:
    """One row per stream of ``pieces`` (split, basename, ids): n tokens of a pass, ``starts`` of its passes (of the table (split, basename, starts),
    [0] where it has none), S columns of the grid and W windows (G6)."""
    t = pieces.groupBy(*STREAM).agg(F.sum(F.size("ids")).cast("bigint").alias("n"))
    one = F.array(F.lit(0).cast("bigint"))
    t = t.join(starts.select(*STREAM, "starts"), STREAM, "left") if starts is not None else t.withColumn("starts", one)
    t = t.withColumn("starts", F.coalesce("starts", one))
    t = t.withColumn("S", F.expr(f"n * size(starts) div {B}"))
    windows = f"(S - 1) div {T}" if fixed else f"(S + {T - 2}) div {T}"
    return t.withColumn("W", F.expr(f"if(S <= 1, 0L, {windows})"))


def known_streams(streams: DataFrame) -> DataFrame:
    """The stream table with a broadcast hint if it has few rows; beyond, the join shuffles and AQE splits a hot stream."""
    return F.broadcast(streams) if streams.limit(BROADCAST_STREAMS + 1).count() <= BROADCAST_STREAMS else streams


def random_starts(streams: DataFrame, passes: int, seed: int) -> DataFrame:
    """(split, basename, starts): a start in [0, n) for each pass, by a hash of seed, stream and pass."""
    def at(k: Column) -> Column:
        return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "split", "basename", k.cast("string"))), 1, 15), 16, 10).cast("bigint"), F.greatest("n", F.lit(1)))
    return streams.select(*STREAM, F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), at).alias("starts"))


def rotated_pieces(pieces: DataFrame, streams: DataFrame) -> DataFrame:
    """J7 + U4 on pieces (split, basename, start_p, ids): each pass k of a stream begins at its start s, so a token goes from p to
    k * n + (p - s) mod n; an array that holds s is cut there. Adds the stream's S and W."""
    d = pieces.select(*STREAM, "start_p", "ids").join(known_streams(streams), STREAM)
    d = d.select(*STREAM, "start_p", "ids", "n", "S", "W", F.posexplode("starts").alias("_k", "_s"))
    d = d.withColumn("_cut", F.expr("cast(greatest(0L, least(size(ids), _s - start_p)) as int)"))
    whole = "array(named_struct('p', _k * n + if(_cut > 0, n, 0L) + start_p - _s, 'ids', ids))"
    halves = "array(named_struct('p', _k * n + n + start_p - _s, 'ids', slice(ids, 1, _cut)), named_struct('p', _k * n, 'ids', slice(ids, _cut + 1, size(ids) - _cut)))"
    d = d.select(*STREAM, "S", "W", F.explode(F.expr(f"if(_cut > 0 and _cut < size(ids), {halves}, {whole})")).alias("_x"))
    return d.select(*STREAM, "S", "W", F.col("_x.p").alias("start_p"), F.col("_x.ids").alias("ids"))


def windows_of_streams(pieces: DataFrame, B: int, T: int, fixed: bool, C: int = 1) -> DataFrame:
    """W3 + G7 + F3 for every stream of ``pieces`` (split, basename, S, W, start_p, ids): (split, basename, chunk, w, r, core, sample_id, inputs, labels).

    Arrays are cut at the window edges of their own grid; one exchange by (stream, chunk of windows) serves the grouping, the bin
    counters and the files. A group holds at most T + 1 tokens."""
    b = max(B // C, 1)
    per = max(1, CHUNK_BYTES // (16 * B * (T + 1)))
    d = pieces.where(F.expr(f"size(ids) > 0 and W > 0 and start_p < {B} * S"))
    last = f"(least(start_p + size(ids), {B} * S) - 1)"

    def number(p: str, before: int) -> str:
        return f"({p} div S) * W + greatest(least(({p} % S - {before}) div {T}, W - 1), 0L)"

    d = d.select("*", F.explode(F.sequence(F.expr(number("start_p", 1)), F.expr(number(last, 0)))).alias("_g"))
    d = d.select("*", F.expr("_g % W").alias("w_"), F.expr("_g div W").alias("r_"))
    lo, hi = f"greatest(r_ * S + w_ * {T}, start_p)", f"least(r_ * S + least(w_ * {T} + {T + 1}, S), start_p + size(ids))"
    d = d.where(F.expr(f"{hi} > {lo}")).select(*STREAM, F.expr(f"w_ div {per}").alias("chunk"), F.col("w_").alias("w"), F.expr(f"r_ div {b}").alias("core"), F.col("r_").alias("r"),
                                               F.expr(lo).alias("p"), F.expr(f"slice(ids, cast({lo} - start_p + 1 as int), cast({hi} - {lo} as int))").alias("part"))
    g = d.repartition(*STREAM, "chunk").groupBy(*STREAM, "chunk", "w", "core", "r").agg(F.array_sort(F.collect_list(F.struct("p", "part"))).alias("_t"))
    g = g.withColumn("_ids", F.flatten(F.transform("_t", lambda x: x["part"])))
    n = F.size("_ids")
    g = g.where(n > 1).select(*STREAM, "chunk", "w", "r", "core", (F.col("w") * B + F.col("r")).alias("sample_id"), F.slice("_ids", 1, n - 1).alias("inputs"), F.slice("_ids", 2, n - 1).alias("labels"))
    return g.where(F.size("inputs") == T) if fixed else g


def examples_of_streams(pieces: DataFrame, streams: DataFrame, B: int, T: int, C: int = 1, cutoffs: list[int] | None = None,
                        bin_sizes: list[int] | None = None, fixed: bool = False) -> DataFrame:
    """A8 for every stream: passes, windows and, with ``cutoffs`` and ``fixed``, masks, head labels and bin tuples whose counters
    restart in each (file, window, core)."""
    win = windows_of_streams(rotated_pieces(pieces, streams), B, T, fixed, C)
    if cutoffs and fixed:
        win = bin_features(win, cutoffs, bin_sizes or [], keys=(*STREAM, "chunk"))
    return win
