"""Operator 12, hard-negative mining with anchor-clustered shared lists.

Vectors are scaled to integers, so scores are exact inner products. Anchors are clustered by direction (spherical k-means
on a bounded sample; every anchor is then assigned to its nearest centre). For a cluster, candidates are sorted once by the angular
upper bound |x| cos(max(0, angle(x, centre) - radius)), which no member's score over its own length can exceed;
every member walks that one list, in blocks, until the bound certifies that nothing further down can enter its result.

Work is dealt in cells: a shard of at most about ``SHARD`` rows against a block of at most about ``BLOCK`` anchors. Shards and blocks go by
a hash of the row, so no label, cluster or repeated vector makes a cell large. A first pass finds each
anchor's positives, a second one walks for each positive's negatives; the best of the cells are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.session import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score that a negative's score lies within
SHARD, BLOCK = 1 << 18, 1 << 18  # rows, and anchors, that meet in a cell
LEAST_SHARD = 1 << 11  # rows of a shard from which on more tasks are used
CLUSTERS, CLUSTER_SAMPLE, ROUNDS = 64, 4096, 8  # centres at most, anchors they are fitted on at most, k-means rounds
STEP = 2048  # rows of a list that are scored at a time
SLACK = 1e-6  # of an angle, for rounding
EXACT = 2.0 ** 53  # scores below it are exact in doubles


def prepare(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vec: components floor(256 * x) as little-endian 64-bit integers) of the rows that take part."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.when(F.col(id_col) % 7 == 0, F.pmod(F.col(label_col).cast("long") + 1, F.lit(10))).otherwise(F.col(label_col).cast("long"))
    d = table.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), label.alias("label"), x.alias("x")).where(F.coalesce(whole, F.lit(False)))

    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("vec", pa.binary())])

    def run(batches):
        for b in batches:
            col = b.column(2)
            flat = np.floor(SCALE * col.flatten().to_numpy(zero_copy_only=False).astype(float))
            top = np.abs(flat).max(initial=0)
            if top >= 2.0 ** 62:
                raise ValueError("a component is too large for a 64-bit integer")
            kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
            size = int(kind[2])
            raw, mark = flat.astype(kind).tobytes(), bytes([size])
            ends = size * np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([mark + raw[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())], schema=schema)

    return d.mapInArrow(run, "id long, label long, vec binary")


def matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    col = (pa.chunked_array([col]) if isinstance(col, pa.Array) else col).cast(pa.large_binary()).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = col.chunk(0) if col.num_chunks else pa.array([], pa.large_binary())
    if not len(col):
        return np.zeros((0, 0), dtype=np.int16)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)
    size, mark = np.diff(offs), data[offs[:-1]]
    if (size == size[0]).all() and (mark == mark[0]).all():  # the rule: one length, one width
        rows = data[offs[0]:offs[-1]].reshape(len(col), int(size[0]))[:, 1:]
        return np.ascontiguousarray(rows).view(f"<i{mark[0]}")
    out = np.zeros((len(col), int(((size - 1) // mark).max())), dtype=np.int64)
    for i, (lo, hi, m) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), mark.tolist(), strict=True)):
        row = np.frombuffer(data[lo + 1:hi].tobytes(), dtype=f"<i{m}")
        out[i, :len(row)] = row
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, lengths); a zero vector has no direction."""
    x = x.astype(float)
    n = np.sqrt((x * x).sum(axis=1))
    return x / np.where(n > 0, n, 1)[:, None], n


def centres(vecs: pa.Array) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of the sample, in the given order."""
    unit, _ = _unit(matrix(vecs))
    if not len(unit):
        return np.zeros((0, 0))
    at = unit[np.linspace(0, len(unit) - 1, min(CLUSTERS, max(1, int(np.sqrt(len(unit)))))).astype(int)]
    for _ in range(ROUNDS):
        own = (unit @ at.T).argmax(axis=1)
        total = np.zeros_like(at)
        np.add.at(total, own, unit)
        length = np.sqrt((total * total).sum(axis=1))
        at = np.where(length[:, None] > 0, total / np.where(length > 0, length, 1)[:, None], at)
    return at


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    return x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def assign(vecs: pa.Array, at: np.ndarray) -> np.ndarray:
    """Nearest centre of each row."""
    x = matrix(vecs)
    return (_padded(x, at.shape[1]).astype(float) @ at.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)


def _angles(x: np.ndarray, length: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each row to the centre; rows are taken in slices, so no copy of all is made."""
    norm = np.sqrt(centre @ centre) or 1.0
    dot = np.concatenate([x[i:i + 8192].astype(float) @ centre for i in range(0, len(x), 8192)] or [np.zeros(0)])
    return np.arccos(np.clip(dot / (np.where(length > 0, length, 1) * norm), -1, 1))


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.sqrt((x[i:i + 8192].astype(float) ** 2).sum(axis=1)) for i in range(0, len(x), 8192)] or [np.zeros(0)])


def shared_lists(items: np.ndarray, members: np.ndarray, cluster: np.ndarray, at: np.ndarray):
    """For each cluster with members here: (its member rows, their lengths, candidate order, bound of each candidate in that order)."""
    length, own_length = _lengths(items), _lengths(members)
    for c in np.unique(cluster):
        who = np.flatnonzero(cluster == c)
        centre = _padded(at[c:c + 1], items.shape[1])[0]
        radius = _angles(members[who], own_length[who], centre).max() + SLACK  # of the members here: as tight as is valid
        angle = _angles(items, length, centre)
        bound = length * np.cos(np.clip(angle - radius - SLACK, 0, np.pi)) * (1 + 1e-9) + 1e-6
        order = np.argsort(-bound, kind="stable")
        yield who, own_length[who], order, bound[order]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where all are exact there."""
    top = int(np.abs(a.astype(np.int64)).max(initial=0)) * int(np.abs(b.astype(np.int64)).max(initial=0)) * max(a.shape[1], 1)
    if top < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if top < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    out = a.astype(object) @ b.astype(object).T
    if out.size and np.abs(out).max() >= 1 << 63:
        raise ValueError("a score is too large for a 64-bit integer")
    return out.astype(np.int64)


NO_ID = np.iinfo(np.int64).max  # stands for a null id: the last among ties


def _ids(col: pa.ChunkedArray) -> np.ndarray:
    return col.fill_null(NO_ID).to_numpy().astype(np.int64)


def walk(a: np.ndarray, cluster: np.ndarray, own_id: np.ndarray, own_label: np.ndarray, b: np.ndarray, ids: np.ndarray, labels: np.ndarray,
         at: np.ndarray, wanted: int, bands: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(member row, band, score, item row) of the best ``wanted`` items here for each member and band.

    Members are rows of ``a``, items rows of ``b``. Without ``bands`` there is one: the items of the member's label but its own id. Else
    ``bands`` (members x m x 2) holds the least and greatest score allowed to items of other labels, (1, 0) for none. A member ends its walk
    when the bound of what remains lies below the least score of each band, or below the worst of ``wanted`` items found in it."""
    width = max(a.shape[1], b.shape[1])
    a, b = _padded(a, width), _padded(b, width)
    if bands is None:
        need, most = np.full((len(a), 1), -np.inf), np.full((len(a), 1), np.inf)
    else:
        need, most = np.where(bands[:, :, 0] <= bands[:, :, 1], bands[:, :, 0].astype(float), np.inf), bands[:, :, 1].astype(float)
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    none = np.zeros(0, np.int64)
    for who, length, order, bound in shared_lists(b, a, cluster, at):
        for lo in range(0, len(order), STEP):
            going = length * bound[lo] * (1 + 1e-9) + 1e-6 >= need[who].min(axis=1)
            who, length = who[going], length[going]
            if not len(who):
                break
            rows = order[lo:lo + STEP]
            scores = _scores(a[who], b[rows])
            same = labels[rows][None, :] == own_label[who][:, None]
            fits = same & (ids[rows][None, :] != own_id[who][:, None]) if bands is None else ~same
            for k in range(need.shape[1]):
                ok = fits & (scores >= need[who, k][:, None]) & (scores <= most[who, k][:, None])
                for i in np.flatnonzero(ok.any(axis=1)).tolist():
                    g, hit = who[i], np.flatnonzero(ok[i])
                    old = found.get((g, k), (none, none))
                    sc, rw = np.concatenate([old[0], scores[i, hit]]), np.concatenate([old[1], rows[hit]])
                    best = np.lexsort((ids[rw], -sc))[:wanted]
                    found[g, k] = sc[best], rw[best]
                    if len(best) == wanted:
                        need[g, k] = max(need[g, k], float(sc[best[-1]]))
    return [(int(g), k, int(s), int(r)) for (g, k), (sc, rw) in found.items() for s, r in zip(sc, rw, strict=True)]


FOUND = "anchor long, a_id long, nth int, positive long, positive_score long, id long, score long"


def _cell(at, wanted: int, banded: bool):
    schema = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.int64()) for c in FOUND.split(", ")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        anchor = left["anchor"].to_numpy()
        keys, first, row = np.unique(anchor, return_index=True, return_inverse=True)
        members = left.take(pa.array(first)) if banded else left
        bands, positive = None, {}
        if banded:
            nth, p, pid = left["nth"].to_numpy(), left["positive_score"].to_numpy(), _ids(left["positive"])
            bands = np.zeros((len(keys), POSITIVES, 2), dtype=np.int64)
            bands[:, :, 0] = 1
            q, r = p // 100, p % 100  # whole scores s of LOW * p <= 100 * s <= HIGH * p, without overflow
            bands[row, nth, 0], bands[row, nth, 1] = LOW * q - (-LOW * r) // 100, HIGH * q + HIGH * r // 100
            positive = {(i, n): (int(d), int(s)) for i, n, d, s in zip(row.tolist(), nth.tolist(), pid, p, strict=True)}
        ids, names, own = _ids(right["id"]), members["anchor"].to_numpy(), members["id"].to_numpy()
        got = walk(matrix(members["vec"]), members["cluster"].to_numpy(), own, members["label"].to_numpy(), matrix(right["vec"]), ids, right["label"].to_numpy(), at.value, wanted, bands)
        cols = list(zip(*((names[g], own[g], k, *positive.get((g, k), (NO_ID, 0)), ids[r], s) for g, k, s, r in got), strict=True)) or [[]] * 7
        known = [None if n not in (3, 5) else np.array(c, dtype=np.int64) == NO_ID for n, c in enumerate(cols)]
        return pa.Table.from_arrays([pa.array(np.array(c, dtype=np.int64), t, mask=m) if m is not None else pa.array(np.array(c, dtype=np.int64)).cast(t) for c, t, m in zip(cols, schema.types, known, strict=True)], schema=schema)

    return run


def mine(table: DataFrame, anchor_mod: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: see the contract of op12 in ``queries``.

    Rows with a null label or vector, or a null or non-finite component, take no part. Anchors are rows whose id is divisible by ``anchor_mod``; a
    null id is no anchor, but may be a positive or a negative, last among ties. Repeated rows are rows of their own, and repeated anchors give their
    rows once each; an anchor's other rows are those of another id. Vectors of several lengths are filled up with zeros. Without
    rows, anchors or positives the result is empty. Other columns are never read. Components or scores beyond 64-bit integers raise."""
    spark = table.sparkSession
    rows = materialize(prepare(table, id_col, vec_col, label_col).withColumn("row", F.monotonically_increasing_id()), "hn-rows")
    n = rows.count()
    anchors = rows.where(F.col("id") % anchor_mod == 0).withColumnRenamed("row", "anchor")  # repeated ids stay apart
    n_anchors = anchors.count()
    sample = anchors.orderBy(F.xxhash64("id", "vec"), "id").limit(CLUSTER_SAMPLE).select("vec").collect()
    at = spark.sparkContext.broadcast(centres(pa.array([bytes(r.vec) for r in sample], pa.binary())))  # CLUSTERS centres at most

    def near(batches):
        for b in batches:
            yield b.append_column("cluster", pa.array(assign(b.column("vec"), at.value), pa.int64()))

    anchors = materialize(anchors.select("id", "label", "vec", "anchor").mapInArrow(near, "id long, label long, vec binary, anchor long, cluster long"), "hn-anchors")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_anchors // BLOCK))
    shards = max(1, -(-n // SHARD), min(tasks, n // LEAST_SHARD))
    shard, block = F.pmod(F.xxhash64("row"), F.lit(shards)), F.pmod(F.xxhash64("anchor"), F.lit(blocks))
    dealt = rows.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda j: shard * blocks + j))).drop("row")
    parts = min(shards * blocks, 4 * max(tasks, blocks))

    def search(left: DataFrame, wanted: int, banded: bool) -> DataFrame:
        left = left.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: i * blocks + block)))
        a, b = left.repartition(parts, "cell").groupBy("cell"), dealt.repartition(parts, "cell").groupBy("cell")
        return a.cogroup(b).applyInArrow(_cell(at, wanted, banded), FOUND)

    def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    positives = best(search(anchors, POSITIVES, False), ["anchor"], POSITIVES)
    positives = materialize(positives.select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("nth")), "hn-positives")
    # a positive with a negative score has no scores between 30 and 90 per cent of its own
    found = search(anchors.join(positives.where("positive_score >= 0"), "anchor"), NEGATIVES, True)
    out = best(found, ["anchor", "nth"], NEGATIVES)
    return out.select(F.col("a_id").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS n,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (SELECT a.n AS an, a.id AS anchor_id, a.label AS al, b.id, b.n, b.label,
             CAST(coalesce(list_sum(list_transform(range(1, least(len(a.x), len(b.x)) + 1), lambda i: a.x[i] * b.x[i])), 0) AS BIGINT) AS score
      FROM v a, v b WHERE a.id % 100 = 0),
p AS (SELECT an, anchor_id, al, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY an ORDER BY score DESC, id NULLS LAST) AS nth
      FROM s WHERE label = al AND id IS DISTINCT FROM anchor_id QUALIFY nth <= 5),
r AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.an, p.nth ORDER BY s.score DESC, s.id NULLS LAST) AS INTEGER) AS rank
      FROM p JOIN s ON s.an = p.an AND s.label <> p.al AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10"""
