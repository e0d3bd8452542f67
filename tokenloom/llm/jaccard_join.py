"""Operator 4, n-gram Jaccard join by T-occurrence search (DivideSkip).

Two texts link when the Jaccard similarity of their distinct word shingles reaches ``percent``.
A set is a node once, however many rows carry it, so exact copies cost one row each.

1. One pass gives each row its set size and a 128-bit fingerprint of its set, and fixed-size
   bucket counts of all shingles: the rarity order (count, hash) that every set is sorted by.
2. The rarest shingles of each set, ``n - ceil(percent n) + spare(n)`` of them, are posted. Linked sets share
   at least ``spare`` of them (the lesser of the two), so a set with fewer postings that any other set has too
   links with nothing and falls away, and so do shingles posted by one set only.
3. Sets with a shared shingle go, whole, into bounded index blocks, near copies mostly side by
   side (the block key is a set's most shared posting). In a block, each query merges its short
   inverted lists with a heap, probes its long lists by binary search, and keeps sets
   reaching the required overlap. Only a spanning forest of the links found leaves a block.
4. Links between blocks: where a block key was too heavy for one block, one set of each piece asks the
   first piece. After components are formed, each set asks every lower block in which ``spare`` of its
   postings are held by sets of other components. Sets already joined aren't compared again, so a
   group of near copies doesn't cost all its pairs, and no link between components is missed.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm import textkernel as tk
from tokenloom.llm.components import components
from tokenloom.session import materialize

BUCKETS = 1 << 16  # counters of the rarity order: fixed, so the broadcast is 512 KB at any input size
BROADCAST_IDS = 2_000_000  # ids of texts to read again (8 bytes each) that are broadcast at most; more are joined by a shuffle
BROADCAST_ROUTES = 500_000  # places of sets, or questions to blocks (40 bytes each), that are broadcast at most; more are joined by a shuffle
BLOCK_WEIGHT = 1 << 19  # shingles in an index block, about
QUERY_WEIGHT = 1 << 20  # shingles of the queries that one task asks a block, about


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def _sets(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    start, end, first = tk.word_bounds(data, offs)
    words = tk.word_hashes(data, start, end)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        yield tk.shingles(words[lo:hi], k)


def _fingerprint(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


SURVEY = "id long, n long, fp binary, bucket int, c long"


def _survey(k: int):
    """Rows (id, n, fp) of all texts, and at a partition's end its shingle counts (bucket, c)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("bucket", pa.int32()), ("c", pa.int64())])

    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for b, data, offs in tk.chunks(batches):
            sets = list(_sets(data, offs, k))
            if sets:
                counts += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
            none = [pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_fingerprint(s) for s in sets], pa.binary()), *none], schema=schema)
        at = np.flatnonzero(counts)
        none = [pa.nulls(len(at), x) for x in (pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], schema=schema)

    return run


def _spare(n):
    """Postings that linked sets share at least, the lesser set's count; grows with n."""
    return 1 + n // 20


def _prefix(k: int, percent: int, order):
    """(shingle, fp, n) of the rarest shingles of each set; once for each partition."""
    schema = pa.schema([("token", pa.int64()), ("fp", pa.binary()), ("n", pa.int64())])

    def run(batches):
        counts = np.frombuffer(order.value, dtype=np.int64)
        seen = set()
        for _, data, offs in tk.chunks(batches):
            tokens, fps, sizes, lens = [], [], [], []
            for s in _sets(data, offs, k):
                n, fp = len(s), _fingerprint(s)
                if not n or fp in seen:
                    continue
                seen.add(fp)
                rare = n - -(-percent * n // 100) + _spare(n)
                tokens.append(s[np.lexsort((s, counts[_bucket(s)]))[:rare]])
                fps.append(fp)
                sizes.append(n)
                lens.append(rare)
            if tokens:
                at = pa.array(np.repeat(np.arange(len(lens)), lens))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(fps, pa.binary()).take(at), pa.array(sizes, pa.int64()).take(at)], schema=schema)

    return run


def _whole(k: int):
    """(fp, set) of texts."""
    schema = pa.schema([("fp", pa.binary()), ("items", pa.binary())])

    def run(batches):
        for _, data, offs in tk.chunks(batches):
            sets = [s for s in _sets(data, offs, k)]
            yield pa.RecordBatch.from_arrays([pa.array([_fingerprint(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return run


def divide_skip(lists: list[np.ndarray], need: int) -> dict[int, int]:
    """Ids that occur in at least ``need`` of the sorted id lists, with their counts.

    The ``need - 1`` longest lists are set aside: an id in ``need`` lists is in one of the others at least.
    Those short lists are merged with a heap; each id met is then probed in the long lists by binary
    search, from the longest, until it can't reach ``need`` any more.
    """
    if need <= 0 or len(lists) < need:
        return {}
    lists = sorted(lists, key=len)
    cut = len(lists) - (need - 1)
    short, long = lists[:cut], lists[cut:][::-1]
    seen: dict[int, int] = {}
    for x in heapq.merge(*(s.tolist() for s in short if len(s))):
        seen[x] = seen.get(x, 0) + 1
    if not seen:
        return {}
    ids = np.fromiter(seen, dtype=np.int64, count=len(seen))
    got = np.fromiter(seen.values(), dtype=np.int64, count=len(seen))
    for left, s in zip(range(len(long), 0, -1), long, strict=True):
        live = got + left >= need
        if not live.all():
            ids, got = ids[live], got[live]
            if not len(ids):
                return {}
        at = np.searchsorted(s, ids)
        got = got + (s[np.minimum(at, len(s) - 1)] == ids)
    keep = got >= need
    return dict(zip(ids[keep].tolist(), got[keep].tolist(), strict=True))


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def flat(self) -> np.ndarray:
        while not np.array_equal(nxt := self.up[self.up], self.up):
            self.up = nxt
        return self.up


def search(index: list[np.ndarray], queries: list[np.ndarray], percent: int, groups: np.ndarray, own: bool) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of the link graph: i indexes ``index + queries``, j ``index``.

    ``groups``: a label for each of ``index + queries``; equal labels are joined already. With ``own`` the index's
    sets ask too, each only those before it.
    """
    if not index:
        return []
    sizes = np.array([len(s) for s in index])
    flat = np.concatenate(index)
    owner = np.repeat(np.arange(len(index)), sizes)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    head = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    tokens, ends = flat[head], np.append(head[1:], len(flat))
    forest = _Forest(len(index) + len(queries))
    _, lead, back = np.unique(groups, return_index=True, return_inverse=True)
    for i, g in enumerate(back):
        forest.join(i, int(lead[g]))
    links = []
    todo = [(i, s) for i, s in enumerate(index) if own] + [(len(index) + i, s) for i, s in enumerate(queries)]
    for i, s in todo:
        n = len(s)
        need = -(-percent * n // 100)  # an overlap of percent of the union is one of either set
        at = np.searchsorted(tokens, s)
        at = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == s)]
        if len(at) < need:
            continue
        lo, hi = head[at], ends[at]
        if i < len(index):
            if len(at) - int((hi - lo == 1).sum()) < need:  # lists that hold only this set
                continue
        roots = forest.flat()
        open_ = (roots[:len(index)] != roots[i]) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
        if i < len(index):
            open_[i:] = False
        if not open_.any():
            continue
        lists = [x[open_[x]] for x in (owner[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True))]
        lists = [x for x in lists if len(x)]
        for j, both in divide_skip(lists, need).items():
            if 100 * both >= percent * (n + int(sizes[j]) - both) and forest.join(i, j):
                links.append((i, j))
    return links


EDGE = "a binary, b binary"


def _ask(percent: int, own: bool):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("fp")
        members, asks = rows[rows["indexed"]], rows[~rows["indexed"]]
        if not len(members):
            return pd.DataFrame({"a": [], "b": []})
        get = lambda df: [np.frombuffer(x, dtype=np.uint64) for x in df["items"]]
        both = pd.concat([members[["fp", "label"]], asks[["fp", "label"]]], ignore_index=True)
        links = search(get(members), get(asks), percent, pd.factorize(both["label"])[0], own and key[1] == 0)
        fps = both["fp"].tolist()
        return pd.DataFrame({"a": [fps[i] for i, _ in links], "b": [fps[j] for _, j in links]})

    return run


def _round(held: DataFrame, routes: DataFrame, percent: int, own: bool) -> DataFrame:
    """Spanning links found when each (fp -> block) of ``routes`` asks that block's index.

    The queries of a block are dealt to tasks of about QUERY_WEIGHT; each such task gets the block's bounded index.
    """
    few = F.broadcast if routes.count() <= BROADCAST_ROUTES else lambda d: d
    parts = held.select("fp", "n").join(few(routes), "fp").groupBy("block").agg(F.expr(f"cast(sum(n) div {QUERY_WEIGHT} as int) + 1").alias("parts"))
    parts = few(materialize(parts, "jj-parts"))  # one row for each block asked
    asks = held.select("fp", "items", "n", "label").join(few(routes), "fp")
    asks = asks.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    members = held.join(parts, "block", "left" if own else "inner").withColumn("part", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")))
    cols = ["block", "part", "fp", "items", "label"]
    return (members.select(*cols, F.lit(True).alias("indexed")).unionByName(asks.select(*cols, F.lit(False).alias("indexed")))
            .groupBy("block", "part").applyInPandas(_ask(percent, own), EDGE))


def _routes(places: DataFrame, least: str) -> DataFrame:
    """(fp, block): lower blocks than a set's own where enough of its postings are held by sets of other labels."""
    there = places.groupBy("token", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    met = places.alias("p").join(there.alias("t"), F.expr("p.token = t.token and t.block < p.block and (t.lo != p.label or t.hi != p.label)"))
    return met.groupBy("p.fp", "t.block").agg(F.count("*").alias("held"), F.first("p.n").alias("n")).where(f"held >= {least}").select("fp", "block")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (least id reachable by links).

    A null or wordless text has an empty set, links with nothing and is a component of its own. A row
    with a null id links nothing: it gets the component of an equal set that has an id, else null. Repeated
    rows stay, an id with several texts belongs to the component of each. Other columns are never read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = materialize(texts.mapInArrow(_survey(k), SURVEY), "jj-sets")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in seen.where("bucket is not null").groupBy("bucket").agg(F.sum("c").alias("c")).collect():  # BUCKETS rows at most
        counts[r[0]] = r[1]
    order = spark.sparkContext.broadcast(counts.tobytes())
    rows = seen.where("bucket is null").select("id", "n", "fp")
    classes = rows.where("fp is not null and id is not null").groupBy("fp").agg(F.min("id").alias("least"))

    # one exchange by shingle counts its sets, and drops the shingles posted by one set only
    posted = texts.select("text").mapInArrow(_prefix(k, percent, order), "token long, fp binary, n long").repartition("token")
    posted = posted.groupBy("token", "fp").agg(F.first("n").alias("n")).withColumn("df", F.count("*").over(W.partitionBy("token"))).where("df > 1")
    least = f"1 + cast(ceil(n * {percent} / 100) as long) div 20"  # spare() of the smallest set that n can link with

    # one exchange by set counts its shared shingles, drops sets with too few of them and names the most shared one
    mine = W.partitionBy("fp")
    posted = (posted.withColumn("held", F.count("*").over(mine)).withColumn("top", F.max(F.struct("df", "token")).over(mine)).where(f"held >= {least}")
              .select("token", "fp", "n", F.col("top.token").alias("key")))
    posted = materialize(posted, "jj-shared")

    # index blocks: sets by their most shared posting; a key too heavy for one block is split by set
    home = materialize(posted.where("token = key").select("fp", "n", "key"), "jj-home")
    total = home.agg(F.sum("n")).first()[0] or 0
    blocks = total // BLOCK_WEIGHT + 1
    heavy = home.groupBy("key").agg(F.sum("n").alias("w")).where(F.col("w") > BLOCK_WEIGHT).select("key", F.expr(f"cast(w div {BLOCK_WEIGHT} as int) + 1").alias("pieces"))
    home = home.join(heavy, "key", "left").select("fp", "n", "key", F.col("pieces").isNotNull().alias("split"), F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("key"), F.lit(blocks)))
                                                  .otherwise(F.xxhash64("key", F.pmod(F.xxhash64("fp"), F.col("pieces")))).alias("block"))
    # whole sets of the members, one for each class
    pick = home.join(classes, "fp").select(F.col("least").alias("id"))
    pick = materialize(pick, "jj-ids")
    pick = F.broadcast(pick) if pick.count() <= BROADCAST_IDS else pick
    sets = texts.join(pick, "id", "left_semi").select("text").mapInArrow(_whole(k), "fp binary, items binary")
    held = materialize(home.join(sets.dropDuplicates(["fp"]), "fp"), "jj-held")

    # the pieces of a split key: one set of each asks the first
    pieces = held.where("split").groupBy("key", "block").agg(F.min("fp").alias("fp"))
    star = (pieces.join(pieces.groupBy("key").agg(F.min("block").alias("to")), "key").where("block != to")
            .select("fp", F.col("to").alias("block")).distinct())

    star = materialize(star, "jj-star")
    found = materialize(_round(held.withColumn("label", F.col("fp")), star, percent, True), "jj-links")
    roots = components(found)

    labels = roots.select(F.col("node").alias("fp"), F.col("root").alias("label"))
    held = held.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    homes = held.select("fp", "block", "label")
    homes = F.broadcast(homes) if home.count() <= BROADCAST_ROUTES else homes
    # dealt by shingle before it is counted by shingle and block, so the counts need no exchange of their own
    routes = materialize(_routes(posted.select("token", "fp", "n").join(homes, "fp").repartition("token"), least), "jj-routes")
    more = materialize(_round(held, routes, percent, False), "jj-links")
    roots = components(found.unionByName(more)) if more.limit(1).count() else roots

    comp = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = comp.groupBy("root").agg(F.min("least").alias("component_id"))
    comp = comp.join(names, "root").select("fp", "component_id")
    linked = rows.where("fp is not null").join(comp, "fp", "left").select("id", "n", "component_id")
    alone = rows.where("fp is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
