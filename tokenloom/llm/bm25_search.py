"""Operator 2, exact top-k BM25 search by block-max pruning over index shards.

A shard is a bounded batch of whole texts: an inverted index in flat arrays. Texts with equal word counts are one bag in it, which names
its documents by id. Queries are taken in blocks, and a shard scores some queries of the block at a time:

1. Words in many of the shard's bags are columns of a dense matrix, so their part of all scores is one product; the postings of the other words are
   added up. All in double precision, from the global statistics (texts, mean length, document frequencies).
2. The k-th greatest of the maxima of blocks of ``BLOCK`` bags is a lower bound of the k-th score, as is the k-th score that the task's shards have
   given so far. Blocks whose maximum is below it are skipped.

A task merges its shards' answers, so the best k of all tasks' answers are exactly the corpus's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.llm.wordtable import ranges
from tokenloom.session import materialize, session_conf

K1, B = 1.2, 0.75
BLOCK = 64
SHARD_BYTES, SHARD_ROWS = 4 << 20, 1 << 13  # of a shard at most; a longer text is a shard of its own
QUERIES, QUERY_BYTES = 2048, 8 << 20  # queries of a block, and bytes of their texts, at most; a longer query is a block of its own
ROWS = 64  # queries scored at a time
GROUPS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}  # by default a writer first looks after 100 rows what it holds
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}  # of index rows sent to a worker at once; by default they are 64 MB, in the JVM and in each worker
PAIRS = 1 << 17  # postings added up at a time, about
DENSE, COLUMNS = 0.05, 1024  # share of a shard's bags from which a word has a column, and columns at most
DIGITS = 6  # scores are rounded to; equal ones are ranked by document id
LAST = (1 << 63) - 1  # order of a null id: after all others

INDEX = "docs binary, known binary, members binary, lengths binary, terms binary, df binary, starts binary, postings binary, tfs binary"
ANSWERS = "query long, query_id long, doc long, known boolean, score double"


def _terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each text)."""
    start, end, first = tk.word_bounds(data, offs)
    return tk.word_hashes(data, start, end), first


def _heads(*cols: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows starts."""
    if not len(cols[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cols])]))


def _index_row(b: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
    """The index row of some texts. A function of its own, so that nothing of a shard is held while the next one is built."""
    words, first = _terms(data, offs)
    known = b.column(0).is_valid().to_numpy(False)
    ids = np.where(known, b.column(0).fill_null(0).to_numpy(), LAST)
    lengths = np.diff(first)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (words, tk.mix(words))]
    prints = [x[first[1:]] - x[first[:-1]] for x in sums]  # equal for texts with equal word counts
    del sums
    order = np.lexsort((~known, ids, lengths, *prints))
    head = _heads(lengths[order], *[x[order] for x in prints])
    members = np.append(head, len(ids))
    kept = np.full(len(ids), -1)
    kept[order[head]] = np.arange(len(head))  # the bag's first text stands for it
    bag = np.repeat(kept, lengths)
    words, bag = words[bag >= 0], bag[bag >= 0]
    terms, word = np.unique(words, return_inverse=True)
    del words
    word *= len(head)
    word += bag
    key, tf = np.unique(word, return_counts=True)
    word, bag = key // max(1, len(head)), key % max(1, len(head))
    starts = np.searchsorted(word, np.arange(len(terms) + 1))
    df = np.add.reduceat(np.diff(members)[bag], starts[:-1]) if len(terms) else starts[:0]
    row = [ids[order].astype("<i8"), known[order].astype(np.uint8), members.astype("<u4"), lengths[order[head]].astype("<u4"), terms, df.astype("<u4"), starts.astype("<u4"), bag.astype("<u4"), tf.astype("<u4")]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], names=[x.split()[0] for x in INDEX.split(", ")])


def _index():
    def run(batches: Iterator[pa.RecordBatch]):
        for b, data, offs in tk.chunks(batches, chunk_bytes=SHARD_BYTES):
            for lo in range(0, b.num_rows, SHARD_ROWS):
                at = offs[lo:lo + SHARD_ROWS + 1]
                yield _index_row(b.slice(lo, SHARD_ROWS), data[at[0]:at[-1]], at - at[0])

    return run


def _slices(size: np.ndarray) -> Iterator[slice]:
    """Cuts of ``size`` that add up to PAIRS about; one greater size is a slice of its own."""
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, side="right")))
        yield slice(lo, hi)
        lo = hi


class Shard:
    """An index row opened for a corpus of mean text length ``mean``."""

    def __init__(self, row, mean: float):
        kinds = {"docs": "<i8", "known": np.uint8, "terms": np.uint64}
        for n in (x.split()[0] for x in INDEX.split(", ")):
            setattr(self, n, np.frombuffer(getattr(row, n), kinds.get(n, "<i4")))  # none of the others reaches 2**31
        bags, sizes = len(self.lengths), np.diff(self.starts)
        self.width = -(-bags // BLOCK) * BLOCK
        self.sizes = sizes
        norm, tf = K1 * (1 - B + B * self.lengths.astype(float) / mean), self.tfs.astype(float)
        self.impact = tf * (K1 + 1) / (tf + norm[self.postings])
        dense = np.flatnonzero(sizes >= max(2, DENSE * bags))
        dense = dense[np.argsort(-sizes[dense], kind="stable")[:COLUMNS]]
        self.column = np.full(len(sizes), -1)
        self.column[dense] = np.arange(len(dense))
        at = ranges(self.starts[dense], sizes[dense])
        self.dense = np.zeros((len(dense), self.width))
        self.dense[np.repeat(np.arange(len(dense)), sizes[dense]), self.postings[at]] = self.impact[at]

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each of the sorted terms, -1 for those that the shard doesn't have."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def best(self, row: np.ndarray, at: np.ndarray, weights: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, bag, score) of all bags that may be among the k best of the queries ``0 .. len(floor) - 1``. ``row``, ``at`` and ``weights``: each
        query's words by place; ``floor``: its k-th score so far."""
        row, at, weights = row[at >= 0], at[at >= 0], weights[at >= 0]
        column = self.column[at]
        wide = column >= 0
        q = np.zeros((len(floor), len(self.dense)))
        q[row[wide], column[wide]] = weights[wide]
        score = q @ self.dense
        r, t, w = row[~wide], at[~wide], weights[~wide]
        for x in _slices(self.sizes[t]):
            size = self.sizes[t[x]]
            i = ranges(self.starts[t[x]], size)
            score += np.bincount(np.repeat(r[x] * self.width, size) + self.postings[i], np.repeat(w[x], size) * self.impact[i], minlength=score.size).reshape(score.shape)
        blocks = score.reshape(len(floor), -1, BLOCK)
        most = blocks.max(axis=2)
        of = most if most.shape[1] >= k else score
        least = np.partition(of, of.shape[1] - k, axis=1)[:, of.shape[1] - k] if of.shape[1] >= k else np.zeros(len(floor))
        least = np.maximum(least, floor) - 10.0 ** -DIGITS
        r, g = np.nonzero((most >= least[:, None]) & (most > 0))
        near = blocks[r, g]
        i, j = np.nonzero((near >= least[r][:, None]) & (near > 0))
        score = np.array([round(x, DIGITS) for x in near[i, j].tolist()])
        return r[i][score > 0], (g[i] * BLOCK + j)[score > 0], score[score > 0]


def idf(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.log(1 + (n - d + 0.5) / (d + 0.5)) for d in df.tolist()])


def _sizes(frames):
    for f in frames:
        for row in f.itertuples():
            members, lengths = np.frombuffer(row.members, "<u4").astype(np.int64), np.frombuffer(row.lengths, "<u4")
            yield pd.DataFrame({"n": [int(members[-1])], "total": [int(np.diff(members) @ lengths)]})


def _frequencies(terms):
    def run(frames):
        for f in frames:
            for row in f.itertuples():
                own, df, t = np.frombuffer(row.terms, np.uint64), np.frombuffer(row.df, "<u4").astype(np.int64), terms.value
                at = np.searchsorted(own, t)
                has = np.flatnonzero(at < len(own))
                has = has[own[at[has]] == t[has]]
                yield pd.DataFrame({"term": has, "df": df[at[has]]})

    return run


def _ranked(query: np.ndarray, doc: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
    """The best k answers of each query, by query."""
    by = np.lexsort((doc, -score, query))
    head = _heads(query[by])
    by = by[np.arange(len(by)) - np.repeat(head, np.diff(np.append(head, len(by)))) < k]
    return [x[by] for x in (query, doc, known, score)]


def _answers(queries, k: int, mean: float):
    def run(frames):
        ids, asked, sizes, terms, words, weights = queries.value
        ends = np.concatenate([[0], np.cumsum(sizes)])
        found = [np.zeros(0, x) for x in (np.int64, np.int64, bool, float)]  # query, doc, known, score
        floor = np.zeros(len(sizes))
        shard = None
        for f in frames:
            for row in f.itertuples():
                del shard  # before the next one is opened
                shard, parts = Shard(row, mean), [found]
                at = shard.find(terms)[words]
                for lo in range(0, len(sizes), ROWS):
                    own = sizes[lo:lo + ROWS]
                    x = slice(ends[lo], ends[lo + len(own)])
                    q, bag, score = shard.best(np.repeat(np.arange(len(own)), own), at[x], weights[x], floor[lo:lo + ROWS], k)
                    n = np.minimum(np.diff(shard.members)[bag], k)  # a bag's first k documents
                    d = ranges(shard.members[bag], n)
                    parts.append([lo + np.repeat(q, n), shard.docs[d], shard.known[d] > 0, np.repeat(score, n)])
                found = _ranked(*map(np.concatenate, zip(*parts, strict=True)), k)
                last = np.flatnonzero(np.append(found[0][1:] != found[0][:-1], True))[:len(found[0])]
                full = last[np.diff(np.append(-1, last)) == k]
                floor[found[0][full]] = found[3][full]
        yield pd.DataFrame({"query": ids[found[0]], "query_id": pd.array(asked[found[0]], "Int64"), "doc": found[1], "known": found[2], "score": found[3]})

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index table, one row per shard; every row of ``docs`` is in one shard."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(_index(), INDEX), "bm-index", options=GROUPS)


def _blocks(rows: Iterator) -> Iterator[list]:
    """Rows (q, t) in lists of QUERIES, or QUERY_BYTES about, at most."""
    block, held = [], 0
    for r in rows:
        if block and (len(block) == QUERIES or held + len(r.t) > QUERY_BYTES):
            yield block
            block, held = [], 0
        block.append(r)
        held += len(r.t)
    if block:
        yield block


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score of each query's best k documents with a score above 0; score rounded to DIGITS, ties by doc_id.

    A word counts as often as the query has it. Null or wordless queries and texts match nothing; a null document id ranks
    last among equals; a null query id is a query as any other. Repeated rows of documents are documents of their own, and
    so are repeated queries (their answers are told apart by nothing but their rows).
    """
    with session_conf(index.sparkSession, BATCH):
        return _top_k(index, queries, k, query_id, query_text)


def _top_k(index: DataFrame, queries: DataFrame, k: int, query_id: str, query_text: str) -> DataFrame:
    spark = index.sparkSession
    n, total = index.select("members", "lengths").mapInPandas(_sizes, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    n, total = n or 0, total or 0
    mean = total / n if total else 1.0
    found, asked = None, 0
    rows = queries.select(F.col(query_id).cast("long").alias("q"), F.col(query_text).cast("string").alias("t")).where("t is not null").orderBy("q", "t").toLocalIterator()
    for block in _blocks(rows):
        words, first = _terms(*tk.string_buffers(pa.array([r.t for r in block])))
        terms, word = np.unique(words, return_inverse=True)
        key, count = np.unique(np.repeat(np.arange(len(block)), np.diff(first)) * len(terms) + word, return_counts=True)
        df, sent = np.zeros(len(terms), np.int64), spark.sparkContext.broadcast(terms)
        seen = index.select("terms", "df").mapInPandas(_frequencies(sent), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # the block's words at most
        df[seen["term"].to_numpy()] = seen["df"].to_numpy()
        sent.destroy()
        row, word = key // max(1, len(terms)), key % max(1, len(terms))
        has = df[word] > 0
        row, word, weights = row[has], word[has], (count * idf(n, df)[word])[has]
        sent = spark.sparkContext.broadcast((np.arange(len(block)) + asked, pd.array([r.q for r in block], "Int64"), np.bincount(row, minlength=len(block)), terms, word.astype(np.int32), weights))
        part = materialize(index.mapInPandas(_answers(sent, k, mean), ANSWERS), "bm-answers")
        sent.destroy()
        found, asked = part if found is None else found.unionByName(part), asked + len(block)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "doc"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(F.col("known"), F.col("doc")).alias("doc_id"), "score")


SQL = """
WITH d AS (SELECT doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+')) AS w FROM documents),
t AS (SELECT doc_id, w, count(*) AS tf FROM d WHERE w <> '' GROUP BY ALL),
l AS (SELECT doc_id, sum(tf) AS dl FROM t GROUP BY ALL),
s AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM l) / (SELECT count(*) FROM documents) AS mean),
q AS (SELECT item_id, w, count(*) AS c FROM (SELECT item_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+')) AS w FROM benchmark WHERE item_id % 20 = 0) WHERE w <> '' GROUP BY ALL),
f AS (SELECT w, count(*) AS df FROM t WHERE w IN (SELECT w FROM q) GROUP BY ALL),
x AS (SELECT item_id, doc_id, round(sum(c * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
      FROM q JOIN t USING (w) JOIN f USING (w) JOIN l USING (doc_id), s GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id AS query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
