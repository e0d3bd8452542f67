"""Operator 7, token-id files with canonical, length-limited Huffman codes.

Ids are counted over the whole corpus; code lengths come from package-merge with a limit of ``LIMIT`` bits, and the
codes are canonical, so the header holds lengths only. The file is a folder: ``header`` (one row: the lengths) and
``segments``, Parquet rows in ascending document order, each with the documents it holds, the bits of their ids and the bit offset of
every ``BLOCK``-th id. Each block can thus be decoded on its own; a reader decodes one id of all blocks of
a segment at a time through a table of 2**LIMIT entries at most.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import textkernel as tk
from tokenloom.llm.bpe_codec import Bpe, latin
from tokenloom.llm.wordtable import WordTable, ranges
from tokenloom.session import work_path

LIMIT = 18
BLOCK = 128  # ids between checkpoints
SEGMENT = 1 << 20  # ids in a segment, about; a longer document is a segment of its own
END = 1
JOINED, TEXTS = 250, 16  # words joined to one text, and texts that one call of the library gets
PIECES = 1 << 20  # pieces kept at most with their ids; a fuller table starts anew


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that never occur."""
    out = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(leaves))
        both = both[order][:len(both) // 2 * 2]
        packages = both[::2] + both[1::2]
    take = 2 * len(leaves) - 2
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        out[used[:n]] += 1
        take = 2 * (take - n)
    return out


class Code:
    """Canonical code of given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        self.width = int(lengths.max(initial=0)) or 1
        span = np.int64(1) << (self.width - self.lengths[order])
        start = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = (start >> (self.width - self.lengths[order])).astype(np.uint64)
        self.table = np.zeros(1 << self.width, dtype=np.int32)
        self.table[:int(span.sum())] = np.repeat(order, span)
        self.table_bits = self.lengths[self.table]

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of every BLOCK-th id)."""
        bits = self.lengths[ids]
        end = np.cumsum(bits)
        at = end - bits
        code = self.codes[ids]
        word, used = at >> 6, (at & 63) + bits
        out = np.zeros((int(end[-1]) >> 6) + 2 if len(ids) else 1, dtype=np.uint64)
        if len(ids):
            high = np.where(used <= 64, code << (64 - np.minimum(used, 64)).astype(np.uint64), code >> np.maximum(used - 64, 0).astype(np.uint64))
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            out[word[head]] = np.bitwise_or.reduceat(high, head)
            over = np.flatnonzero(used > 64)
            out[word[over] + 1] |= code[over] << (128 - used[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[:(int(end[-1]) + 7) // 8 if len(ids) else 0], at[::BLOCK].astype(np.int64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of a segment, all blocks side by side."""
        raw = np.frombuffer(bits + bytes(8), dtype=np.uint8).astype(np.uint32)
        at = checkpoints.astype(np.int64).copy()
        last = len(raw) - 4
        out = np.empty((len(at), min(BLOCK, n)), dtype=np.int32)
        for i in range(out.shape[1]):
            b = np.minimum(at >> 3, last)
            window = raw[b] << np.uint32(24) | raw[b + 1] << np.uint32(16) | raw[b + 2] << np.uint32(8) | raw[b + 3]
            key = (window << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.width)
            out[:, i] = self.table[key]
            at += self.table_bits[key]
        return out.reshape(-1)[:n]


def library_encoder(spec: str):
    """Words -> ids by the tokenizers library, many words to a call; the cut between words comes from their pieces.

    A printable word of Latin characters without "<", which special tokens have, is the ids of its lower-cased pieces, one after another: each
    distinct piece goes to the library once, in lower case and so past the normaliser. Any other word goes there whole."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
    from tokenizers import Tokenizer
    lib, bpe = Tokenizer.from_str(spec), Bpe(spec)
    lib.no_truncation()
    lib.no_padding()
    normalizer = lib.normalizer
    ends = np.zeros(len(bpe.names), dtype=bool)  # ids that end a piece
    ends[bpe.last] = True
    ends[list(bpe.special.values())] = True
    order = np.argsort(bpe.ranks)
    right = (bpe.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)[order]
    for r, made in zip(right.tolist(), bpe.made.tolist(), strict=True):
        ends[made] |= ends[r]

    known: dict[str, int] = {}  # pieces, and words that go whole: their places in the arrays
    whole: dict[str, int] = {}  # of the words that go whole: their pieces
    start, size, flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal start, size, flat
        if len(known) > PIECES:
            known.clear()
            whole.clear()
            start, size, flat = start[:0], size[:0], flat[:0]
        before, used, per_word, split, place = len(known), [], [], bpe.split, known.setdefault
        for w in words:
            if w.isalpha():
                if w.isascii() or latin(w):
                    per_word.append(1)
                    used.append(place(w.lower(), len(known)))
                    continue
            elif "<" not in w and w.isprintable() and (w.isascii() or latin(w)):
                parts = split(w.lower())
                per_word.append(len(parts))
                for x in parts:
                    used.append(place(x, len(known)))
                continue
            per_word.append(1)
            used.append(place(w, len(known)))
            if w not in whole:
                whole[w] = len(bpe.pieces(w))
        new = list(islice(known, before, None))
        if new:
            done = [some(new[i:i + JOINED * TEXTS]) for i in range(0, len(new), JOINED * TEXTS)]
            ids, n = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
            start, size, flat = np.concatenate([start, len(flat) + np.cumsum(n) - n]), np.concatenate([size, n]), np.concatenate([flat, ids.astype(np.int32)])
        at = np.array(used, dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(size[at])])
        return flat[ranges(start[at], size[at])], np.diff(ends[np.concatenate([[0], np.cumsum(np.array(per_word, dtype=np.int64))])])

    def some(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = np.cumsum([whole.get(w, 1) for w in words])
        texts = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        odd = [not whole.keys().isdisjoint(x) for x in texts]
        parts = {}
        for o in (False, True):
            lib.normalizer = normalizer if o else None  # pieces are normalised already
            parts[o] = iter(lib.encode_batch_fast([" ".join(x) for x, y in zip(texts, odd, strict=True) if y == o], add_special_tokens=False))
        ids = np.fromiter(chain.from_iterable([next(parts[o]).ids for o in odd]), dtype=np.int64)
        stop = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1])
        if len(stop) - 1 != (pieces[-1] if len(words) else 0):
            raise ValueError("the tokenizer file cuts words otherwise than its pattern says")
        return ids, np.diff(np.concatenate([[0], stop[pieces]]))

    return encode


_kept: dict[int, WordTable] = {}


def _ids(spec):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        key = hash(spec.value)
        if key not in _kept:
            _kept.clear()
            _kept[key] = WordTable(library_encoder(spec.value))
        table = _kept[key]
        for b, data, offs in tk.chunks(batches, chunk_bytes=2 << 20):
            ids, at = table.ids(data, offs)
            ids = np.insert(ids, at[1:], END).astype("<u2" if len(table.flat) == 0 or ids.max(initial=0) < 1 << 16 else "<u4")
            at = at + np.arange(len(at))
            width = ids.dtype.itemsize
            raw = ids.tobytes()
            mark = b"\x02" if width == 2 else b"\x04"
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([mark + raw[i * width:j * width] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())], schema=schema)

    return run


def _unpacked(col: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype="<u2" if x[0] == 2 else "<u4", offset=1) for x in col.to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]):
    total = np.zeros(0, dtype=np.int64)
    for b in batches:
        rows = _unpacked(b.column(0))
        for lo in range(0, len(rows), 256):
            n = np.bincount(np.concatenate(rows[lo:lo + 256]))
            if len(n) > len(total):
                total = np.pad(total, (0, len(n) - len(total)))
            total[:len(n)] += n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "c"])


SEGMENTS = "part long, start long, n long, docs binary, known binary, sizes binary, bits binary, checkpoints binary"


def _segments(lengths):
    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.binary()] * 5

    def run(batches):
        code, start, part = Code(np.frombuffer(lengths.value, dtype=np.uint8)), 0, TaskContext.get().partitionId()  # ranges of ids are numbered in order

        def segment(docs, ids):
            nonlocal start
            flat = np.concatenate(ids).astype(np.int64)
            bits, points = code.encode(flat)
            known = np.array([d is not None for d in docs], dtype=np.uint8)
            row = [part, start, len(flat), np.array([d or 0 for d in docs], "<i8").tobytes(), known.tobytes(), np.array([len(x) for x in ids], "<i8").tobytes(), bits, points.astype("<i8").tobytes()]
            start += len(flat)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

        docs, ids, held = [], [], 0
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), _unpacked(b.column(1)), strict=True):
                if held and held + len(x) > SEGMENT:
                    yield segment(docs, ids)
                    docs, ids, held = [], [], 0
                docs.append(d)
                ids.append(x)
                held += len(x)
        if docs:
            yield segment(docs, ids)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes whole texts, END after each, and writes the file in ascending id order (nulls first, equal ids by their ids)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids_path = work_path(spark, "tf-ids")
    rows.mapInArrow(_ids(spec), "doc_id long, ids binary").write.option("compression", "zstd").parquet(ids_path)
    ids = spark.read.parquet(ids_path)
    counted = ids.select("ids").mapInArrow(_count, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).collect()  # one row for each id of the vocabulary
    counts = np.zeros(max((r.id for r in counted), default=0) + 1, dtype=np.int64)
    for r in counted:
        counts[r.id] = r.c
    lengths = bytearray(code_lengths(counts).tobytes())
    spark.createDataFrame([(lengths,)], "lengths binary").coalesce(1).write.parquet(f"{path}/header")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = ids.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    placed.mapInArrow(_segments(spark.sparkContext.broadcast(bytes(lengths))), SEGMENTS).write.option("compression", "none").parquet(f"{path}/segments")


def _read(lengths, with_ids: bool):
    schema = pa.schema([("part", pa.int64()), ("start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        code = Code(np.frombuffer(lengths.value, dtype=np.uint8))
        for b in batches:
            for s in range(b.num_rows):
                r = {n: b.column(i)[s].as_py() for i, n in enumerate(b.schema.names)}
                sizes = np.frombuffer(r["sizes"], "<i8")
                ids = code.decode(r["bits"], np.frombuffer(r["checkpoints"], "<i8"), r["n"])
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                known = np.frombuffer(r["known"], np.uint8) == 0
                cols = [pa.array([r["part"]] * len(sizes), pa.int64()), pa.array(r["start"] + at[:-1]), pa.array(np.frombuffer(r["docs"], "<i8"), mask=known), pa.array(sizes), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids)."""
    lengths = spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{path}/header").first()[0]))
    segments = spark.read.parquet(f"{path}/segments")
    parts = segments.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row for each file part
    before, rows = 0, []
    for p in parts:
        rows.append((p.part, before))
        before += p.n
    offsets = F.broadcast(spark.createDataFrame(rows, "part long, before long"))
    out = segments.mapInArrow(_read(lengths, with_ids), "part long, start long, doc_id long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    out = out.join(offsets, "part")
    return out.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def round_trip(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """Writes the file under the shared work folder and reads it back.

    A null text is empty: its only id is END. Null ids come first; repeated rows stay, one after another. No document: no rows.
    """
    path = work_path(docs.sparkSession, "token-file")
    write_ids(docs, path, tokenizer_path)
    return read_ids(docs.sparkSession, path, with_ids)
