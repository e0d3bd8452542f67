"""S3, training windows from a stream of grid tokens, with timed keyed state.

State is keyed by (row, segment), a segment being whole windows that together are longer than the memory, so a token goes to two keys at
most. A key keeps arriving arrays in a list state, emits each window once its memory, inputs and labels are there, in whatever order they
came, and forgets the arrays when its last window is out. An event-time timer runs from the key's latest token: when
the watermark passes it, what is unfinished (a row's end, a token that never came) is freed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SEGMENT_OUT = "r bigint, w bigint, inputs array<bigint>, labels array<bigint>, memory array<bigint>"
LEAST_SEGMENT = 1 << 14  # tokens: a key costs some milliseconds a batch, whatever it holds


class Segments(StatefulProcessor):
    """Windows of one (row, segment)."""

    def __init__(self, T: int, mem_len: int, length: int, keep_ms: int):
        self.T, self.mem_len, self.length, self.keep_ms = T, mem_len, length, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", "cs binary, ids binary")  # int64 buffers: an array would be turned element by element
        self.told = handle.getValueState("told", "windows binary, latest bigint")  # a byte for each window, 1 if it is out; latest event time

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        r, seg = int(key[0]), int(key[1])
        first, n = seg * self.length // self.T, self.length // self.T
        frames = list(rows)
        new = frames[0] if len(frames) == 1 else pd.concat(frames)
        told = self.told.get()
        out, before = (np.zeros(n, bool), None) if told is None else (np.frombuffer(told[0], bool).copy(), told[1])
        latest = int(new["at"].max())
        if before is None or latest > before:
            if before is not None:
                self.handle.deleteTimer(before + self.keep_ms)
            self.handle.registerTimer(latest + self.keep_ms)
        latest = latest if before is None else max(latest, before)
        found = None
        if not out.all():  # else these are repeats of tokens that all went out
            parts = [[np.frombuffer(x, np.int64) for x in p] for p in self.parts.get()]
            c, size, here = (np.frombuffer(b"".join(new[x]), np.int64) for x in ("c", "n", "ids"))
            places = np.repeat(c - np.cumsum(size) + size, size) + np.arange(len(here))
            cs, at = np.unique(np.concatenate([p[0] for p in parts] + [places]), return_index=True)
            ids = np.concatenate([p[1] for p in parts] + [here])[at]
            hi = (first + np.arange(n)) * self.T + self.T
            lo = np.maximum(hi - self.T - self.mem_len, 0)
            a, b = np.searchsorted(cs, lo), np.searchsorted(cs, hi + 1)
            whole = np.flatnonzero(~out & (b - a == hi - lo + 1))
            out[whole] = True
            if len(whole):
                cut, end = b[whole] - 1 - self.T, b[whole] - 1
                slices = lambda x, y: [ids[i:j] for i, j in zip(x.tolist(), y.tolist(), strict=True)]
                found = pd.DataFrame({"r": r, "w": first + whole, "inputs": slices(cut, end), "labels": slices(cut + 1, end + 1), "memory": slices(a[whole], cut)})
            if out.all():
                self.parts.clear()
            else:
                a = int(a[np.argmin(out)])  # what lies before is of no more use
                if parts and (a or len(parts) > 16):
                    self.parts.put([(cs[a:].tobytes(), ids[a:].tobytes())])
                else:
                    self.parts.appendValue((places.tobytes(), here.tobytes()))
        self.told.update((out.tobytes(), latest))
        if found is not None:
            yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.parts.clear()
        self.told.clear()
        return iter(())

    def close(self) -> None:
        pass


def grid_runs(lines: DataFrame, B: int, N: int, length: int) -> DataFrame:
    """W2 + F2 on encoded lines (start_p, ids): (p, r, c, ids), a line's ids cut where a row of the grid or a run of ``length`` columns begins; ``c`` is
    the column of the first. What lies behind the grid is dropped."""
    S = N // B
    if S <= 0:
        return lines.select(F.col("start_p").alias("p"), F.lit(None).cast("bigint").alias("r"), F.lit(None).cast("bigint").alias("c"), "ids").limit(0)
    per = -(-S // length)  # runs in a row of the grid
    number = lambda p: f"({p}) div {S} * {per} + ({p}) % {S} div {length}"
    d = lines.where(F.expr(f"size(ids) > 0 and start_p < {B * S}"))
    d = d.select("start_p", "ids", F.explode(F.sequence(F.expr(number("start_p")), F.expr(number(f"least(start_p + size(ids), {B * S}) - 1")))).alias("_g"))
    d = d.select("start_p", "ids", F.expr(f"_g div {per}").alias("r"), F.expr(f"_g % {per}").alias("_k"))
    lo, hi = f"greatest(r * {S} + _k * {length}, start_p)", f"least(r * {S} + least((_k + 1) * {length}, {S}), start_p + size(ids))"
    d = d.select(F.expr(lo).alias("p"), "r", F.expr(f"{lo} - r * {S}").alias("c"), F.expr(f"slice(ids, cast({lo} - start_p + 1 as int), cast({hi} - {lo} as int))").alias("ids"))
    return d


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (r, seg, c, ids, ts, at), those of a batch that go to one key as one row: ``c`` and size of each run and all ids as int64 buffers, the
    latest ts and at. The stateful step takes some fifty microseconds a row."""
    least = np.iinfo(np.int64).min  # for a null
    for b in batches:
        if not b.num_rows:
            continue
        key = [b.column(i).fill_null(-1).to_numpy() for i in (0, 1)]
        order = np.lexsort((key[1], key[0]))
        b = b.take(pa.array(order))
        key = [x[order] for x in key]
        head = np.flatnonzero(np.concatenate([[True], (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])]))
        size = b.column(3).value_lengths().to_numpy().astype(np.int64)
        ends, tops = np.append(head, b.num_rows), np.concatenate([[0], np.cumsum(size)])
        c, ids = b.column(2).to_numpy(), b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        cut = lambda x, at: pa.array([x[i:j].tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
        last = [np.maximum.reduceat(x.cast(pa.int64()).fill_null(least).to_numpy(), head) for x in b.columns[4:6]]
        last = [pa.array(v, mask=v == least).cast(x.type) for v, x in zip(last, b.columns[4:6], strict=True)]
        of = pa.array(head)
        yield pa.RecordBatch.from_arrays([b.column(0).take(of), b.column(1).take(of), cut(c, ends), cut(size, ends), cut(ids, tops[ends]), *last], names=["r", "seg", "c", "n", "ids", "ts", "at"])


def stream_segments(grid: DataFrame, T: int, mem_len: int, delay: str, keep_ms: int, ts: str = "ts") -> DataFrame:
    """Streaming tokens (r, c, id, ``ts`` a timestamp), or runs of them (r, c of the first, ids, ts), as windows (r, w, inputs, labels, memory) of T inputs, labels one column later and the ``mem_len``
    tokens before. Each window is emitted once; a row's unfinished last window never is, as in the fixed-length form.

    ``delay`` is the watermark's; later tokens are dropped, unless they come in one piece with tokens of their key that are in time. A key is freed when the watermark passes its latest token by ``keep_ms``;
    a token of it that comes after that starts anew. Repeated tokens change nothing."""
    L = T * -(-max(mem_len + 1, LEAST_SEGMENT) // T)
    ids = F.col("ids") if "ids" in grid.columns else F.array("id")
    t = grid.select("r", "c", ids.alias("ids"), F.col(ts).alias("ts"), F.expr(f"unix_millis({ts})").alias("at"))
    seg = F.explode(F.expr(f"sequence(greatest((c - 1) div {L}, 0L), (c + size(ids) - 1 + {mem_len}) div {L})"))
    t = t.select(F.col("r").cast("bigint"), seg.alias("seg"), F.col("c").cast("bigint"), F.col("ids").cast("array<bigint>"), "ts", "at")
    schema = f"r bigint, seg bigint, c binary, n binary, ids binary, ts {t.schema['ts'].dataType.simpleString()}, at bigint"
    t = t.mapInArrow(_packed, schema).withWatermark("ts", delay)
    return t.groupBy("r", "seg").transformWithStateInPandas(statefulProcessor=Segments(T, mem_len, L, keep_ms), outputStructType=SEGMENT_OUT, outputMode="Append", timeMode="EventTime")
