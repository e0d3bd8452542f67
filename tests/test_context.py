"""Context by segments, the stream of timed segments and the count table, against their definitions."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import context as CX
from tokenloom.session import work_path
from tokenloom.streaming import jobs as ST
from tokenloom.streaming.counts import CountTable, count_stream
from tokenloom.streaming.segments import stream_segments


def lines_of(spark, ids, seed):
    r, rows, p = random.Random(seed), [], 0
    while p < len(ids):
        n = min(len(ids) - p, r.choice((1, 2, 7, 50, 300)))
        rows.append((p, ids[p:p + n]))
        p += n
    return spark.createDataFrame(rows, "start_p long, ids array<long>").repartition(3)


def model(ids, B, T, mem, clamp, same):
    S = len(ids) // B
    out = {}
    for r in range(B):
        row = ids[r * S:r * S + max(S - 1, 0)]
        for w in range(-(-len(row) // T)):
            lo = max(w * T - mem, 0)
            seen = rep = dist = 0
            for c in range(w * T, min(w * T + T, len(row))):
                first = max(lo, c - mem) if same else lo
                seen += c - first + 1
                earlier = [k for k in range(first, c) if row[k] == row[c]]
                rep += bool(earlier)
                dist += min(c - earlier[-1], clamp) if earlier else 0
            out[r, w] = (row[lo:w * T], row[w * T:w * T + T], seen, rep, dist)
    return out


@pytest.mark.parametrize("n,B,T,mem", [(700, 3, 8, 20), (700, 3, 8, 3), (90, 2, 7, 100), (5, 4, 3, 2), (3, 4, 3, 2)])
def test_context(spark, monkeypatch, n, B, T, mem):
    monkeypatch.setattr(CX, "SEGMENT", 16)
    r = random.Random(n + T)
    ids = [r.randrange(0, 12) for _ in range(n)]
    lines, S = lines_of(spark, ids, n), n // B
    win = {(x.r, x.w): (x.memory, x.inputs) for x in CX.context_windows(lines, S, T, mem, B).collect()}
    for same in (True, False):
        want = model(ids, B, T, mem, 4, same)
        assert win == {k: v[:2] for k, v in want.items()}
        got = {(x.r, x.w): (x.visible, x.repeats, x.dist_sum) for x in CX.visible_context(lines, S, T, mem, same, 4, B).collect()}
        assert got == {k: v[2:] for k, v in want.items()}


def test_copies_are_bounded(spark):
    """However much longer than a window the memory is, a token moves at most twice, and no group holds more than a segment and a memory."""
    ids = [i % 91 for i in range(40_000)]
    for T, mem in ((32, 48), (128, 3800), (16, 9000)):
        cut = CX.context_segments(lines_of(spark, ids, T), len(ids) // 2, T, mem, 2).withColumn("n", F.size("ids"))
        assert cut.agg(F.sum("n")).first()[0] <= 2 * len(ids)
        assert cut.groupBy("r", "seg").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= CX.segment_length(T, mem) + mem
    plan = CX.visible_context(lines_of(spark, ids, 1), 20_000, 128, 3800, True, 10, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def write(spark, src, rows, schema):
    """One more file; the file source takes the older file first."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    time.sleep(1.1)


def test_segments_out_of_order_and_restart(spark):
    """Five batches in three runs of one checkpoint: tokens come out of order and twice, a window comes out when it is whole, and what never gets
    whole is freed by its timer, so that late repeats of it find nothing."""
    T, mem, S = 4, 6, 23
    schema = "r bigint, c bigint, id bigint, ts timestamp"
    src, out, ck = (work_path(spark, f"seg-{x}") for x in ("src", "out", "ck"))

    def tokens(r, columns, second):
        import datetime as dt
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
        return [(r, c, 100 * r + c, at) for c in columns]

    def run():
        stream = ST.file_stream(spark, src, schema)
        got = ST.run_available(stream_segments(stream, T, mem, "10 seconds", 20_000), out, ck)
        return {(x.r, x.w): (x.inputs, x.labels, x.memory) for x in got.collect()}, got.count()

    def want(r, w):
        lo = max(w * T - mem, 0)
        ids = [100 * r + c for c in range(S)]
        return ids[w * T:w * T + T], ids[w * T + 1:w * T + T + 1], ids[lo:w * T]

    odd, even = list(range(1, S, 2)), list(range(0, S, 2))
    write(spark, src, tokens(0, odd, 1) + tokens(1, range(0, 9), 1) + tokens(2, [0, 1, 2, 4], 1), schema)
    write(spark, src, tokens(0, even[:4], 2) + tokens(1, [9, 10], 2), schema)
    got, n = run()
    assert got == {(r, w): want(r, w) for r, w in ((0, 0), (1, 0), (1, 1))} and n == 3
    write(spark, src, tokens(0, even[::-1], 3) + tokens(1, range(8, 13), 3), schema)  # repeats too; the checkpoint holds what came before
    got, n = run()
    whole = {(0, w): want(0, w) for w in range(5)} | {(1, w): want(1, w) for w in range(3)}
    assert got == whole and n == len(whole)
    write(spark, src, tokens(9, range(0, 5), 100), schema)  # the watermark goes to 90 s: rows 0 to 2 are freed
    write(spark, src, tokens(9, range(5, 9), 101), schema)
    write(spark, src, tokens(2, [3], 102), schema)  # it would have made window (2, 0) whole
    got, n = run()
    whole |= {(9, w): want(9, w) for w in range(2)}
    assert got == whole and n == len(whole)


def test_count_table_replays(spark, monkeypatch):
    from tokenloom.streaming import counts as CT
    monkeypatch.setattr(CT, "FANOUT", 3)
    table = CountTable(spark, work_path(spark, "counts-test"))
    assert table.read().count() == 0
    r, want = random.Random(3), {}
    for epoch in range(8):
        words = [r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(40)]
        df = spark.createDataFrame([(w,) for w in words], "sym string")
        for w in words:
            want[w] = want.get(w, 0) + 1
        if epoch % 2:  # a writer that failed between run and ledger
            table._write(df.groupBy("sym").agg(F.count(F.lit(1)).alias("cnt")), 0)
        assert table.add(df, epoch)
        assert not table.add(df, epoch) and not table.add(df, epoch - 1)  # replays
        assert {x.sym: x.cnt for x in CountTable(spark, table.path).read().collect()} == want
    last, runs = table.ledger()
    assert last == 7 and sorted(x["level"] for x in runs) == [0, 0, 1, 1]
    assert table.count_of("a").first().cnt == want["a"] and table.count_of("nothing").count() == 0


def test_count_stream(spark):
    """Three files, one a trigger, and a second run over one more with the same checkpoint; a run's bytes follow its batch."""
    src, ck, table = work_path(spark, "cs-src"), work_path(spark, "cs-ck"), CountTable(spark, work_path(spark, "cs"))
    for k in range(3):
        write(spark, src, [(f"a b{k} a",)], "line string")
    symbols = lambda: ST.stream_symbols(ST.file_stream(spark, src, "line string"))
    count_stream(symbols(), table, ck)
    assert {x.sym: x.cnt for x in table.read().collect()} == {"a": 6, "b0": 1, "b1": 1, "b2": 1} and table.ledger()[0] == 2
    write(spark, src, [("a",)], "line string")
    count_stream(symbols(), table, ck)
    assert {x.sym: x.cnt for x in table.read().collect()}["a"] == 7
    runs = table.ledger()[1]
    assert table._read(runs[-1:]).count() == 1


def test_grid_runs(spark):
    """Runs hold the tokens of the grid, each within a row and a run of columns; windows come out of them as out of single tokens."""
    from tokenloom.streaming.segments import grid_runs
    ids = [random.Random(3).randrange(50) for _ in range(103)]
    runs = grid_runs(lines_of(spark, ids, 11), 4, len(ids), 7)
    got = {}
    for x in runs.collect():
        assert x.c // 7 == (x.c + len(x.ids) - 1) // 7
        for i, v in enumerate(x.ids):
            assert (x.r, x.c + i) not in got and x.p + i == x.r * 25 + x.c + i
            got[x.r, x.c + i] = v
    assert got == {(p // 25, p % 25): ids[p] for p in range(100)}
    assert grid_runs(lines_of(spark, ids[:3], 2), 4, 3, 7).count() == 0
    src, out, ck = (work_path(spark, f"runs-{x}") for x in ("src", "out", "ck"))
    t = runs.select("r", "c", "ids", F.timestamp_millis(F.col("p") + 86_400_000).alias("ts"))
    t.repartition(3).write.parquet(src)
    out = ST.run_available(stream_segments(ST.file_stream(spark, src, t.schema), 4, 6, "1 hour", 20_000), out, ck).collect()
    row = lambda r: ids[r * 25:r * 25 + 25]
    assert {(x.r, x.w): (x.inputs, x.labels, x.memory) for x in out} == {(r, w): (row(r)[4 * w:4 * w + 4], row(r)[4 * w + 1:4 * w + 5], row(r)[max(4 * w - 6, 0):4 * w]) for r in range(4) for w in range(6)}


def test_segments_get_a_row_for_each_key(spark):
    """The runs of a batch that go to one key reach the stateful step as one row, with all tokens and the latest time."""
    import pyarrow as pa
    from tokenloom.streaming.segments import _packed
    rows = [(0, 1, 40, [1, 2], 5, 50), (1, 0, 3, [7], 9, 90), (0, 1, 47, [3], 4, 40), (1, 0, 9, [], 2, 20), (0, 0, 1, [4, 5, 6], 8, 80)]
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.timestamp("us", "UTC"), pa.int64()]
    b = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names=["r", "seg", "c", "ids", "ts", "at"])
    out = [x for p in _packed(iter([b.slice(0, 0), b])) for x in p.to_pylist()]
    ints = lambda x: [int.from_bytes(x[i:i + 8], "little", signed=True) for i in range(0, len(x), 8)]
    got = [(x["r"], x["seg"], ints(x["c"]), ints(x["n"]), ints(x["ids"]), x["ts"].microsecond, x["at"]) for x in out]
    assert got == [(0, 0, [1], [3], [4, 5, 6], 8, 80), (0, 1, [40, 47], [2, 1], [1, 2, 3], 5, 50), (1, 0, [3, 9], [1, 0], [7], 9, 90)]
