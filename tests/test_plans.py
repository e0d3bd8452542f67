"""Two-level positions and ranks, partition-count invariance, examples on disk, feeding,
streaming equal to batch, and the driver entry points."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF001
from tokenloom.operators.positions import ordered_index, prefix_offsets


def test_prefix_offsets_and_rank(spark):
    rnd = random.Random(11)
    rows = [(k % 3, k, rnd.randrange(0, 10)) for k in range(500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "part int, key bigint, w bigint").repartition(7)
    got = prefix_offsets(df, F.col("w"), ["part"], [F.col("key")], F.floor(F.col("key") / 37), "start")
    want = df.withColumn("start", F.sum("w").over(Window.partitionBy("part").orderBy("key")) - F.col("w"))
    assert got.select("part", "key", "start").exceptAll(want.select("part", "key", "start")).count() == 0
    from tokenloom.operators.positions import coarser
    got3 = prefix_offsets(df, F.col("w"), ["part"], [F.col("key")], F.floor(F.col("key") / 7), "start", coarsen=coarser(4))
    assert got3.select("part", "key", "start").exceptAll(want.select("part", "key", "start")).count() == 0
    idx = ordered_index(df, [], [F.col("w").desc(), F.col("key")], F.struct((-F.col("w")).alias("a"), F.floor(F.col("key") / 50).alias("b")))
    want = df.withColumn("idx", F.row_number().over(Window.orderBy(F.col("w").desc(), "key")) - 1)
    assert idx.select("key", "idx").exceptAll(want.select("key", F.col("idx").cast("bigint"))).count() == 0


def test_same_result_for_1_4_16_partitions(spark):
    from tokenloom.plans import queries as Q
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            Q.clear_corpus_cache()
            df = Q.q_windows_fixed(spark, SF001)
            results.append(sorted(tuple(r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert results[0] == results[1] == results[2]


def test_examples_roundtrip_and_feed(spark):
    from tokenloom.operators import feed as FD
    from tokenloom.plans import queries as Q
    from tokenloom.plans import word_corpus as WC
    from tokenloom.session import work_path
    from tokenloom.sources import examples as EX
    c = Q.Corpus(spark, SF001)
    ex = WC.build_examples(c.split(), c.N["train"], 4, 8, 2, c.cutoffs, [8, 8, 8], fixed=True)
    path = work_path(spark, "ex-test")
    EX.write_examples(ex, path, "train", "train")
    back = EX.read_examples(spark, path, 8, fixed=True, split="train")
    assert back.count() == ex.count()
    assert dict(back.dtypes)["inputs"] == "array<int>"
    info = EX.record_info(back, 4, 8, 2, True, [8, 8, 8]).collect()[0]
    assert info["filenames"] == ["train.bsz-4.tlen-8.core-2"]
    assert info["num_batch"] == ex.select("w").distinct().count()
    assert info["bin_sizes"] == [8, 8, 8]
    # replica slots: each chunk of b samples goes to one replica; host ranges cover [0, hosts*k)
    rs = FD.replica_slots(back, 2, 2).select("sample_id", "chunk", "replica", "step").collect()
    assert all(r["chunk"] == r["sample_id"] // 2 and r["replica"] == r["chunk"] % 2 for r in rs)
    nb = info["num_batch"]
    hr = FD.host_ranges(back, nb, 2, 2, 2)
    k = (nb // 2) * 2 * 2
    assert hr.count() == 2 * k and hr.agg(F.max("sample_id")).first()[0] == 2 * k - 1
    pad = FD.pad_last_batch(back, 7, 8, back.count())
    assert pad.count() % 7 == 0 and pad.filter("not is_padding").count() == back.count()


def test_cached_reuses_table(spark):
    from tokenloom.session import work_path
    from tokenloom.sources.examples import cached
    path = work_path(spark, "cache-test")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert cached(spark, path, build).count() == 5
    assert cached(spark, path, build).count() == 5
    assert len(calls) == 1


def test_guards(spark):
    from tokenloom.operators import vocab as V
    lines = spark.createDataFrame([(0, "the 3"), (1, "a 2")], "line_no bigint, line string")
    with pytest.raises(ValueError):
        V.vocab_from_file(lines, unk="<UNK>")
    with pytest.raises(ValueError):
        from tokenloom.functions.text import tokenize
        tokenize(F.col("x"), delimiter="", eos=True)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["w", "r", "sample_id", "inputs", "labels"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_segments_equal_batch(spark):
    from tokenloom.plans import queries as Q
    got = Q.q_stream_segments(spark, SF001)
    ctx = Q._context(spark, SF001)
    fixed = Q.q_windows_fixed(spark, SF001)
    want = fixed.join(ctx.select("r", "w", "memory"), ["r", "w"]).select(
        "r", "w", "inputs", "labels", F.array_join(F.transform("memory", lambda x: x.cast("string")), " ").alias("memory"))
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_manifest_and_corpus_info_read_back(spark):
    from tokenloom.plans import queries as Q
    from tokenloom.session import work_path
    from tokenloom.sources import examples as EX
    c = Q.corpus(spark, SF001)
    ci = EX.corpus_info(c.vocab, c.cutoffs, "wt103")
    path = work_path(spark, "corpus-info")
    ci.select("json").write.text(path)
    back = spark.read.text(path).select(F.from_json("value", EX.CORPUS_INFO_SCHEMA).alias("j")).select("j.*").collect()[0]
    assert back["vocab_size"] == c.V and back["cutoffs"] == c.cutoffs and back["dataset"] == "wt103"
    from tokenloom.plans import word_corpus as WC
    ex = WC.build_examples(c.split(), c.N["train"], 4, 8, 2, fixed=False)
    ri = EX.record_info(ex.withColumn("split", F.lit("train")).withColumn("basename", F.lit("train")), 4, 8, 2, False, [])
    rpath = work_path(spark, "record-info")
    ri.select("json").write.text(rpath)
    info = EX.load_record_info(spark, rpath).collect()[0]
    assert info["filenames"] == ["train.bsz-4.tlen-8"] and info["bin_sizes"] == []
    assert info["num_batch"] == ex.select("w").distinct().count()


def test_stream_throughput_drops_late_rows(spark):
    """Three micro-batches. Late rows are filtered with the watermark of the previous batch
    (Spark keeps one watermark for late rows and one for eviction), so the late rows come two
    batches after the data that moved the watermark; they are dropped, and only windows closed
    by the watermark are written."""
    import datetime as dt
    import time
    from tokenloom.session import work_path
    from tokenloom.streaming import jobs as ST
    src = work_path(spark, "late-src")
    schema = "event_id bigint, ts timestamp_ntz, value double"
    day = dt.datetime(2024, 1, 1)
    batches = [
        [(i, day + dt.timedelta(hours=i), 1.0) for i in range(0, 60)],                       # 2.5 days
        [(60, day + dt.timedelta(hours=59, minutes=30), 1.0)],                                # on time
        [(1000 + i, day + dt.timedelta(hours=1, minutes=i), 100.0) for i in range(5)],        # day 0: late
    ]
    for rows in batches:  # the file source takes the older file first, one file per micro-batch
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    ev = ST.file_stream(spark, src, schema, glob="*.parquet")
    out = ST.run_to_table(ST.stream_throughput(ev, "1 day", "1 hour", 16), "late").orderBy("window_start").collect()
    # watermark = 59h - 1h = 58h: days 0 and 1 are closed, day 2 is still open
    assert [r["n"] for r in out] == [24, 24]
    assert all(r["mean_loss"] == 1.0 for r in out)


def test_dense_perms_equal_dense_perm(spark):
    import pyarrow as pa
    from tokenloom.operators import windows as W_
    tups = [[], [0, 0], [1, 2, 3, 1], [0, 1, 2, 3, 3, 2]]
    want = spark.createDataFrame([(i, t) for i, t in enumerate(tups)], "i int, tup array<bigint>").select("i", W_.dense_perm(F.col("tup"), 4, 3).alias("m")).collect()
    got = W_.dense_perms(pa.array(tups, pa.list_(pa.int64())), 4, 3)
    assert {x.i: x.m for x in want} == {i: m.tolist() for i, m in enumerate(got)}


def test_feed_has_files_by_size(spark, monkeypatch):
    """A feed of a larger table has more files, none of them larger, still in four batches."""
    from tokenloom.plans import queries as Q
    from tokenloom.streaming import jobs as ST
    monkeypatch.setattr(Q, "FILE_BYTES", 1000)
    seen = []
    monkeypatch.setattr(ST, "file_stream", lambda spark, path, schema, max_files: seen.append((path, max_files)))
    df = spark.createDataFrame([(i, "x" * 92) for i in range(200)], "doc_id long, text string")
    Q._feed(spark, df, "feed-test", "doc_id")
    path, most = seen[0]
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 12 and max(x["count"] for x in files) < 40 and 4 <= most <= 6
    assert spark.read.parquet(path).count() == 200
