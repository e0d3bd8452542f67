"""Examples of many streams at once, manifests read back, and array encoding, against index arithmetic."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import sharded as SD
from tokenloom.operators import vocab as V
from tokenloom.session import work_path
from tokenloom.sources import examples as EX


def streams_of(seed, n_streams=40):
    """Streams of several lengths, one of them a third of all tokens, and their pieces."""
    r = random.Random(seed)
    lengths = [r.choice((0, 1, 3, 17, 40, 95, 200)) for _ in range(n_streams)] + [3000]
    data, pieces = {}, []
    for k, n in enumerate(lengths):
        ids = [r.randrange(0, 60) for _ in range(n)]
        data[f"f{k:03d}"] = ids
        p = 0
        while p < n:
            size = min(n - p, r.choice((1, 2, 5, 30, 400)))
            pieces.append(("train", f"f{k:03d}", p, ids[p:p + size]))
            p += size
    return data, pieces


def model(ids, starts, B, T, C, fixed, bins):
    """Rows (w, r, inputs, labels, tuples of each side and bin) by definition."""
    flat = [x for s in starts for x in ids[s:] + ids[:s]]
    S = len(flat) // B
    W = 0 if S <= 1 else ((S - 1) // T if fixed else -(-(S - 1) // T))
    out, used = {}, {}
    for w in range(W):
        for r in range(B):
            lo = r * S + w * T
            n = min(T, r * S + S - 1 - lo)
            inputs, labels, tuples = flat[lo:lo + n], flat[lo + 1:lo + 1 + n], []
            for side, row in (("i", inputs), ("t", labels)):
                for b, (low, high, size) in enumerate(bins):
                    key, pairs = (w, r // (B // C), side, b), []
                    for at, x in enumerate(row):
                        if low <= x < high and used.get(key, 0) < size:
                            pairs += [at, used.get(key, 0)]
                            used[key] = used.get(key, 0) + 1
                    tuples.append(pairs)
            out[w, r] = (w * B + r, inputs, labels, tuples)
    return out


@pytest.mark.parametrize("fixed,passes", [(True, 1), (True, 3), (False, 2)])
def test_examples_of_streams(spark, monkeypatch, fixed, passes):
    monkeypatch.setattr(SD, "CHUNK_BYTES", 2000)  # several chunks a file
    data, pieces = streams_of(passes)
    df = spark.createDataFrame(pieces, "split string, basename string, start_p long, ids array<long>").repartition(5)
    B, T, C = 4, 5, 2
    plain = SD.stream_table(df, B, T, fixed)
    starts = SD.random_starts(plain, passes, 7)
    streams = SD.stream_table(df, B, T, fixed, starts)
    of = {r.basename: r for r in streams.collect()}
    cutoffs, sizes = [0, 10, 25, 60], [3, 4]
    ex = SD.examples_of_streams(df, streams, B, T, C, cutoffs if fixed else None, sizes if fixed else None, fixed)
    got = {(r.basename, r.w, r.r): r for r in ex.collect()}
    seen = 0
    for name, ids in data.items():
        if not ids:
            assert name not in of
            continue
        assert of[name].n == len(ids) and len(of[name].starts) == passes and all(0 <= s < len(ids) for s in of[name].starts)
        want = model(ids, of[name].starts, B, T, C, fixed, [(10, 25, 3), (25, 60, 4)] if fixed else [])
        assert of[name].W == len({w for w, _ in want})
        for (w, r), (sample, inputs, labels, tuples) in want.items():
            row = got[name, w, r]
            assert (row.sample_id, row.inputs, row.labels) == (sample, inputs, labels)
            if fixed:
                assert [list(x.tup) for x in row.inp_bins] + [list(x.tup) for x in row.tgt_bins] == tuples
        seen += len(want)
    assert seen == len(got)


def test_shuffled_pieces(spark):
    """Each shuffle holds every sentence once, in the order of its key; a sentence cut into pieces stays together."""
    import hashlib
    r = random.Random(2)
    rows = [(r.choice("aab"), d, line, k * 2, [d, line, k]) for d in range(40) for line in range(3) for k in range(r.randrange(1, 4))]
    df = spark.createDataFrame(rows, "shard string, doc_id long, line_no int, start_pos long, ids array<long>").repartition(4)
    shard_of = {}
    for s, d, line, _, _ in rows:
        shard_of.setdefault((d, line), s)
    df = df.withColumn("shard", F.element_at(F.create_map(*[F.lit(x) for (d, line), s in shard_of.items() for x in (f"{d}:{line}", s)]), F.concat_ws(":", "doc_id", "line_no")))
    got = SD.shuffled_pieces(df, 3, 5).collect()
    for shard in "ab":
        for shuffle in range(3):
            mine = sorted((x for x in got if x["shard"] == shard and x["shuffle"] == shuffle), key=lambda x: x.start_p)
            order = sorted(((hashlib.md5(f"5:{shard}:{shuffle}:{d}:{line}".encode()).hexdigest(), d, line, p, ids) for _, d, line, p, ids in rows if shard_of[d, line] == shard))
            flat = [i for *_, ids in order for i in ids]
            assert [i for x in mine for i in x.ids] == flat and [x.start_p for x in mine] == [3 * k for k in range(len(mine))]


def test_manifest(spark):
    data, pieces = streams_of(9, 6)
    df = spark.createDataFrame(pieces, "split string, basename string, start_p long, ids array<long>")
    B, T, C = 2, 4, 1
    df = df.withColumn("basename", EX.example_file_name_col(F.col("basename"), B, T, C, True))
    streams, sizes = SD.stream_table(df, B, T, True), [8, 8]
    path, info = work_path(spark, "manifest-test"), work_path(spark, "manifest-info")
    EX.write_example_files(SD.examples_of_streams(df, streams, B, T, C, [0, 10, 25, 60], sizes, fixed=True), path)
    EX.write_record_info(EX.record_info_of_streams(streams, sizes), info, B, T, C, True)
    batches = streams.agg(F.sum("W")).first()[0]
    assert EX.read_listed(spark, path, info, "train", B, T, C, True).count() == batches * B
    # a file that isn't listed is not read, and a manifest that states other things is refused
    other = streams.where("basename < 'f003'")
    EX.write_record_info(EX.record_info_of_streams(other, sizes), info + "-some", B, T, C, True)
    some = EX.read_listed(spark, path, info + "-some", "train", B, T, C, True)
    assert some.count() == B * other.agg(F.sum("W")).first()[0] and some.select("basename").distinct().count() < streams.count()
    assert re.search(r"PartitionFilters: \[[^\]]*basename", some._jdf.queryExecution().toString())
    EX.write_record_info(EX.record_info_of_streams(streams.withColumn("W", F.col("W") + 1), sizes), info + "-count", B, T, C, True)
    EX.write_record_info(EX.record_info_of_streams(streams, [1, 8]), info + "-bins", B, T, C, True)
    for wrong in ("-count", "-bins"):
        with pytest.raises(ValueError):
            EX.read_listed(spark, path, info + wrong, "train", B, T, C, True)
    with pytest.raises(Exception):
        EX.read_listed(spark, path, info, "train", B, T + 1, C, True)
    EX.write_record_info(EX.record_info_of_streams(streams.withColumn("basename", F.lit("x")), sizes), info + "-name", B, T, C, True)
    with pytest.raises(ValueError):
        EX.read_listed(spark, path, info + "-name", "train", B, T, C, True)


def test_encode_arrays(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "é"), (2, "<unk>")], "id long, sym string")
    rows = [(1, ["a", "é", "zz", "a"]), (2, []), (3, ["<unk>"]), (4, ["a"] * 1000)]
    df = spark.createDataFrame(rows, "k long, symbols array<string>")
    got = {r.k: r.ids for r in V.encode_arrays(df, vocab, 2).collect()}
    assert got == {1: [0, 1, 2, 0], 2: [], 3: [2], 4: [0] * 1000}
    assert V.encode_arrays(df.limit(0), vocab, 2).count() == 0
    assert {r.k: r.ids for r in V.encode_arrays(df, vocab.limit(0), 2).collect()}[1] == [2, 2, 2, 2]
    with pytest.raises(Exception, match="unknown symbol: zz"):
        V.encode_arrays(df, vocab, None).collect()


def test_both_ways_of_encoding(spark, monkeypatch):
    """A vocabulary beyond the size for tasks is joined, with equal arrays; long lines come in pieces."""
    from tokenloom.plans import word_corpus as WC
    monkeypatch.setattr(WC, "PIECE", 3)
    r = random.Random(1)
    rows = [("s", d, n, 100 * d, [r.choice("abcdef") for _ in range(r.randrange(0, 12))]) for d in range(30) for n in range(2)]
    df = spark.createDataFrame(rows, "split string, doc_id long, line_no int, start_p long, symbols array<string>")
    vocab = spark.createDataFrame([(i, s) for i, s in enumerate("abcd_")], "id long, sym string")

    def pieces():
        return sorted(tuple(map(str, x)) for x in WC.encoded_pieces(df, vocab, 4).where("size(ids) > 0").collect())
    one = pieces()
    monkeypatch.setattr(V, "ENCODE_BYTES", 0)
    assert pieces() == one and len(one) > 60


def test_decode_arrays(spark):
    vocab = spark.createDataFrame([(3, "c"), (0, "<eos>"), (7, "é")], "id long, sym string")
    df = spark.createDataFrame([(1, [3, 7, 0]), (2, []), (3, [0]), (4, None), (5, [7] * 3)], "k long, ids array<long>")
    assert {r.k: r.text for r in V.decode_arrays(df, vocab, exclude=[0]).collect()} == {1: "c é", 2: "", 3: "", 4: "", 5: "é é é"}
    with pytest.raises(Exception, match="id out of range: 5"):
        V.decode_arrays(spark.createDataFrame([(1, [3, 5])], df.schema), vocab).collect()
