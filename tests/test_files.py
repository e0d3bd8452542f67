from tokenloom.operators import vocab as V
from tokenloom.sources import text as S


def test_text_files(spark, tmp_path):
    files = {f"part-{i}.txt": [f"w{i} line {j}" for j in range(40 * i + 1)] for i in range(4)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")  # several blocks in a file
    try:
        got = S.read_text_files(spark, f"{tmp_path}/part-*.txt").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got.sort(key=lambda r: (r["doc_id"], r["line_no"]))
    assert [(r["shard"], r["line"]) for r in got] == [(n, x) for n, lines in sorted(files.items()) for x in lines]
    assert len({r["doc_id"] for r in got}) > len(files)
    shards = S.split_by_shard(spark.createDataFrame(got), "shard").collect()
    assert sorted((r["shard"], r["split"]) for r in shards) == [("part-0.txt", "valid"), ("part-1.txt", "test"), ("part-2.txt", "train"), ("part-3.txt", "train")]


def test_vocabulary_and_merges_files(spark, tmp_path):
    (tmp_path / "vocab.txt").write_text("<S> 9\n<UNK> 3\nthe 2\na 1\nthe 1\n")
    v = V.vocab_from_file(S.file_lines(S.read_text_files(spark, f"{tmp_path}/vocab.txt")))
    assert sorted((r["id"], r["sym"]) for r in v.collect()) == [(0, "<S>"), (1, "<UNK>"), (2, "the"), (3, "a")]
    (tmp_path / "vocab.bpe").write_text("#version: 0.2\nt h\nth e\n")
    m = S.load_merges(S.file_lines(S.read_text_files(spark, f"{tmp_path}/vocab.bpe"), trailing=True))
    assert sorted((r["rank"], r["left"], r["right"]) for r in m.collect()) == [(0, "t", "h"), (1, "th", "e")]
    (tmp_path / "encoder.json").write_text('{"a": 0, "th": 256}')
    ids = S.load_piece_ids(spark.read.text(f"{tmp_path}/encoder.json", wholetext=True))
    assert {(r["piece"], r["id"]) for r in ids.collect()} == {("a", 0), ("th", 256)}
