"""Built tables by settings and inputs: a change gives a new table, half-written ones are never read, two builders agree."""

import threading

from pyspark.sql import functions as F

from tokenloom.session import work_path
from tokenloom.sources.store import CorpusStore, files_digest, rows_digest


def test_keys(spark):
    store = CorpusStore(spark, work_path(spark, "store-test"))
    built = []

    def build(n):
        def run():
            built.append(n)
            return spark.range(n)
        return run

    assert store.get_or_build("t", {"a": 1, "b": (2, 3)}, "in", build(3)).count() == 3
    assert store.get_or_build("t", {"b": [2, 3], "a": 1}, "in", build(99)).count() == 3  # equal settings
    for settings, inputs, version, n in (({"a": 2, "b": (2, 3)}, "in", 1, 4), ({"a": 1, "b": (2, 3)}, "other", 1, 5), ({"a": 1, "b": (2, 3)}, "in", 2, 6)):
        assert store.get_or_build("t", settings, inputs, build(n), version).count() == n
    assert built == [3, 4, 5, 6] and store.row_count("t", store.key({"a": 1, "b": [2, 3]}, "in")) == 3
    assert store.find("u", "none") is None


def test_half_written(spark):
    """A builder that fails, or ends before its commit record, leaves nothing that is read."""
    store = CorpusStore(spark, work_path(spark, "store-half"))
    key = store.key({}, "x")
    spark.range(7).write.parquet(f"{store.root}/t/{key}/table-00000000")  # written, not committed
    try:
        store.get_or_build("t", {}, "x", lambda: spark.range(10).select(F.raise_error(F.concat(F.lit("no"), F.col("id"))).alias("id")))
        raise AssertionError("the build should fail")
    except Exception as e:
        assert "no" in str(e)
    assert store.find("t", key) is None
    assert store.get_or_build("t", {}, "x", lambda: spark.range(2)).count() == 2


def test_two_builders(spark):
    """Both find nothing, build at a time and commit; they and all readers then take the same folder."""
    store = CorpusStore(spark, work_path(spark, "store-two"))
    gate, got = threading.Barrier(2), []

    def build():
        gate.wait(60)
        return spark.range(5)

    def work():
        got.append(store.get_or_build("t", {}, "x", build).inputFiles())
    threads = [threading.Thread(target=work) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    key = store.key({}, "x")
    assert len(store._commits("t", key)) == 2 and store.find("t", key).count() == 5
    assert store.find("t", key).inputFiles() in got


def test_digests(spark):
    a, b = work_path(spark, "digest-a"), work_path(spark, "digest-b")
    df = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k long, v string")
    df.coalesce(1).write.parquet(a)
    before = files_digest(spark, a)
    assert files_digest(spark, a) == before
    df.write.mode("append").parquet(a)
    assert files_digest(spark, a) != before
    df.repartition(3).write.parquet(b)
    assert rows_digest(spark.read.parquet(b)) == rows_digest(df)
    assert len({rows_digest(x) for x in (df, df.distinct(), df.limit(0), df.withColumnRenamed("v", "w"), df.withColumn("v", F.coalesce("v", F.lit(""))))}) == 5
