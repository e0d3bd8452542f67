"""Structured Streaming jobs.

Each job reads a file stream, applies the same column expressions as the batch operators and
writes to a sink folder under the shared checkpoint folder with ``trigger(availableNow=True)``;
the caller gets the sink back as a DataFrame. Sources, sinks and stream checkpoints live in the
shared folder, so a lost executor or a restarted driver resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import tokenize
from tokenloom.operators import vocab as V
from tokenloom.operators.metrics import MetricSet
from tokenloom.session import work_path


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None, max_files: int | None = 1) -> DataFrame:
    """Parquet files as a stream, ``max_files`` of them a trigger at most (None: all there are)."""
    r = spark.readStream.schema(schema)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", max_files)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a streaming DataFrame over what is available and returns the sink. With the same checkpoint a later run goes on where this one
    ended. State that has timers needs the RocksDB store, which is set for the start of this query only."""
    spark, key = df.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode(mode).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(out)


def run_to_table(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """The same with a sink and checkpoint of its own in the work folder."""
    spark = df.sparkSession
    return run_available(df, work_path(spark, f"{name}-out"), work_path(spark, f"{name}-ck"), mode)


def stream_lines(docs: DataFrame) -> DataFrame:
    """A1 on a stream of documents (stateless)."""
    from tokenloom.sources.text import read_lines
    return read_lines(docs)


def stream_encode(lines: DataFrame, vocab: DataFrame, unk_id: int, lower: bool = False, eos: bool = True) -> DataFrame:
    """Arriving lines -> arrays of ids (doc_id, line_no, ids) by a fixed vocabulary. One whose measured size allows it goes to the tasks and whole
    arrays are looked up, so the stream isn't shuffled; a larger one is joined token by token: (doc_id, line_no, pos, id)."""
    t = lines.select("doc_id", "line_no", tokenize(F.col("line"), lower=lower, eos=eos).alias("symbols"))
    if V.fits_tasks(vocab):
        return V.encode_arrays(t, vocab, unk_id)
    t = t.select("doc_id", "line_no", F.posexplode("symbols").alias("pos", "sym"))
    return V.encode(t, vocab, unk_id, bounded=False).select("doc_id", "line_no", "pos", "id")


def stream_symbols(lines: DataFrame, lower: bool = False) -> DataFrame:
    """The symbols of arriving lines, one to a row (``sym``), without marks: the input of S2."""
    return lines.select(F.explode(tokenize(F.col("line"), lower=lower)).alias("sym"))


def stream_metrics(log: DataFrame, metrics: MetricSet, path: str, checkpoint: str, by: list[str] | None = None) -> DataFrame:
    """A caller's metrics over a streaming log, over what is available: each micro-batch writes the partial rows of its epoch (a batch that is run
    again writes the same folder again), and the result merges those of all epochs under ``path``."""
    def write(batch: DataFrame, epoch: int) -> None:
        metrics.partial(batch, by).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    q = log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return metrics.finals(metrics.merge(log.sparkSession.read.parquet(path), by), by)


def ntz_to_instant(col: str) -> F.Column:
    """TIMESTAMP_NTZ read as UTC -> TIMESTAMP, independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(col)))


def stream_throughput(events: DataFrame, window: str, delay: str, batch_size: int,
                      step: str = "event_id", loss: str = "value", ts: str = "ts") -> DataFrame:
    """Per event-time window: steps, mean loss, steps/s and examples/s; rows later than the
    watermark (max event time - ``delay``) are dropped; a window is written once closed."""
    e = events.withColumn("_t", ntz_to_instant(ts)).withWatermark("_t", delay)
    g = e.groupBy(F.window("_t", window).alias("win")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(loss).alias("mean_loss"),
        (F.max(step) - F.min(step)).alias("_steps"),
        F.timestamp_diff("MICROSECOND", F.min("_t"), F.max("_t")).alias("_us"))
    sps = F.when(F.col("_us") > 0, F.col("_steps") / (F.col("_us") / F.lit(1e6)))
    return g.select(F.unix_seconds(F.col("win.start")).alias("window_start"), "n", "mean_loss",
                    sps.alias("steps_per_sec"), (sps * F.lit(batch_size)).alias("examples_per_sec"))
