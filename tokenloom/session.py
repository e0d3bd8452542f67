"""Session helpers: building a session for tests/bench, shared work folders, materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              driver_memory: str = "16g", app: str = "tokenloom") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is used instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.driver.memory", driver_memory)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    b = b.config("tokenloom.scan.partitions", str(cpus))  # the bench's tables are single files
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None when unset)."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - connect sessions have no SparkContext
        d = None
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # pragma: no cover
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Read the checkpoint folder from the session; only where it is unset (local tests)
    create one of our own."""
    d = checkpoint_dir(spark)
    if d:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(d)
        except Exception:  # pragma: no cover
            pass
        return d
    if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master", "").startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="tokenloom-ckpt-")  # a local master: one machine
    try:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    except Exception:  # pragma: no cover - connect sessions: the folder is only used for writes
        return d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for this application under the shared checkpoint folder."""
    return f"{_work_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _work_base(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokenloom-{spark.sparkContext.applicationId}"


def remove_work(spark: SparkSession) -> None:
    """Deletes every table that this application has written by ``work_path``. Results read from them
    must be written elsewhere before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_work_base(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs that run inside; those of before come back after."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, name: str = "table", compression: str | None = None, options: dict | None = None) -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder and read back.

    Used where a table is read by several later jobs (vocabulary, encoded stream): a lost
    executor does not replay the whole upstream plan, repeated reads do not recompute it, and
    later reads get Parquet column pruning and filter pushdown. (A plain ``checkpoint()`` of an
    unpersisted DataFrame computes the plan twice.) ``compression``: the codec of its files (None: the session's);
    ``options``: others of the writer.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.options(**(options or {})).parquet(path, compression=compression)
    return spark.read.parquet(path)
