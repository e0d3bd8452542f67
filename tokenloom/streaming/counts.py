"""S2, running symbol counts in a table of runs with an epoch ledger.

Each micro-batch is counted on its own and written as one run, bucketed by a hash of the symbol; its bytes follow the batch, not the
vocabulary, and there is no state store. A ledger entry, written last, names the live runs; an epoch at or below the
ledger's is a replay and counts nothing. When ``FANOUT`` runs of a level are there they are merged to one of the next level, bucket by bucket, so
a count is rewritten once per level.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 8
FANOUT = 8  # runs of a level that are merged
LEDGER = "epoch bigint, runs string"
RUN = "sym string, cnt bigint, bucket int"


class CountTable:
    """Counts under one folder of shared storage; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def ledger(self) -> tuple[int, list[dict]]:
        """(last epoch, its runs: name and level); (-1, []) of a new table."""
        try:
            last = self.spark.read.schema(LEDGER).json(f"{self.path}/ledger/*").orderBy(F.col("epoch").desc()).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        return (-1, []) if last is None else (last["epoch"], json.loads(last["runs"]))

    def _write(self, counts: DataFrame, level: int) -> dict:
        name = f"level{level}-{uuid.uuid4().hex}"  # never reused: what a failed attempt left is not in the ledger
        d = counts.withColumn("bucket", F.pmod(F.xxhash64("sym"), F.lit(BUCKETS)).cast("int"))
        d.repartition("bucket").sortWithinPartitions("bucket", "sym").write.partitionBy("bucket").parquet(f"{self.path}/runs/{name}")
        return {"name": name, "level": level}

    def _read(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], RUN)
        parts = [self.spark.read.schema(RUN).parquet(f"{self.path}/runs/{r['name']}") for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def add(self, symbols: DataFrame, epoch: int) -> bool:
        """Counts the column ``sym`` of one micro-batch; False if the epoch was counted before."""
        last, runs = self.ledger()
        if epoch <= last:
            return False
        runs = [*runs, self._write(symbols.groupBy("sym").agg(F.count(F.lit(1)).alias("cnt")), 0)]
        level = 0
        while len(full := [r for r in runs if r["level"] == level]) >= FANOUT:
            merged = self._write(self._read(full).groupBy("bucket", "sym").agg(F.sum("cnt").alias("cnt")).select("sym", "cnt"), level + 1)
            runs = [r for r in runs if r["level"] != level] + [merged]
            level += 1
        entry = self.spark.createDataFrame([(epoch, json.dumps(runs))], LEDGER)
        entry.coalesce(1).write.json(f"{self.path}/ledger/{epoch:012d}-{uuid.uuid4().hex}")
        return True

    def read(self) -> DataFrame:
        """(sym, cnt) of all epochs in the ledger."""
        return self._read(self.ledger()[1]).groupBy("bucket", "sym").agg(F.sum("cnt").alias("cnt")).select("sym", "cnt")

    def count_of(self, sym: str) -> DataFrame:
        """(sym, cnt) of one symbol; only its bucket is read."""
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(sym)), F.lit(BUCKETS)).cast("int")).first()[0]
        return self._read(self.ledger()[1]).where((F.col("bucket") == bucket) & (F.col("sym") == sym)).groupBy("sym").agg(F.sum("cnt").alias("cnt"))


def count_stream(symbols: DataFrame, table: CountTable, checkpoint: str) -> None:
    """Counts a stream of symbols (``sym``) over what is available. A batch that is run again after a failure, with the same
    epoch, counts once."""
    q = (symbols.select("sym").writeStream.foreachBatch(lambda batch, epoch: table.add(batch, epoch) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
