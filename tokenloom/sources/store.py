"""Built tables kept under a key of their settings and inputs.

A table lies at ``root/name/key``, where ``key`` is a digest of the settings, of the inputs and of the builder's version. Each builder
writes to a folder of its own and then one commit record, last. Only committed folders are read, so a half-written table is never
seen; of two builders that ran at a time both may commit equal tables, and every reader takes the one whose folder sorts first.
Everything goes through Spark's readers and writers: the root may be any storage that they reach.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "folder string, row_count bigint, settings string"


def files_digest(spark: SparkSession, path: str) -> str:
    """Digest of the names, lengths and modification times of the files under ``path``; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = F.concat_ws("|", F.regexp_extract("path", r"([^/]*/)?[^/]*$", 0), F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    r = files.select(F.xxhash64(named).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("h")).first()
    return f"files:{r['n']}:{r['h']}"


def rows_digest(df: DataFrame) -> str:
    """Digest of the rows of a table as a set with repeats, whatever files they lie in: one scan."""
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    r = df.select(F.xxhash64(row).cast("decimal(38,0)").alias("a"), F.xxhash64(F.lit(1), row).cast("decimal(38,0)").alias("b")).agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    return f"rows:{df.schema.simpleString()}:{r['n']}:{r['a']}:{r['b']}"


class CorpusStore:
    """Tables by name, settings and inputs under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @staticmethod
    def key(settings: dict[str, Any], inputs: str, version: int = 1) -> str:
        """Settings are compared as JSON: their order doesn't matter, a tuple is a list."""
        return hashlib.sha256(json.dumps([settings, inputs, version], sort_keys=True, default=str).encode()).hexdigest()[:32]

    def _commits(self, name: str, key: str) -> list:
        try:
            found = self.spark.read.schema(COMMIT).json(f"{self.root}/{name}/{key}/commit/*").where("folder is not null").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(found, key=lambda r: r["folder"])

    def find(self, name: str, key: str) -> DataFrame | None:
        """The committed table, or None."""
        commits = self._commits(name, key)
        return self.spark.read.parquet(f"{self.root}/{name}/{key}/{commits[0]['folder']}") if commits else None

    def row_count(self, name: str, key: str) -> int | None:
        commits = self._commits(name, key)
        return commits[0]["row_count"] if commits else None

    def get_or_build(self, name: str, settings: dict[str, Any], inputs: str, build: Callable[[], DataFrame], version: int = 1) -> DataFrame:
        """The table of these settings and inputs; ``build`` runs only if none is committed."""
        key = self.key(settings, inputs, version)
        found = self.find(name, key)
        if found is not None:
            return found
        folder = f"table-{uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{key}/{folder}"
        build().write.parquet(path)
        n = self.spark.read.parquet(path).count()
        record = self.spark.createDataFrame([(folder, n, json.dumps(settings, sort_keys=True, default=str))], COMMIT)
        record.coalesce(1).write.json(f"{self.root}/{name}/{key}/commit/{folder}")
        return self.find(name, key)
