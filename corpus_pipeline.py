"""Corpus pipeline: documents -> token ids of the documents kept, over the operators of tokenloom.llm.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last return
the columns of ``documents``. Decisions are applied by row, not by doc_id: a row's key is a hash of its id (null or not) and text, so
rows that share an id, or have none, go or stay by their own text. Without rows every stage gives none; columns beyond those of
``documents`` are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.llm import bpe_codec, decontaminate, jaccard_join, language_id, line_dedup, queries
from tokenloom.session import materialize

ORACLE_SQL = None  # the stages aren't expressible in SQL; tests hold them against brute force


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a row key (64 bits of id and text, in a column of a free name); equal rows have one key."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")), name


BROADCAST_KEYS = 1_000_000  # row keys (8 bytes each) that are broadcast at most to drop their rows; more go through a shuffle


def _without(keyed: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    gone = materialize(gone.distinct(), "pipeline-gone")
    return keyed.join(F.broadcast(gone) if gone.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else gone, key, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text language identification rejects: null, empty or without a letter, or such that no learned language fits.

    The models are learned from all labelled rows but the fifth that op6 holds out. Repeated rows share their fate; ties as in ``language_id.identify``."""
    keyed, key = _keyed(docs)
    said = language_id.identify(keyed, ~language_id.heldout(), language_id.heldout(), id_col=key).where("rejected").select(F.col("doc_id").alias(key))
    return _without(keyed, key, said).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines whose words an earlier line matches (operator 10 as its query has it); rows left without any line with words go, and n_chars follows the text.

    Null, empty and wordless texts stay as they are. A null id counts as later than all others; rows that share an id are one
    document, whose lines aren't earlier than each other."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked documents: that of the least doc_id (nulls last), of those the least by text and the other columns of
    ``documents``. Rows without words are linked with nothing and all stay; of repeated rows with words one stays."""
    keyed, key = _keyed(docs)
    same = jaccard_join.jaccard_components(keyed, id_col=key).where("n_shingles > 0")
    same = materialize(same.select(F.col("doc_id").alias(key), "component_id").distinct(), "pipeline-groups")
    # the first of a group among its rows' ids and keys; only groups, and keys that stand for several rows, are compared
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "b", key)
    linked = keyed.select("doc_id", F.xxhash64("text").alias("b"), key).join(same, key)
    first = linked.groupBy("component_id").agg(F.min(order).alias("o"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("component_id", F.col(f"o.{key}").alias("kept")), "pipeline-first")
    gone = same.join(first, "component_id").where(F.col(key) != F.col("kept")).select(key)
    left = _without(keyed, key, gone)
    repeated = linked.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key).join(gone, key, "left_anti")
    repeated = materialize(repeated, "pipeline-repeated")
    if repeated.limit(1).count() == 0:
        return left.select(docs.columns)
    number = F.row_number().over(W.partitionBy(key).orderBy(*[F.col(c) for c in ("lang", "source", "n_chars")]))
    one = left.join(repeated, key, "left_semi").withColumn(f"{key}n", number).where(F.col(f"{key}n") == 1).drop(f"{key}n")
    return _without(left, key, repeated).unionByName(one).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds an item of the table benchmark; null, empty and wordless texts hold none. Repeated rows share their fate."""
    keyed, key = _keyed(docs)
    hit = decontaminate.contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key).select(F.col("doc_id").alias(key))
    return _without(keyed, key, hit).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with their digest and that of the decoded text: doc_id, n_tokens, ids_sha256, decoded_sha256, ids. A null text is
    empty; repeated rows stay."""
    return bpe_codec.encode_decode(docs, queries.TOKENIZER, with_ids=True)


STAGES = [("language ID", language), ("line dedup", lines), ("n-gram Jaccard join", jaccard), ("benchmark decontamination", decontamination), ("BPE encoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each stage's rows written and read again; nulls, repeats and empty tables as each stage says."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
