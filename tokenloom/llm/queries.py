"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bm25_search, bpe_codec, decontaminate, divergence, hard_negatives, jaccard_join, language_id, line_dedup, lm_score, secrets, token_file, toxicity, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"), ~language_id.heldout("doc_id", 7, 2))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), ~language_id.heldout(), language_id.heldout())


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = language_id.heldout("doc_id", 3, 1)
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held, held)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a line: its words."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"), words=1)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner of a document is its source, its repository the source's part in one language."""
    return secrets.scan(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))


def op2_bm25_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every document whose id is divisible by 20, against all documents."""
    docs = table(spark, sf_dir, "documents")
    return bm25_search.top_k(bm25_search.build_index(docs), docs.where("doc_id % 20 = 0"), query_id="doc_id")


def op2_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every benchmark item whose id is divisible by 20, against all documents."""
    index = bm25_search.build_index(table(spark, sf_dir, "documents"))
    return bm25_search.top_k(index, table(spark, sf_dir, "benchmark").where("item_id % 20 = 0"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language keeps the V terms in 3 or more of its documents. p = 1 + floor(10^9 (count + 1) / (N + V)) of a group, q of what it is held
    against. Part pair: each other source of the language, floor((p - q)^2 / q) added up over the kept terms. Part term: the group's terms with
    p > q, q that of the language, the first 200."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor (an id divisible by 100) and each of its first 5 rows of the same label: the first 10 rows of other labels
    whose score is 30 to 90 per cent of the positive's."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_bm25_documents, op2_bm25_search, op3_decontaminate, op4_jaccard_join, op5_lm_score, op6_language_id, op7_token_file, op8_toxicity, op9_bpe_codec, op10_line_dedup, op11_source_divergence, op12_hard_negatives, op13_warc)}


def all_sql() -> dict[str, str]:
    return {"op2_bm25_search": bm25_search.SQL, "op11_source_divergence": divergence.SQL, "op12_hard_negatives": hard_negatives.SQL, "op13_warc": warc.SQL}
