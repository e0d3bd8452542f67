"""Text sources: documents -> ordered lines, shard lists and split assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import PY_WS_CLASS, space_chars
from tokenloom.operators.positions import coarser, doc_bucket, prefix_offsets

SPLIT_ORDER = {"train": 0, "valid": 1, "test": 2}


SCAN_PARTITIONS = "tokenloom.scan.partitions"


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The documents table. The session setting ``tokenloom.scan.partitions`` (unset: none) deals its rows to
    so many partitions by doc_id first: for small files of one row group, whose per-line work would run in
    one task. A large input has enough splits and needs no such shuffle."""
    docs = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    n = int(spark.conf.get(SCAN_PARTITIONS, "0"))
    return docs.repartition(n, "doc_id") if n else docs


def read_lines(docs: DataFrame, text_col: str = "text", shard_col: str = "source",
               universal_newlines: bool = False) -> DataFrame:
    """A1: one row per line, in order.

    A text ending in a newline yields no empty last line; other empty lines are kept; an
    empty text has no lines. ``has_newline`` is false only on a last line without one.
    ``universal_newlines`` turns ``\\r\\n`` and ``\\r`` into ``\\n`` first (Python text mode).
    Output: shard, doc_id, line_no, line, has_newline.
    """
    text = F.col(text_col)
    if universal_newlines:
        text = F.regexp_replace(text, "\r\n?", "\n")
    parts = F.split(text, "\n", -1)
    ends_nl = text.endswith(F.lit("\n"))
    n_lines = (F.when(text == "", F.lit(0))
               .when(ends_nl, F.size(parts) - 1)
               .otherwise(F.size(parts)))
    t = docs.select(F.col(shard_col).alias("shard"), "doc_id", ends_nl.alias("_nl"),
                    n_lines.alias("_n"), F.slice(parts, 1, n_lines).alias("_lines"))
    t = t.select("shard", "doc_id", "_nl", "_n", F.posexplode("_lines").alias("line_no", "line"))
    return t.select("shard", "doc_id", F.col("line_no").cast("int").alias("line_no"), "line",
                    ((F.col("line_no") < F.col("_n") - 1) | F.col("_nl")).alias("has_newline"))


def read_text_files(spark: SparkSession, glob: str) -> DataFrame:
    """A1 / A2 on text files: the lines of all files that match, in the columns of ``read_lines``.

    ``shard`` is the file name; ``doc_id`` grows along the sorted files and, inside a file, along the blocks that Spark
    splits it into; ``line_no`` counts the lines of a block, so numbering needs no group larger than a block. The table is
    written once, as the order of a block's lines is that of this scan. The reader doesn't say whether a file's
    last line ends in a newline; it is taken to."""
    from tokenloom.session import materialize
    t = spark.read.text(glob).select(F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_block_start").alias("block"),
                                     F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))
    t = materialize(t, "text-files")
    files = t.select("shard").distinct()
    files = files.select("shard", (F.row_number().over(Window.orderBy("shard")) - 1).cast("bigint").alias("f"))  # one row for each file
    at = F.row_number().over(Window.partitionBy("shard", "block").orderBy("n")) - 1
    t = t.join(files, "shard").select("shard", (F.shiftleft("f", 40) + F.col("block")).alias("doc_id"), at.alias("line_no"), "line")
    return t.withColumn("has_newline", F.lit(True))


def file_lines(lines: DataFrame, trailing: bool = False) -> DataFrame:
    """(line_no, line) of one file read by ``read_text_files`` whose lines fit one block, e.g. a vocabulary or
    merges file; ``trailing`` adds the empty text behind the last newline, as ``load_merges`` expects it."""
    out = lines.select(F.col("line_no").cast("bigint").alias("line_no"), "line")
    if trailing:
        out = out.unionByName(out.agg((F.max("line_no") + 1).alias("line_no")).select("line_no", F.lit("").alias("line")))
    return out


def shard_list(docs: DataFrame, shard_col: str = "source") -> DataFrame:
    """A2: sorted shard list (shard, shard_no). The window runs over the distinct-shard table
    (one row per file), never over documents."""
    shards = docs.select(F.col(shard_col).alias("shard")).distinct()
    return shards.select("shard", (F.row_number().over(Window.orderBy("shard")) - 1).cast("bigint").alias("shard_no"))


def split_by_shard(docs: DataFrame, shard_col: str = "source") -> DataFrame:
    """A3: sorted shards, first -> valid, second -> test, rest -> train."""
    s = shard_list(docs, shard_col)
    return s.withColumn("split", F.when(F.col("shard_no") == 0, "valid")
                        .when(F.col("shard_no") == 1, "test").otherwise("train"))


def with_split(lines: DataFrame, shard_splits: DataFrame) -> DataFrame:
    """Attach split (and split_ord) to lines by shard; a shard may belong to several splits
    (e.g. the valid file doubling as test), then its lines appear once per split.
    The shard table has one row per file, so it is broadcast."""
    m = shard_splits.select("shard", "split")
    out = lines.join(F.broadcast(m), "shard")
    order = F.create_map(*[x for k, v in SPLIT_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return out.withColumn("split_ord", F.coalesce(F.element_at(order, F.col("split")), F.lit(3)).cast("int"))


def split_named(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """A4: splits by file name through a (shard, split) mapping table."""
    return with_split(lines, mapping)


def split_tail_chars(docs: DataFrame, n: int, bucket_docs: int = 1000) -> DataFrame:
    """A5: the corpus text is every document followed by a newline, in doc_id order. The last
    ``n`` characters are test, the ``n`` before them valid, the rest train; each part is
    stripped and then written with every character separated by a space (P5).

    Output per (split, doc_id) piece: piece_start (global character offset), piece_len,
    raw (unstripped piece), text (stripped piece), spaced (P5 of the stripped piece).
    Concatenating ``text`` over a split in piece order gives the stripped part; joining
    ``spaced`` with a space gives the written part. Nothing is concatenated in one task.
    """
    d = docs.select("doc_id", F.concat(F.col("text"), F.lit("\n")).alias("raw"))
    d = d.withColumn("_len", F.length("raw").cast("bigint"))
    d = prefix_offsets(d, F.col("_len"), [], [F.col("doc_id")], doc_bucket("doc_id", bucket_docs), "start", coarser())
    total = d.agg(F.sum("_len").alias("L"))
    parts = total.select(F.explode(F.array(
        F.struct(F.lit("train").alias("split"), F.lit(0).cast("bigint").alias("lo"), F.greatest(F.col("L") - 2 * n, F.lit(0)).alias("hi")),
        F.struct(F.lit("valid").alias("split"), F.greatest(F.col("L") - 2 * n, F.lit(0)).alias("lo"), F.greatest(F.col("L") - n, F.lit(0)).alias("hi")),
        F.struct(F.lit("test").alias("split"), F.greatest(F.col("L") - n, F.lit(0)).alias("lo"), F.col("L").alias("hi")),
    )).alias("p")).select("p.*")
    # three part ranges: a one-row derived table, broadcast for the range join
    pieces = d.join(F.broadcast(parts), (F.col("start") < F.col("hi")) & (F.col("start") + F.col("_len") > F.col("lo")))
    ps = F.greatest(F.col("start"), F.col("lo"))
    pe = F.least(F.col("start") + F.col("_len"), F.col("hi"))
    pieces = pieces.select("split", "doc_id", ps.alias("piece_start"), (pe - ps).alias("piece_len"),
                           F.substring(F.col("raw"), (ps - F.col("start") + 1).cast("int"), (pe - ps).cast("int")).alias("raw"))
    # strip each part: find its first and last non-whitespace character offsets
    lead = F.length(F.regexp_extract(F.col("raw"), "(?U)^" + PY_WS_CLASS + "*", 0))
    trail = F.length(F.regexp_extract(F.col("raw"), "(?U)" + PY_WS_CLASS + "*$", 0))
    has_text = lead < F.col("piece_len")
    pieces = pieces.withColumn("_a", F.when(has_text, F.col("piece_start") + lead)) \
                   .withColumn("_b", F.when(has_text, F.col("piece_start") + F.col("piece_len") - trail))
    bounds = pieces.groupBy("split").agg(F.min("_a").alias("s_lo"), F.max("_b").alias("s_hi"))
    out = pieces.drop("_a", "_b").join(F.broadcast(bounds), "split")
    a = F.greatest(F.col("piece_start"), F.col("s_lo"))
    b = F.least(F.col("piece_start") + F.col("piece_len"), F.col("s_hi"))
    text = F.when(b > a, F.substring(F.col("raw"), (a - F.col("piece_start") + 1).cast("int"), (b - a).cast("int"))).otherwise(F.lit(""))
    out = out.select("split", "doc_id", "piece_start", "piece_len", "raw", text.alias("text"))
    return out.withColumn("spaced", space_chars(F.col("text")))


def load_merges(lines: DataFrame) -> DataFrame:
    """Merges file lines (line_no, line) -> merges(rank, left, right).

    The header line is dropped, as is the text after the last newline (the caller's lines
    come from splitting the file on newlines, so that is the last element); each remaining
    line splits on a space into two; rank = line order."""
    last = lines.agg(F.max("line_no").alias("_last"))
    body = lines.join(F.broadcast(last), F.col("line_no") < F.col("_last")).filter(F.col("line_no") >= 1)
    parts = F.split(F.col("line"), " ", -1)
    return body.select((F.col("line_no") - 1).cast("int").alias("rank"),
                       F.element_at(parts, 1).alias("left"), F.element_at(parts, 2).alias("right"))


def load_piece_ids(json_text: DataFrame, col: str = "value") -> DataFrame:
    """The piece -> id JSON map -> (piece, id)."""
    m = F.from_json(F.col(col), "map<string,bigint>")
    return json_text.select(F.explode(m).alias("piece", "id"))
