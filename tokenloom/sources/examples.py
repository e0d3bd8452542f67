"""Training examples on disk and back (A8-A14, P12), manifests and corpus info.

Examples are Parquet, partitioned by ``split`` and ``basename``; ``sample_id`` is a column, so
order is never implied by file layout and host ranges prune row groups by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

BIN_STRUCT = Ty.StructType([Ty.StructField("bin", Ty.IntegerType()), Ty.StructField("cnt", Ty.LongType()),
                            Ty.StructField("tup", Ty.ArrayType(Ty.LongType()))])

EXAMPLE_SCHEMA = Ty.StructType([
    Ty.StructField("sample_id", Ty.LongType()),
    Ty.StructField("w", Ty.LongType()),
    Ty.StructField("r", Ty.LongType()),
    Ty.StructField("inputs", Ty.ArrayType(Ty.LongType())),
    Ty.StructField("labels", Ty.ArrayType(Ty.LongType())),
    Ty.StructField("inp_mask", Ty.ArrayType(Ty.FloatType())),
    Ty.StructField("tgt_mask", Ty.ArrayType(Ty.FloatType())),
    Ty.StructField("head_labels", Ty.ArrayType(Ty.LongType())),
    Ty.StructField("inp_bins", Ty.ArrayType(BIN_STRUCT)),
    Ty.StructField("tgt_bins", Ty.ArrayType(BIN_STRUCT)),
    Ty.StructField("split", Ty.StringType()),
    Ty.StructField("basename", Ty.StringType()),
])


def example_file_name(basename: str, B: int, T: int, C: int, fixed: bool) -> str:
    """Naming rule; the core count appears only for fixed-length (accelerator) files."""
    if fixed:
        return f"{basename}.bsz-{B}.tlen-{T}.core-{C}"
    return f"{basename}.bsz-{B}.tlen-{T}"


def example_file_name_col(basename, B: int, T: int, C: int, fixed: bool):
    """A9 as a column expression (basename may be a column, e.g. per shard)."""
    if fixed:
        return F.format_string(f"%s.bsz-{B}.tlen-{T}.core-{C}", basename)
    return F.format_string(f"%s.bsz-{B}.tlen-{T}", basename)


def shard_basename(shard_no, shuffle=None):
    """Train shard names: ``train-%03d-%02d`` (shard, shuffle) or ``train-%03d`` (byte-pair)."""
    if shuffle is None:
        return F.format_string("train-%03d", shard_no)
    return F.format_string("train-%03d-%02d", shard_no, shuffle)


def write_examples(examples: DataFrame, path: str, split: str, basename: str) -> None:
    """Append one example set (split, basename) under ``path``."""
    cols = [f.name for f in EXAMPLE_SCHEMA.fields if f.name not in ("split", "basename")]
    df = examples
    for f in EXAMPLE_SCHEMA.fields:
        if f.name not in df.columns and f.name not in ("split", "basename"):
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df = df.select(*[F.col(c).cast(EXAMPLE_SCHEMA[c].dataType) for c in cols])
    (df.withColumn("split", F.lit(split)).withColumn("basename", F.lit(basename))
       .write.mode("append").partitionBy("split", "basename").parquet(path))


def write_example_files(examples: DataFrame, path: str) -> None:
    """A8 for many files at once: ``examples`` carry split and basename (a file's name by A9), each of which becomes a folder of Parquet
    files. Rows of a file lie in few tasks when they come from ``windows_of_streams``; nothing is dealt anew here."""
    df = examples
    for f in EXAMPLE_SCHEMA.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EXAMPLE_SCHEMA.fields]).write.mode("append").partitionBy("split", "basename").parquet(path)


def record_info_name(split: str, B: int, T: int, C: int, fixed: bool) -> str:
    """A10's file name; like A9 it has the core count only with fixed length."""
    return f"record_info-{split}.bsz-{B}.tlen-{T}{f'.core-{C}' if fixed else ''}.json"


def record_info_of_streams(streams: DataFrame, bin_sizes: list[int]) -> DataFrame:
    """A10 from the stream table (split, basename: the files' names, W): split, filenames, bin_sizes, num_batch. Windows are counted by the grids, so no example is read."""
    sizes = F.array(*[F.lit(int(x)).cast("bigint") for x in bin_sizes]) if bin_sizes else F.array().cast("array<bigint>")
    return streams.groupBy("split").agg(F.array_sort(F.collect_list("basename")).alias("filenames"), F.sum("W").cast("bigint").alias("num_batch")).withColumn("bin_sizes", sizes)


def write_record_info(info: DataFrame, path: str, B: int, T: int, C: int, fixed: bool) -> None:
    """A10: each split's manifest under its own name, written after the examples it lists."""
    for r in info.select("split").collect():  # at most a handful of splits
        one = info.where(F.col("split") == r["split"]).select("filenames", "bin_sizes", "num_batch")
        one.coalesce(1).write.mode("overwrite").json(f"{path}/{record_info_name(r['split'], B, T, C, fixed)}")


def read_listed(spark: SparkSession, path: str, info_path: str, split: str, B: int, T: int, C: int, fixed: bool) -> DataFrame:
    """A11 + A14: the examples of the files that a split's manifest lists and no others, pruned by partition.

    Raises if there is no manifest, if a file isn't named as this B, T and C ask, if a listed file with the others doesn't hold the
    stated batches (B examples each), if an example has other bins than the manifest, or a bin holds more than its size."""
    info = load_record_info(spark, f"{info_path}/{record_info_name(split, B, T, C, fixed)}").collect()
    if len(info) != 1 or info[0]["filenames"] is None or info[0]["num_batch"] is None:
        raise ValueError(f"{record_info_name(split, B, T, C, fixed)} is not one manifest")
    info = info[0]
    tail = example_file_name("", B, T, C, fixed)
    other = [f for f in info["filenames"] if not f.endswith(tail)]
    if other:
        raise ValueError(f"{other[0]} is not a file of {tail[1:]}")
    df = read_examples(spark, path, T, fixed, split, basenames=list(info["filenames"]) or [""])
    sizes = list(info["bin_sizes"] or [])
    if not fixed:
        sizes = []
    limit = F.array(*[F.lit(int(x)).cast("bigint") for x in sizes]) if sizes else F.array().cast("array<bigint>")

    def bad(side: str):
        counts = F.coalesce(F.transform(side, lambda x: x["cnt"]), F.array().cast("array<bigint>"))
        return (F.size(counts) != len(sizes)) | F.exists(F.arrays_zip(counts.alias("n"), limit.alias("most")), lambda x: x["n"] > x["most"])

    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad("inp_bins") | bad("tgt_bins")).alias("bad")).first()
    if seen["n"] != info["num_batch"] * B:
        raise ValueError(f"the listed files hold {seen['n']} examples, the manifest states {info['num_batch']} batches of {B}")
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} examples don't agree with the manifest's bins {sizes}")
    return df


def read_examples(spark: SparkSession, path: str, T: int, fixed: bool, split: str | None = None,
                  basenames: list[str] | None = None) -> DataFrame:
    """A14 + P12: declared schema (nothing inferred); with ``fixed`` a sample of another length
    is an error; ids become int (ANSI cast raises on overflow). Partition filters prune files."""
    df = spark.read.schema(EXAMPLE_SCHEMA).parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == split)
    if basenames:
        df = df.filter(F.col("basename").isin(basenames))
    if fixed:
        bad = (F.size("inputs") != T) | (F.size("labels") != T)
        df = df.withColumn("inputs", F.when(bad, F.raise_error(F.lit("example of wrong length"))).otherwise(F.col("inputs")))
    to_int = lambda c: F.transform(F.col(c), lambda x: x.cast("int"))
    return (df.withColumn("inputs", to_int("inputs")).withColumn("labels", to_int("labels"))
              .withColumn("head_labels", to_int("head_labels")))


def record_info(examples: DataFrame, B: int, T: int, C: int, fixed: bool, bin_sizes: list[int]) -> DataFrame:
    """A10: per split: file list (sorted), bin sizes, num_batch summed over files (windows per
    file = distinct w). Output split, filenames ARRAY<STRING>, bin_sizes ARRAY<BIGINT>, num_batch,
    and ``json`` (the manifest text)."""
    per_file = examples.groupBy("split", "basename").agg(F.countDistinct("w").alias("nb"))
    per_file = per_file.withColumn("file", example_file_name_col(F.col("basename"), B, T, C, fixed))
    bs = F.array(*[F.lit(int(x)).cast("bigint") for x in bin_sizes]) if bin_sizes else F.array().cast("array<bigint>")
    out = per_file.groupBy("split").agg(F.array_sort(F.collect_list("file")).alias("filenames"),
                                        F.sum("nb").cast("bigint").alias("num_batch"))
    out = out.withColumn("bin_sizes", bs)
    return out.withColumn("json", F.to_json(F.struct("filenames", "bin_sizes", "num_batch")))


RECORD_INFO_SCHEMA = "filenames array<string>, bin_sizes array<bigint>, num_batch bigint"


def load_record_info(spark: SparkSession, path: str) -> DataFrame:
    """Read a manifest written as JSON lines, with a fixed schema."""
    return spark.read.schema(RECORD_INFO_SCHEMA).json(path)


def corpus_info(vocab: DataFrame, cutoffs: list[int], dataset: str) -> DataFrame:
    """One row: vocab_size, cutoffs, dataset (and its JSON)."""
    cuts = F.array(*[F.lit(int(c)).cast("bigint") for c in cutoffs]) if cutoffs else F.array().cast("array<bigint>")
    out = vocab.agg(F.count(F.lit(1)).alias("vocab_size")).select("vocab_size", cuts.alias("cutoffs"), F.lit(dataset).alias("dataset"))
    return out.withColumn("json", F.to_json(F.struct("vocab_size", "cutoffs", "dataset")))


CORPUS_INFO_SCHEMA = "vocab_size bigint, cutoffs array<bigint>, dataset string"


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """A13 for one table of fixed settings: reuse what was built under ``path``, else build it (see ``sources.store``)."""
    from tokenloom.sources.store import CorpusStore
    return CorpusStore(spark, path).get_or_build("table", {}, "", build)
