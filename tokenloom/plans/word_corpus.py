"""Word / character corpus: documents -> lines -> symbols -> counts -> vocabulary -> encoded
stream -> batch grid -> training windows (SURVEY 3.1).

Process boundaries are three shuffles: symbol counts, position buckets, (window, core) groups.
The vocabulary and the encoded stream are read by several later jobs, so callers materialise
them (``tokenloom.session.materialize``) instead of recomputing the upstream plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import tokenize
from tokenloom.operators import vocab as V
from tokenloom.operators.positions import coarser, doc_bucket, order_key
from tokenloom.operators.windows import bin_features, windows_of


@dataclass(frozen=True)
class WordConfig:
    """Arguments of the reference's vocabulary (special, min_freq, max_size, lower_case,
    delimiter) and of its encoding (add_eos, add_double_eos)."""
    special: tuple = ("<eos>", "<unk>")
    lower: bool = False
    delimiter: str | None = None
    add_eos: bool = True
    add_double_eos: bool = False
    max_size: int | None = None
    min_freq: int = 0
    unk: str = "<unk>"
    bucket_docs: int = 1000


# Dataset presets: specials, case, marks.
PRESETS = {
    "ptb": WordConfig(special=("<eos>",), lower=True),
    "wt2": WordConfig(special=("<eos>", "<unk>"), lower=False),
    "wt103": WordConfig(special=("<eos>", "<unk>"), lower=False),
    "enwik8": WordConfig(special=(), lower=True, add_eos=False),
    "text8": WordConfig(special=(), lower=True, add_eos=False),
    "lm1b": WordConfig(special=(), lower=False, add_eos=False, add_double_eos=True, unk="<UNK>"),
}


def single_split(lines: DataFrame, split: str = "train") -> DataFrame:
    """All lines as one file of one split."""
    return lines.withColumn("split", F.lit(split)).withColumn("split_ord", F.lit(0))


def symbol_lines(lines: DataFrame, cfg: WordConfig, marks: bool) -> DataFrame:
    """P1-P4 on every line: adds ``symbols``."""
    return lines.withColumn("symbols", tokenize(F.col("line"), cfg.lower, cfg.delimiter,
                                                 cfg.add_eos and marks, cfg.add_double_eos and marks))


def without_marks(symbols: F.Column, cfg: WordConfig) -> F.Column:
    """The symbols of a marked line without the marks ``symbol_lines(marks=True)`` added."""
    if cfg.add_double_eos:
        return F.slice(symbols, 2, F.size(symbols) - 2)
    if cfg.add_eos:
        return F.slice(symbols, 1, F.size(symbols) - 1)
    return symbols


def positioned_lines(lines: DataFrame, cfg: WordConfig, tokenized: bool = False) -> DataFrame:
    """W1 at line level: marked ``symbols`` plus ``start_p``, the position of the line's first
    token in its split's stream (three-level prefix sum over doc_id buckets). Counting and
    encoding both read this one table, so positions are computed once."""
    s = lines if tokenized else symbol_lines(lines, cfg, marks=True)
    s = s.withColumn("_n", F.size("symbols"))
    from tokenloom.operators.positions import prefix_offsets
    s = prefix_offsets(s, F.col("_n"), ["split"], [F.col("doc_id"), F.col("line_no")],
                       doc_bucket("doc_id", cfg.bucket_docs), "start_p", coarser())
    return s.drop("_n")


def counted_tokens(slines: DataFrame, cfg: WordConfig, marked: bool) -> DataFrame:
    """Tokens to count (no end marks, as counting uses add_eos=False) with an order key ``p`` that
    follows the concatenation of all given splits: (split order, document, line, place in it)."""
    syms = without_marks(F.col("symbols"), cfg) if marked else F.col("symbols")
    t = slines.select(order_key(F.col("split_ord"), F.col("doc_id"), F.col("line_no")).alias("_k"), F.posexplode(syms).alias("pos", "sym"))
    return t.select((F.col("_k") + F.col("pos")).cast("decimal(38,0)").alias("p"), "sym")


def corpus_counts(lines: DataFrame, cfg: WordConfig, marked: bool = False) -> DataFrame:
    """Counts over every given split, ties by (split order, place); one scan, one shuffle.
    ``marked``: the lines carry marked symbols already."""
    return V.symbol_counts(counted_tokens(lines if marked else symbol_lines(lines, cfg, marks=False), cfg, marked))


def corpus_vocab(lines: DataFrame, cfg: WordConfig) -> DataFrame:
    return V.build_vocab(corpus_counts(lines, cfg), cfg.special, cfg.min_freq, cfg.max_size)


PIECE = 1 << 16  # tokens of a line that are grouped at most: a character corpus may be one line


def encoded_stream(plines: DataFrame, vocab: DataFrame, cfg: WordConfig, unk_id: int | None) -> DataFrame:
    """J1 + W1 over positioned lines: (split, shard, doc_id, line_no, start_pos, start_p, ids), see ``encoded_pieces``."""
    return encoded_pieces(plines.select("split", "shard", "doc_id", "line_no", "start_p", "symbols"), vocab, unk_id)


def encoded_pieces(lines: DataFrame, vocab: DataFrame, unk_id: int | None) -> DataFrame:
    """J1 on lines (``symbols`` and any other columns, ``start_p`` among them or not): one array of ids for each ``PIECE`` tokens of a line, which
    begins at ``start_pos`` in its line; ``start_p`` moves along.

    A vocabulary of bounded size goes to the tasks and whole arrays are looked up, without a shuffle. A larger one is
    joined: pieces are dealt by their key before they are taken apart, and the regrouping stays in those partitions."""
    keep = [c for c in lines.columns if c not in ("symbols", "start_p")]
    placed = "start_p" in lines.columns
    # cut before the rows are made, so none of them carries the whole line
    cuts = f"if(size(symbols) <= {PIECE}, array(symbols), transform(sequence(0, (size(symbols) - 1) div {PIECE}), k -> slice(symbols, cast(k as int) * {PIECE} + 1, {PIECE})))"
    t = lines.select(*keep, *(["start_p"] if placed else []), F.posexplode(F.expr(cuts)).alias("_k", "symbols"))
    at = F.col("_k").cast("bigint") * PIECE
    t = t.select(*keep, at.alias("start_pos"), *([(F.col("start_p") + at).alias("start_p")] if placed else []), "symbols")
    if V.fits_tasks(vocab):
        return V.encode_arrays(t, vocab, unk_id)
    key = [*keep, "start_pos"] + (["start_p"] if placed else [])
    t = t.repartition(*keep, "start_pos").select(*key, F.posexplode("symbols").alias("pos", "sym"))
    g = V.encode(t, vocab, unk_id, bounded=False).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_t"))
    return g.select(*key, F.transform("_t", lambda x: x["id"]).alias("ids"))


def placed_pieces(pieces: DataFrame, bucket_docs: int = 1000) -> DataFrame:
    """W1 on encoded pieces (split, doc_id, line_no, start_pos, ids, n): adds ``start_p``, the place of the first id in its split's stream. Ids are
    shuffled, not symbols; callers write the pieces before, as they are read twice."""
    from tokenloom.operators.positions import prefix_offsets
    order = [F.col("doc_id"), F.col("line_no"), F.col("start_pos")]
    return prefix_offsets(pieces, F.col("n"), ["split"], order, doc_bucket("doc_id", bucket_docs), "start_p", coarser()).drop("n")


def tokens_of(lines: DataFrame) -> DataFrame:
    """The encoded lines as one row per token: (split, doc_id, line_no, pos, p, id)."""
    t = lines.select("split", "doc_id", "line_no", "start_pos", "start_p", F.posexplode("ids").alias("_i", "id"))
    return t.select("split", "doc_id", "line_no", (F.col("start_pos") + F.col("_i")).alias("pos"), (F.col("start_p") + F.col("_i")).alias("p"), "id")


def split_sizes(lines: DataFrame) -> dict[str, int]:
    """N per split (a handful of scalars to the driver)."""
    return {r["split"]: int(r["n"]) for r in lines.groupBy("split").agg(F.sum(F.size("ids")).alias("n")).collect()}


def build_examples(stream: DataFrame, N: int, B: int, T: int, C: int = 1, cutoffs: list[int] | None = None,
                   bin_sizes: list[int] | None = None, fixed: bool = False) -> DataFrame:
    """A8's content from encoded lines (or tokens, (p, id) rows): windows (w, r, core, sample_id, inputs, labels) plus, when ``cutoffs`` is
    non-empty and ``fixed`` (the reference's use_tpu), masks, head labels and bin tuples."""
    lines = stream if "ids" in stream.columns else stream.select(F.col("p").alias("start_p"), F.array("id").alias("ids"))
    win = windows_of(lines, N // B, T, fixed, B, C)
    if cutoffs and fixed:
        win = bin_features(win, cutoffs, bin_sizes or [])
    return win
