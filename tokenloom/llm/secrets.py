"""Operator 1, secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds are fixed patterns; ``live`` candidates are long mixed tokens outside base spans. Every candidate's value is
hashed and counted over the corpus by distinct repository and owner. A value that more than ``OWNERS`` owners or
``REPOS`` repositories have is a widely copied example; a value of few of both that looks random is a live-looking credential. Base spans always stay;
the method adds the live candidates that are owner-specific, and says for each text how many of its values are which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tokenloom.session import materialize

OWNERS = 2  # owners that a credential has at most; copies of a document in more places make it an example
REPOS = 3  # repositories that a credential is in at most, of one owner too
SALTS = 16  # pieces that a hot value's rows are dealt to when counts are joined back
# fixed values: the patterns of the kinds, in their order, with the least length and the group that has it
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # a run of [0-9a-f] is one match, so the least length may stand in the pattern
    "live": (r"[A-Za-z0-9+/_-]{20,}", 0, 20),
}
BASE = 3


def _candidate(kind: int, pattern: str, group: int):
    def one(z: Column, i: Column) -> Column:
        value = F.regexp_extract(z.hit, pattern, group) if group else z.hit
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), z.gap.alias("gap"), F.length(z.hit).alias("size"), value.alias("value"))
    return one


def _candidates(text: Column) -> Column:
    """(kind, i, gap, size, value): each match with the length of the text between it and the one before."""
    out = []
    for k, (pattern, group, least) in enumerate(KINDS.values()):
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        zipped = F.arrays_zip(hits.alias("hit"), F.transform(F.split(text, pattern, -1), lambda g: F.length(g)).alias("gap"))
        rows = F.transform(F.filter(zipped, lambda z: z.hit.isNotNull()), _candidate(k, pattern, group))
        there = text.contains("AKIA") if k == 1 else text.rlike(pattern)
        out.append(F.when(there, rows).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,value:string>>")))
    return F.concat(*out)


def _random_looking(value: Column) -> Column:
    """Digits and letters, and many different characters."""
    return (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owner, repo) rows -> hash, n_repos, n_owners, n_rows; counted in steps, so no value's rows meet in one group."""
    each = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    owners = each.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"), F.sum("n").alias("n_rows"))


def scan(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_widespread, owners, repos.

    ``base_sha256`` digests and ``spans`` lists kind:start:end, in code points with the end exclusive, by start, then kind as in
    KINDS. n_live counts values of few owners and repositories that look random, n_widespread values of many of either, base kinds included.
    ``owners`` and ``repos`` have the counts of each span's value, in the order of ``spans``. A null
    text is empty; a null owner or repository counts as one of that name. Repeated rows stay and count as one place.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    rows = materialize(rows.select("doc_id", "owner", "repo", F.xxhash64("text").alias("th"), F.length("text").alias("n"), _candidates(F.col("text")).alias("c")), "ss-rows")
    key = ["doc_id", "th", "n"]
    each = rows.where(F.size("c") > 0).select(*key, "owner", "repo", F.explode("c").alias("c")).select(*key, "owner", "repo", "c.*")
    texts = each.drop("owner", "repo").dropDuplicates([*key, "kind", "i"])
    w = W.partitionBy(*key, "kind").orderBy("i")
    texts = texts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(w)).withColumn("start", F.col("end") - F.col("size"))
    least = F.element_at(F.array(*[F.lit(x[2]) for x in KINDS.values()]), F.col("kind") + 1)
    texts = texts.where(F.length("value") >= least).withColumn("hash", F.sha2("value", 256))
    # a live candidate inside a base span is that span's
    cover = F.max(F.when(F.col("kind") < BASE, F.col("end"))).over(W.partitionBy(*key).orderBy("start", "kind"))
    texts = materialize(texts.withColumn("cover", cover).where((F.col("kind") < BASE) | F.col("cover").isNull() | (F.col("cover") < F.col("end"))).drop("cover", "gap", "size", "i"), "ss-texts")

    places = each.where(F.length("value") >= 6).select("owner", "repo", F.sha2("value", 256).alias("hash"))
    counts = ownership(places).select("hash", "n_owners", "n_repos", ((F.col("n_owners") > OWNERS) | (F.col("n_repos") > REPOS)).alias("wide")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = (texts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(SALTS)).cast("int")).join(counts, ["hash", "salt"])
            .withColumn("live", ~F.col("wide") & _random_looking(F.col("value"))).where((F.col("kind") < BASE) | F.col("live")))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("s"), "live", "wide", "n_owners", "n_repos")
    told = told.groupBy(*key).agg(F.array_sort(F.collect_list(span)).alias("all"))
    out = rows.select(*key).alias("r").join(told.alias("t"), F.expr("r.doc_id <=> t.doc_id and r.th = t.th and r.n = t.n"), "left").select("r.doc_id", F.coalesce("t.all", F.array().cast(told.schema["all"].dataType)).alias("all"))
    count = lambda f: F.size(F.filter("all", f)).cast("long")
    of = lambda k: lambda x: x.kind == k
    text = lambda a: F.array_join(F.transform(a, lambda x: x.s), ",")
    return out.select("doc_id", *[count(of(k)).alias(f"n_{n}") for k, n in enumerate(list(KINDS)[:BASE])],
                      F.sha2(text(F.filter("all", lambda x: x.kind < BASE)), 256).alias("base_sha256"), text(F.col("all")).alias("spans"),
                      count(lambda x: x.live).alias("n_live"), count(lambda x: x.wide).alias("n_widespread"),
                      F.transform("all", lambda x: x.n_owners).alias("owners"), F.transform("all", lambda x: x.n_repos).alias("repos"))
