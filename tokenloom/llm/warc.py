"""Operator 13, WARC archives with revisit resolution.

``write_archive`` shuffles only headers, not payloads, by payload digest: of the responses with one digest and at least ``LEAST``
bytes the first by (page_id, url, record_id) keeps its payload, the others are written as revisit records that name it. Records
are built by column functions and written by Spark's text writer, whose line separator is the blank line
that ends a WARC record, so the folder holds plain WARC/1.1 files. ``read_archive`` cuts any such
files (gzip members too) by Content-Length and checks the payload digests. ``resolve`` joins the headers of
revisit records to their original responses by digest. ``rewrite`` does all of it from archives to archives: it
resolves what they hold, finds the responses that now have an equal elsewhere, and writes them with fresh headers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import materialize, work_path

LEAST = 100  # bytes of a payload from which on a repeated one is written as a revisit
VOLUME = 16 << 20  # bytes of a file, about: a file takes as many records as fill this on average
BROADCAST_BYTES = 16 << 20  # originals that are repeated are broadcast up to this size, else joined by a shuffle
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: "

ENTRY = ["page_id", "url", "record_id", "date", "digest", "n", "refers_id", "payload"]


def entries(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows of a table of pages as records to write; a null payload is an empty one."""
    none = F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return d.select("page_id", "url", none.alias("record_id"), none.alias("date"), F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n"), none.alias("refers_id"), "payload")


def _small(df: DataFrame, bytes_: Column, name: str) -> DataFrame:
    """The written table, to be broadcast if its measured size allows it; else AQE splits skewed keys of the other side."""
    out = materialize(df, name)
    size = out.agg(F.sum(bytes_ + 200)).first()[0] or 0
    return F.broadcast(out) if size <= BROADCAST_BYTES else out


def originals(records: DataFrame) -> DataFrame:
    """(digest, first: page_id, url, record_id, date, same) for each payload that other records repeat; ``same`` counts the rows equal to the first in
    all of these. One shuffle of headers, combined before it, so a payload that a third of the records hold meets no single task."""
    kept = F.col("payload").isNotNull()
    heads = records.select("digest", "page_id", "url", "record_id", "date", kept.alias("kept"), (~kept).cast("int").alias("revisit"))
    heads = heads.where(records["n"].isNull() | (records["n"] >= LEAST) | ~kept)
    same = heads.groupBy("digest", "page_id", "url", "record_id", "date", "kept", "revisit").agg(F.count("*").alias("same"))
    parts = [x for c in ("page_id", "url", "record_id") for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    first = same.groupBy("digest").agg(F.min(F.when(F.col("kept"), F.struct(*parts, "date", "same"))).alias("first"), F.sum("same").alias("records"))
    return first.where("first is not null and records > 1").select("digest", *(F.col(f"first.{c}").alias(f"o_{c}") for c in ("page_id", "url", "record_id", "date", "same")))


def _roles(records: DataFrame) -> DataFrame:
    """Each record with its original's columns (null unless a revisit of it is to be written) and ``response``."""
    firsts = _small(originals(records), F.coalesce(F.octet_length("o_url"), F.lit(0)), "warc-originals")
    digest = F.col("digest")
    h = F.sha2(F.concat(F.lit("original:"), digest), 256)
    named = F.concat_ws("-", *(F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    firsts = firsts.withColumn("o_record_id", F.coalesce("o_record_id", F.concat(F.lit("urn:uuid:"), named)))
    own = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("page_id", "o_page_id"), ("url", "o_url"), ("date", "o_date"))]
    is_first = F.col("payload").isNotNull() & own[0] & own[1] & own[2] & (F.col("record_id").isNull() | (F.col("record_id") == F.col("o_record_id")))
    d = records.join(firsts, "digest", "left")
    d = d.withColumn("is_first", F.col("o_same").isNotNull() & is_first)
    twins = F.col("is_first") & (F.col("o_same") > 1)
    response = F.col("payload").isNotNull() & (F.col("is_first") | F.col("o_same").isNull() | (F.col("n") < LEAST))
    if firsts.where("o_same > 1").isEmpty():
        return d.withColumn("response", response)
    # rows equal in everything, the payload too: counted, so that one of them is the response
    few = d.where(twins).groupBy(*[c for c in d.columns if c != "payload"]).agg(F.first("payload").alias("payload"), F.count("*").alias("k"))
    few = few.select(*[c for c in d.columns if c not in ("payload", "is_first")], "payload", F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))).alias("k")).withColumn("is_first", F.col("k") == 1)
    return d.where(~twins).unionByName(few.select(d.columns)).withColumn("response", response)


def _record(date: str) -> Column:
    """Text of a record without the two line ends after it."""
    def head(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit(END))).otherwise(F.lit(""))

    def uri(c: str) -> Column:
        return F.replace(F.replace(F.col(c), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    response, again = F.col("response"), ~F.col("response") & F.col("o_same").isNotNull()
    own_id = F.coalesce("record_id", F.when(F.col("is_first"), F.col("o_record_id")), F.concat(F.lit("urn:uuid:"), F.uuid()))
    refers = F.when(again, F.col("o_record_id")).otherwise(F.when(~response, F.col("refers_id")))
    http = F.concat(F.lit(HTTP), F.coalesce(F.when(response, F.col("n")), F.lit(0)).cast("string"), F.lit(END + END))
    body = F.when(response, F.col("payload").cast("string")).otherwise(F.lit(""))
    return F.concat(
        F.lit("WARC/1.1" + END), head("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        head("WARC-Record-ID", F.concat(F.lit("<"), own_id, F.lit(">"))), head("WARC-Date", F.coalesce("date", F.lit(date))), head("WARC-Target-URI", uri("url")),
        head("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), head("X-Page-ID", F.col("page_id").cast("string")),
        head("WARC-Profile", F.when(~response, F.lit(PROFILE))), head("WARC-Refers-To", F.concat(F.lit("<"), refers, F.lit(">"))),
        head("WARC-Refers-To-Target-URI", F.when(again, uri("o_url"))), head("WARC-Refers-To-Date", F.when(again, F.coalesce("o_date", F.lit(date)))),
        F.lit("Content-Type: application/http;msgtype=response" + END), head("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit(END), http, body)


def write_archive(records: DataFrame, path: str, compression: str = "none") -> None:
    """Writes ``records`` (the columns ENTRY; a null payload is that of a revisit record) as WARC files under ``path``, each payload once.

    A response is never written as a revisit below LEAST bytes. A null page_id or url comes last among equals and leaves its
    header out; of rows equal in everything one is the response. No rows: an empty archive. Other columns aren't read.
    Line ends inside a URL are percent-encoded, as a header is one line. ``compression``: none or gzip."""
    records = records.select(ENTRY)
    mean = records.agg(F.avg(F.coalesce("n", F.lit(0)))).first()[0] or 0
    out = _roles(records).select(_record(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")).alias("value"))
    out.write.option("lineSep", END + END).option("compression", compression).option("maxRecordsPerFile", max(1, int(VOLUME / (mean + 600)))).text(path)


READ = "type string, record_id string, page_id long, url string, date string, refers_id string, digest string, n long, payload binary"


def _members(raw: bytes) -> memoryview:
    if raw[:2] != b"\x1f\x8b":
        return memoryview(raw)
    out = []
    while raw:
        z = zlib.decompressobj(31)
        out.append(z.decompress(raw) + z.flush())
        raw = z.unused_data
    return memoryview(b"".join(out))


def parse(raw: bytes, payloads: bool = True) -> Iterator[tuple]:
    """Records (the columns READ) of one file; raises on a record that is cut off or whose payload isn't what its digest says."""
    data, at = _members(raw), 0
    whole = data.obj
    while at < len(data):
        if whole[at:at + 2] == b"\r\n":
            at += 2
            continue
        end = whole.find(b"\r\n\r\n", at)
        if whole[at:at + 5] != b"WARC/" or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in whole[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            head[name.lower()] = value.strip()
        at = end + 4 + int(head["content-length"])
        if at > len(data):
            raise ValueError("a WARC record is cut off")
        block, payload = data[end + 4:at], None
        if head.get("warc-type") == "response":
            cut = whole.find(b"\r\n\r\n", end + 4, at) if head.get("content-type", "").startswith("application/http") else end
            payload = data[(at if cut < 0 else cut + 4):at]
            found = hashlib.sha256(payload).hexdigest()
            kind, _, said = head.get("warc-payload-digest", "").partition(":")
            if kind == "sha256" and len(said) == 64 and said.lower() != found:
                raise ValueError(f"the payload of {head.get('warc-record-id')} isn't what its digest says")
        elif head.get("warc-type") != "revisit":
            continue
        else:
            found = head.get("warc-payload-digest", "").partition(":")[2].lower() or None
        page = head.get("x-page-id")
        refers = head.get("warc-refers-to")
        yield (head["warc-type"], head.get("warc-record-id", "").strip("<>") or None, int(page) if page else None, head.get("warc-target-uri"), head.get("warc-date"),
               refers.strip("<>") if refers else None, found, None if payload is None else len(payload), None if payload is None or not payloads else bytes(payload))


def _parsed(payloads: bool):
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in READ.split(", "))])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                rows, held = [], 0
                for r in parse(b.column(0)[i].as_py(), payloads):
                    rows.append(r)
                    held += len(r[-1] or b"")
                    if len(rows) == 10_000 or held > VOLUME:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    return run


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Response and revisit records of all WARC files under ``path``: the columns READ, a file to a row of Spark's binary
    reader. Digests are those of the payloads read, or what a revisit record states. Without ``payloads`` that column is null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_parsed(payloads), READ)


def resolve(records: DataFrame) -> DataFrame:
    """``records`` (of ``read_archive``) with ``original`` (page_id, url, record_id, n; null for a response, and for a revisit whose response isn't
    there): revisits are joined by digest to the first response by (page_id, url, record_id) that has it."""
    parts = [x for c in ("page_id", "url", "record_id") for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    cited = records.where("type = 'revisit'").select("digest").distinct()
    first = records.where("type = 'response'").join(cited, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct(*parts, "n")).alias("f"))
    first = first.select("digest", F.struct(*(F.col(f"f.{c}").alias(c) for c in ("page_id", "url", "record_id", "n"))).alias("original"))
    first = _small(first, F.coalesce(F.octet_length("original.url"), F.lit(0)), "warc-cited").withColumn("type", F.lit("revisit"))
    return records.join(first, ["digest", "type"], "left").select(*records.columns, "original")


def rewrite(spark: SparkSession, path: str, out_path: str, compression: str = "none") -> None:
    """Archives to archives: each payload of at least LEAST bytes once among all of ``path``, revisits named anew. Record ids and dates stay; a revisit
    whose response isn't there keeps what it refers to."""
    write_archive(read_archive(spark, path), out_path, compression)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages (page_id, url, html) as an archive and reads it back: page_id, payload_bytes, payload_digest, record_type, refers_to (the
    response's page_id), url, record_id. One row per page; nulls, ties, repeats and other columns as in ``write_archive``."""
    spark = pages.sparkSession
    path = path or work_path(spark, "warc")
    write_archive(entries(pages), path)
    heads = materialize(read_archive(spark, path, payloads=False).drop("payload"), "warc-heads")
    return resolve(heads).select("page_id", F.coalesce("n", F.col("original.n")).alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                                 F.col("type").alias("record_type"), F.col("original.page_id").alias("refers_to"), "url", "record_id")


SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS LAST) AS k,
             first_value(page_id) OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS LAST) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND k > 1 THEN first_id END AS refers_to FROM r"""
