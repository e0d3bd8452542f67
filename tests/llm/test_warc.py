import gzip
import hashlib
import random

import duckdb
import pytest

from tests.conftest import SF01
from tokenloom.llm import warc as w
from tokenloom.session import work_path

NAMES = "page_id, payload_bytes, payload_digest, record_type, refers_to"


def brute(rows):
    rows = [(p, u, (h or "").encode()) for p, u, h in rows]
    seen, out = {}, []
    for p, u, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        again = len(h) >= w.LEAST and h in seen
        out.append((p, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", seen[h] if again else None))
        seen.setdefault(h, p)
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(NAMES.split(", ")).collect()), key=str)


def odd_rows():
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>" * 20000
    same = "x" * 99 + "é"
    return [(5, "http://a/", same), (3, "http://b/\r\nX-Page-ID: 7", same), (3, "http://b/", same), (3, "http://b/", same), (4, None, same), (None, "http://n/", same), (None, None, same),
            (1, "u", "x" * 99), (2, "u", "x" * 99), (7, "u", "x" * 100), (6, "u", "x" * 100), (8, "u", None), (9, "u", ""), (10, "u", long), (11, "u", long), (12, "v", "\r\n" * 60), (13, "v", "\r\n" * 60),
            (None, None, "q" * 200), (None, None, "q" * 200)]


def test_odd_rows(spark):
    rows = odd_rows()
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame([(*r, "z", 1, "k") for r in rows], "page_id long, url string, html string, digest string, n int, payload string").repartition(5)
    out = w.round_trip(df)
    assert got(out) == brute(rows)
    assert out.select("record_id").distinct().count() == len(rows)
    assert w.round_trip(df.limit(0)).count() == 0


def test_table_and_sql(spark):
    df = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in df.collect()]
    rows += [(10_000 + i, u, h) for i, (_, u, h) in enumerate(rows[::3])] * 2
    df = spark.createDataFrame(rows, df.schema)
    want = brute(rows)
    assert got(w.round_trip(df)) == want
    pages = df.toPandas()  # noqa: F841 - read by name below
    assert sorted(duckdb.sql(f"SELECT {NAMES} FROM ({w.SQL})").fetchall(), key=str) == want


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(w, "BROADCAST_BYTES", 0)
    rows = odd_rows()
    assert got(w.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))) == brute(rows)


def test_files_are_warc(spark):
    """Each payload is in the files once; headers name the original by the id that its record has."""
    rows = [(i, f"http://h/{i}", "payload " * 40 + str(i % 3)) for i in range(30)]
    path = work_path(spark, "warc-test")
    w.write_archive(w.entries(spark.createDataFrame(rows, "page_id long, url string, html string")), path)
    raw = b"".join(r.content for r in spark.read.format("binaryFile").load(path).collect())
    assert raw.count(b"payload payload") == 3 * 20 and raw.count(b"WARC-Type: revisit\r\n") == 27
    records = {r[2]: r for r in w.parse(raw)}
    assert len(records) == 30
    for i in range(3, 30):
        assert records[i][0] == "revisit" and records[i][5] == records[i % 3][1] and records[i][6] == records[i % 3][6]
    with pytest.raises(ValueError):
        list(w.parse(raw.replace(b"payload payload", b"payload pAyload", 1)))
    with pytest.raises(ValueError):
        list(w.parse(raw[:-50]))


def test_gzip_members():
    def record(i):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + b"body%d" % i
        return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % (i, len(block)) + block + b"\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    raw = b"".join(map(gzip.compress, [info, record(1), record(2)]))
    assert [(r[1], r[-1]) for r in w.parse(raw)] == [("urn:x:1", b"body1"), ("urn:x:2", b"body2")]


def test_rewrite(spark):
    """Two archives with payloads in common, one of them compressed, become one with each payload once; a revisit without its response stays."""
    a, b, out = (work_path(spark, f"warc-{x}") for x in "abc")
    text = [f"text {k} " * 30 for k in range(6)]
    schema = "page_id long, url string, html string"
    w.write_archive(w.entries(spark.createDataFrame([(i, "a", text[i % 3]) for i in range(8)], schema)), a + "/one")
    w.write_archive(w.entries(spark.createDataFrame([(100 + i, "b", text[i % 5]) for i in range(9)], schema)), a + "/two", "gzip")
    lost = spark.createDataFrame([(200, "c", "urn:uuid:lost", None, "00" * 32, None, "urn:uuid:gone", None)], "page_id long, url string, record_id string, date string, digest string, n long, refers_id string, payload binary")
    w.write_archive(lost, a + "/three")
    before = {r.page_id: r.record_id for r in w.read_archive(spark, a).collect()}
    w.rewrite(spark, a, out)
    rows = {r.page_id: r for r in w.resolve(w.read_archive(spark, out)).collect()}
    assert len(rows) == 18 and {k for k, r in rows.items() if r.type == "response"} == {0, 1, 2, 103, 104}
    assert {k: r.record_id for k, r in rows.items()} == before
    want = {**{i: i % 3 for i in range(8)}, **{100 + i: (i % 5 if i % 5 < 3 else 100 + i % 5) for i in range(9)}}
    for k, first in want.items():
        if k != first:
            assert rows[k].original.page_id == first and rows[k].refers_id == before[first]
        else:
            assert bytes(rows[k].payload).decode() in text
    assert rows[200].original is None and rows[200].refers_id == "urn:uuid:gone"
