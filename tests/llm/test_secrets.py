import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.conftest import SF01
from tokenloom.llm import secrets as ss

PATTERNS = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24), ("live", "[A-Za-z0-9+/_-]+", 20)]


def matches(text):
    out = []
    for k, (name, p, least) in enumerate(PATTERNS):
        p = re.sub(r"^\((.*?)\)", lambda m: f"((?i:{m[1]}))", p) if k == 0 else p
        for m in re.finditer(p, text, re.ASCII):
            v = m[2] if k == 0 else m[0]
            if len(v) >= least:
                out.append((m.start(), k, m.end(), name, v))
    return sorted(out)


def brute(rows):
    owners = {}
    for _, t, o in rows:
        for x in matches(t or ""):
            owners.setdefault(x[4], set()).add(o)
    out = []
    for d, t, _ in rows:
        ms = matches(t or "")
        base = [m for m in ms if m[1] < 3]

        def live(m):
            return len(owners[m[4]]) <= ss.OWNERS and len(m[4]) >= 16 and re.search("[0-9]", m[4]) and re.search("[A-Za-z]", m[4]) and len(set(m[4])) >= 10
        spans = [m for m in ms if m[1] < 3 or live(m) and not any(b[0] <= m[0] and m[2] <= b[2] for b in base)]
        text = lambda xs: ",".join(f"{m[3]}:{m[0]}:{m[2]}" for m in xs)
        n = [sum(m[1] == k for m in base) for k in range(3)]
        out.append((d, *n, hashlib.sha256(text(base).encode()).hexdigest(), text(spans)))
    return sorted(out, key=str)


def got(df):
    r = ss.scan(df, F.col("source"), F.concat("source", F.lit("/x")))
    return sorted((tuple(x) for x in r.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()), key=str)


def test_documents_against_python(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert any(x[5] for x in want) and got(docs) == want


def test_random_and_odd_texts(spark):
    r = random.Random(8)
    bits = ["password", "TOKEN", "api_key", "ApiKey", "secret", "=", ":", " ", "'", '"', "abc", "deadbeef0123", "AKIA", "ABCDEF0123456789", "🙂", "é", "\n", "x9", "-", "token=token:abcdefgh", "0123456789abcdef01234567", "Zq9+kd83JJsla0/dkeYY2"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(25))), f"s{r.randrange(4)}") for i in range(300)]
    rows += [(900, None, "a"), (901, "", None), (None, "password=abcdefg", "a"), (None, "password=abcdefg", "a"), (902, "AKIA" * 30000, "b"), (903, "password = abcdef " * 3000, "c")]
    df = spark.createDataFrame([(*x, 5) for x in rows], "doc_id long, text string, source string, kind int")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []


def test_ownership(spark):
    rows = [("h", "a", "r1"), ("h", "a", "r1"), ("h", "a", "r2"), ("h", None, "r3"), ("g", "b", "r")]
    assert {tuple(x) for x in ss.ownership(spark.createDataFrame(rows, "hash string, owner string, repo string")).collect()} == {("h", 3, 2, 4), ("g", 1, 1, 1)}


def test_many_repositories_of_one_owner(spark):
    wide, own = "Zq9+kd83JJsla0/dkeYY2", "Hb7+pw52MMxtc4/uioRR9"
    rows = [(i, f"x {wide} y", "a", f"r{i}") for i in range(6)] + [(10, f"x {own} y", "b", "r1"), (11, f"x {own} y", "b", "r2")]
    out = {r.doc_id: r for r in ss.scan(spark.createDataFrame(rows, "doc_id long, text string, owner string, repo string"), F.col("owner"), F.col("repo")).collect()}
    assert all(out[i].n_live == 0 and out[i].spans == "" for i in range(6))
    assert all((out[i].n_live, out[i].spans, list(out[i].owners), list(out[i].repos)) == (1, "live:2:23", [1], [2]) for i in (10, 11))
