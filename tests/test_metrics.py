"""Caller's metrics over batches and streams, lookups by size, the count model's plan, averages by chunk, vectors by bin."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import checkpoints as CK
from tokenloom.operators import context as CX
from tokenloom.operators import metrics as MT
from tokenloom.operators.joins import lookup_join
from tokenloom.session import work_path
from tokenloom.streaming import jobs as ST


def mine():
    loss = F.col("loss")
    return [MT.Metric("mean", {"s": ("sum", loss), "n": ("count", loss)}, lambda p: F.try_divide(p["s"], p["n"])),
            MT.Metric("worst", {"m": ("max", loss)}, lambda p: p["m"]), MT.Metric("first", {"m": ("min", F.col("step"))}, lambda p: p["m"])]


def test_metric_sets(spark):
    r = random.Random(1)
    rows = [(i, r.choice("ab"), None if i % 17 == 0 else r.randrange(0, 64) / 8) for i in range(300)]
    log = spark.createDataFrame(rows, "step long, host string, loss double").repartition(5)
    ms = MT.MetricSet(mine(), log)

    def want(rows):
        known = [x for *_, x in rows if x is not None]
        return sum(known) / len(known), max(known), min(i for i, *_ in rows)
    assert tuple(ms.evaluate(log).first()) == want(rows)
    parts = ms.partial(log.where("step < 100")).unionByName(ms.partial(log.where("step >= 100"))).unionByName(ms.partial(log.limit(0)))
    assert tuple(ms.finals(ms.merge(parts)).first()) == want(rows)
    by = {x.host: tuple(x)[1:] for x in ms.evaluate(log, ["host"]).collect()}
    assert by == {h: want([x for x in rows if x[1] == h]) for h in "ab"}
    assert tuple(ms.evaluate(log.limit(0)).first()) == (None, None, None)
    two = [MT.Metric("x", {"s": ("sum", F.col("loss"))}, lambda p: p["s"])]
    for wrong in ([], two * 2, [MT.Metric("x", {"s": ("median", F.col("loss"))}, lambda p: p["s"])], [MT.Metric("x", {"s": ("sum", F.col("nothing"))}, lambda p: p["s"])],
                  [MT.Metric("x", {"s": ("sum", F.avg("loss"))}, lambda p: p["s"])], [MT.Metric("x", {"s": ("sum", F.col("loss"))}, lambda p: p["s"] + F.col("loss"))]):
        with pytest.raises(ValueError):
            MT.MetricSet(wrong, log)


def test_metrics_over_a_stream(spark):
    """Three files, one a trigger; an epoch that is written again counts once; G9 and G10 are sets like any other."""
    log = spark.createDataFrame([(i, (i % 7) / 4 + 0.5, i % 5 + 1) for i in range(90)], "step long, loss double, n long")
    src, out, ck = (work_path(spark, f"sm-{x}") for x in ("src", "out", "ck"))
    log.repartitionByRange(3, "step").write.parquet(src)
    for metrics, plain in ((MT.step_metrics(), MT.ppl_step_mean), (MT.token_metrics(), MT.ppl_token_weighted)):
        ms = MT.MetricSet(metrics, log)
        name = metrics[0].name
        got = ST.stream_metrics(ST.file_stream(spark, src, log.schema), ms, f"{out}-{name}", f"{ck}-{name}")
        first = got.first()
        again = spark.read.parquet(f"{out}-{name}/epoch=1")
        again = spark.createDataFrame(again.collect(), again.schema)
        again.write.mode("overwrite").parquet(f"{out}-{name}/epoch=1")
        replayed = ms.finals(ms.merge(spark.read.parquet(f"{out}-{name}")))
        for row in (first, replayed.first()):
            for a, b in zip(row, plain(log).first()):
                assert math.isclose(a, b, rel_tol=1e-12)
        assert spark.read.parquet(f"{out}-{name}").select("epoch").distinct().count() == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join(spark, how):
    """The same rows by broadcast and by hot and cold parts, one key holding a third of all; null and unknown keys too."""
    r = random.Random(2)
    rows = [(i, None if i % 50 == 0 else 7 if i % 3 == 0 else r.randrange(0, 400)) for i in range(3000)]
    left = spark.createDataFrame(rows, "i long, k long").repartition(4)
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 400, 2)] + [(7, "hot")], "k long, v string")
    known = {k: f"v{k}" for k in range(0, 400, 2)} | {7: "hot"}
    want = sorted((i, -1 if k is None else k, known.get(k, "")) for i, k in rows if how == "left" or k in known)
    for limit, hot in ((1000, 5), (10, 5), (10, 1)):
        got = lookup_join(left, table, "k", how, broadcast_rows=limit, hot_keys=hot).select("i", "k", "v").collect()
        assert sorted((x.i, -1 if x.k is None else x.k, x.v or "") for x in got) == want


def test_count_model_plan(spark):
    """No window over the model, and its losses by definition."""
    r = random.Random(3)
    ids = [min(int(r.expovariate(0.1)), 59) for _ in range(2000)]
    vocab = spark.range(60).select(F.col("id"))
    model = MT.count_model(spark.createDataFrame([(x,) for x in ids], "id long"), vocab, [0, 5, 20, 60])
    plan = model._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    for x in model.collect():
        b = 0 if x.id < 5 else 1 if x.id < 20 else 2
        inside = [i for i in ids if (i == x.id if b == 0 else (5, 20, 60)[b - 1] <= i < (5, 20, 60)[b])]
        loss = -math.log((len(inside) + 1) / (len(ids) + 7))
        if b:
            loss -= math.log((ids.count(x.id) + 1) / (len(inside) + (15, 40)[b - 1]))
        assert math.isclose(x.loss, loss, rel_tol=1e-12)


def test_average_chunks(spark, monkeypatch):
    monkeypatch.setattr(CK, "CHUNK", 4)
    r = random.Random(4)
    sizes = {"a": 11, "b": 4, "c": 1, "e": 0}
    data = {(c, v): [r.randrange(-64, 64) / 8 for _ in range(n)] for c in (3, 5, 9) for v, n in sizes.items()}
    rows = [(c, v, x) for (c, v), x in data.items()] + [(c, "global_step", [1.0]) for c in (3, 5, 9)] + [(7, "a", [1.0]), (5, "only", [2.0])]
    params = spark.createDataFrame(rows, "ckpt long, name string, values array<float>").repartition(3)
    got = {}
    for x in sorted(CK.average_chunks(params, [9, 5, 3]).collect(), key=lambda x: (x.name, x.chunk)):
        got.setdefault(x.name, []).extend(x["values"])
    assert got == {v: [sum(data[c, v][k] for c in (9, 5, 3)) / 3 for k in range(n)] for v, n in sizes.items()}
    for bad in ([(3, "d", [1.0])], [(c, "d", [1.0] * (1 + (c == 9))) for c in (3, 5, 9)]):
        with pytest.raises(Exception, match="checkpoint: d"):
            CK.average_chunks(params.unionByName(spark.createDataFrame(bad, params.schema)), [3, 5, 9]).collect()


def test_binned_vectors(spark):
    r = random.Random(5)
    cuts, widths, d = [0, 3, 10], [4, 2], 4
    tables = [[(i, [float(r.randrange(-4, 5)) for _ in range(w)]) for i in range(hi - lo) if i != 2] for w, lo, hi in zip(widths, cuts, cuts[1:])]
    m = [[1.0, 0.5, 0.0, -1.0], [2.0, 0.0, 1.0, 0.25]]
    vectors = CX.binned_vectors([spark.createDataFrame(t, "row long, embedding array<float>") for t in tables], [None, m], d)
    tokens = spark.createDataFrame([(p, r.randrange(0, 10)) for p in range(60)], "p long, id long")
    for x in CX.binned_lookup(tokens, vectors, cuts).collect():
        b = int(x.id >= 3)
        row = dict(tables[b]).get(x.id - cuts[b])
        want = None if row is None else [2.0 * v for v in row] if b == 0 else [2.0 * sum(row[i] * m[i][j] for i in range(2)) for j in range(4)]
        assert x.bin == b and (x.vector is None) == (want is None) and (want is None or x.vector == want)
    with pytest.raises(Exception, match="doesn't fit"):
        CX.binned_vectors([spark.createDataFrame(t, "row long, embedding array<float>") for t in tables], [None, None], d).collect()


def test_average_of_uneven_checkpoints(spark):
    """Checkpoints that lack a variable, repeat one or hold a shorter one, as the query's SQL has it: the sum over the number of checkpoints. Names are those of the first."""
    rows = [(2, "a", [1.0, 2.0]), (3, "a", [4.0, 8.0]), (4, "a", [1.0, 2.0]), (2, "b", [3.0]), (2, "c", [6.0, 3.0]), (4, "c", [6.0]), (4, "c", [6.0]), (2, "d", [1.0, None]), (4, "d", [2.0]), (3, "e", [5.0])]
    params = spark.createDataFrame(rows, "ckpt long, name string, values array<float>")
    got = {(x.name, x.pos): x.value for x in CK.average_params(params, [2, 3, 4], missing="zero").collect()}
    assert got == {("a", 0): 2.0, ("a", 1): 4.0, ("b", 0): 1.0, ("c", 0): 6.0, ("c", 1): 1.0, ("d", 0): 1.0, ("d", 1): None}


def test_average_params_of_a_table_of_eight_rows(spark, tmp_path):
    from tokenloom.plans import queries as Q
    spark.createDataFrame([(i, [float(i), 3.0]) for i in range(8)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(x.name, x.pos): x.value for x in Q.q_average_params(spark, str(tmp_path)).collect()}
    assert got == {("v00000", 0): 3.0, ("v00000", 1): 3.0, ("v00001", 0): round(7 / 3, 6), ("v00001", 1): 1.0}
