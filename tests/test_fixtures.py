"""The worked cases of FIXTURES.md §3."""

import math

import pytest

from tests import model
from tokenloom.operators import metrics as MT
from tokenloom.operators import vocab as V
from tokenloom.plans import word_corpus as WC


def _stream(spark, ids):
    return spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "p bigint, id bigint")


def test_vocab_case(spark):
    docs = spark.createDataFrame([(0, "b a b\nc a <unk>", "s")], "doc_id bigint, text string, source string")
    from tokenloom.sources.text import read_lines
    lines = WC.single_split(read_lines(docs))
    cfg = WC.WordConfig(special=("<eos>", "<unk>"))
    counts = WC.corpus_counts(lines, cfg)
    got = {r["sym"]: r["cnt"] for r in counts.collect()}
    assert got == {"b": 2, "a": 2, "c": 1, "<unk>": 1}
    v = V.build_vocab(counts, cfg.special)
    assert sorted((r["id"], r["sym"]) for r in v.collect()) == [(0, "<eos>"), (1, "<unk>"), (2, "b"), (3, "a"), (4, "c")]
    v2 = V.build_vocab(counts, cfg.special, max_size=2)
    assert sorted((r["id"], r["sym"]) for r in v2.collect()) == [(0, "<eos>"), (1, "<unk>"), (2, "b"), (3, "a")]
    v3 = V.build_vocab(counts, cfg.special, min_freq=2)
    assert v3.count() == 4


IDS23 = [0, 2, 4, 3, 1, 5, 0, 2, 1, 0, 4, 3, 2, 0, 5, 1, 1, 2, 3, 0, 4, 1, 2]


def test_windows_case(spark):
    st = _stream(spark, IDS23)
    ex = WC.build_examples(st, len(IDS23), 2, 4, 1, [0, 2, 4, 6], [1, 8], fixed=True)
    rows = {(r["w"], r["r"]): r for r in ex.collect()}
    assert sorted(rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    r = rows[(0, 0)]
    assert r["inputs"] == [0, 2, 4, 3] and r["labels"] == [2, 4, 3, 1]
    assert r["head_labels"] == [2, 3, 2, 1]
    assert [int(x) for x in r["inp_mask"]] == [1, 0, 0, 0]
    assert [(b["bin"], b["cnt"], b["tup"]) for b in r["inp_bins"]] == [(0, 1, [1, 0]), (1, 1, [2, 0])]
    r = rows[(0, 1)]
    assert r["inputs"] == [3, 2, 0, 5] and r["head_labels"] == [2, 0, 3, 1]
    assert [(b["cnt"], b["tup"]) for b in r["inp_bins"]] == [(0, []), (1, [3, 1])]
    r = rows[(1, 0)]
    assert r["inputs"] == [1, 5, 0, 2] and [(b["cnt"], b["tup"]) for b in r["inp_bins"]] == [(1, [3, 0]), (1, [1, 0])]
    r = rows[(1, 1)]
    assert r["inputs"] == [1, 1, 2, 3] and [b["cnt"] for b in r["inp_bins"]] == [0, 0]
    ragged = {(r["w"], r["r"]): r for r in WC.build_examples(st, len(IDS23), 2, 4, 1, fixed=False).collect()}
    assert ragged[(2, 0)]["inputs"] == [1, 0] and ragged[(2, 0)]["labels"] == [0, 4]
    assert ragged[(2, 1)]["inputs"] == [0, 4] and ragged[(2, 1)]["labels"] == [4, 1]


def test_windows_match_the_definition(spark):
    import random
    rnd = random.Random(7)
    for n, B, T, C in ((97, 4, 5, 2), (200, 8, 7, 4), (64, 2, 16, 1), (31, 3, 4, 1)):
        data = [rnd.randrange(0, 12) for _ in range(n)]
        cut = [0, 3, 6, 9, 12]
        bs = [2, 3, 1]
        for fixed in (False, True):
            got = [r.asDict() for r in WC.build_examples(_stream(spark, data), n, B, T, C, cut if fixed else None,
                                                         bs if fixed else None, fixed=fixed).collect()]
            for g in got:
                for side in ("inp", "tgt"):
                    if fixed:
                        g[f"{side}_mask"] = [int(x) for x in g[f"{side}_mask"]]
                        g[f"{side}_bins"] = [(b["bin"], b["cnt"], b["tup"]) for b in g[f"{side}_bins"]]
            model.check_windows(got, data, B, T, C, cut if fixed else (), bs, fixed)


def test_bin_sizes_match_the_definition(spark):
    import random
    from tokenloom.operators.bins import bin_sizes, collect_bin_sizes
    rnd = random.Random(3)
    data = [min(int(rnd.expovariate(0.08)), 59) for _ in range(3000)]
    cut = [0, 5, 15, 30, 60]
    got = collect_bin_sizes(bin_sizes(_stream(spark, data), len(data), 4, 16, cut))
    assert got == model.bin_sizes(data, 4, 16, cut)


@pytest.mark.slow
def test_bin_sizes_case_sf001(spark):
    from tests.conftest import SF01
    from tokenloom.operators.bins import bin_sizes
    from tokenloom.plans.queries import Corpus
    c = Corpus(spark, SF01)
    rows = bin_sizes(c.split(), c.N["train"], 4, 32, c.cutoffs).orderBy("bin").collect()
    assert [round(r["raw"], 3) for r in rows] == [40.030, 30.139, 28.667]
    assert [r["size"] for r in rows] == [40, 32, 32]


def test_metrics_case(spark):
    log = spark.createDataFrame([(0, 2.0, 10), (1, 4.0, 30)], "step bigint, loss double, n bigint")
    a = MT.ppl_step_mean(log).collect()[0]
    assert math.isclose(a["perplexity"], 30.993603, abs_tol=1e-6) and math.isclose(a["bpc"], 4.328085, abs_tol=1e-6)
    b = MT.ppl_token_weighted(log).collect()[0]
    assert math.isclose(b["perplexity"], 33.115452, abs_tol=1e-6) and math.isclose(b["bpc"], 5.049433, abs_tol=1e-6)
    empty = MT.ppl_token_weighted(log.limit(0)).collect()[0]
    assert empty["loss"] is None


def test_lr_schedule(spark):
    log = spark.createDataFrame([(s,) for s in (0, 500, 1000, 5500, 10000, 12000)], "step bigint")
    got = {r["step"]: r["lr"] for r in MT.lr_by_step(log, 1.0, 1000, 10000, 0.1).collect()}
    assert math.isclose(got[500], 0.5)
    assert math.isclose(got[1000], 1.0)
    assert math.isclose(got[5500], 0.9 * 0.5 + 0.1)
    assert math.isclose(got[10000], 0.1) and math.isclose(got[12000], 0.1)
