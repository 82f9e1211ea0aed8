"""Statistics that SQL can't express, against sums by hand and NumPy."""

import math
import time

import numpy as np
import pytest

from tessera.operators import cohort as C
from tessera.operators import stats as M


def test_hypergeometric_tail(spark):
    rng = np.random.default_rng(4)
    rows = [(int(c), str(v)) for c, v in zip(rng.integers(0, 4, 120), rng.choice(["a", "b"], 120, p=[0.3, 0.7]), strict=True)]
    for r in M.enrichment(spark.createDataFrame(rows, "c int, l string"), "c", "l").collect():
        assert r.hits == sum(x == (r.c, r.l) for x in rows) and r.whole == 120
        total = math.comb(r.whole, r.drawn)
        want = sum(math.comb(r.good, i) * math.comb(r.whole - r.good, r.drawn - i) for i in range(r.hits, min(r.good, r.drawn) + 1)) / total
        assert r.p == pytest.approx(want, abs=1e-6)


def test_hypergeometric_tail_of_large_counts():
    """tails by whole numbers, also with empty sides, and of counts in the hundreds of millions, which took a term a drawn row."""
    for size, good, draws in ((40, 13, 9), (40, 35, 12), (7, 7, 3), (5, 0, 2), (900, 300, 450)):
        for x in range(max(0, draws - size + good), min(good, draws) + 1):
            want = sum(math.comb(good, i) * math.comb(size - good, draws - i) for i in range(x, min(good, draws) + 1)) / math.comb(size, draws)
            assert M._upper_tail(x, draws, good, size) == pytest.approx(want, rel=1e-11)
    half, began = M._upper_tail(50_000_000, 100_000_000, 200_000_000, 400_000_000), time.thread_time()
    assert half == pytest.approx(0.5, abs=1e-4) and half > 0.5
    sd = math.sqrt(1e8 * 0.25 * 3e8 / (4e8 - 1))
    assert M._upper_tail(50_000_000 + round(2 * sd), 100_000_000, 200_000_000, 400_000_000) == pytest.approx(0.02275, abs=1e-4)
    assert time.thread_time() - began < 5


def test_pca_matches_numpy(spark):
    x = np.random.default_rng(1).normal(size=(200, 5)) * [5, 3, 2, 1, 0.5]
    df, share = C.pca(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, vec array<double>"), 2)
    _, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    got = np.array([r.pca for r in df.orderBy("i").collect()])
    assert np.allclose(np.abs(got), np.abs(x @ v[:2].T), atol=1e-6)
    assert np.allclose(share, (s**2 / (s**2).sum())[:2])


def test_average_ranks_and_adjusted_p(spark):
    df = spark.createDataFrame([(float(v),) for v in (3, 1, 3, 2, 3)], "v double")
    assert sorted((r.v, r.rank) for r in M.average_rank(df, "v").collect()) == [(1, 1), (2, 2), (3, 4), (3, 4), (3, 4)]
    p = [0.01, 0.04, 0.03, 0.5]
    q = {r.p: r.q for r in M.benjamini_hochberg(spark.createDataFrame([(x,) for x in p], "p double"), "p").collect()}
    assert [round(q[x], 6) for x in p] == [0.04, 0.053333, 0.053333, 0.5]


def generated(plan):
    """Rows that the explodes of a plan that has run gave."""
    name = plan.nodeName()
    inside = [plan.finalPhysicalPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("numOutputRows").value() if name == "Generate" else 0
    return own + sum(map(generated, inside))


def test_c_index_copies_rows_by_levels_of_time_alone(spark):
    """not by the levels of time times those of the score; groups, equal times, equal scores and nulls are told apart."""
    n = 600
    rows = [(None if i % 3 == 2 else i % 3, float(i * 37 % 211), int(i % 4 != 0), [None, float(i * 91 % 40), float("nan"), i / 7, -0.0, 0.0, 1.5][i % 7]) for i in range(n)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, g int, time double, event int, score double")
    out = M.c_index(df, "time", "event", "score", "id", "g")
    got = {r.g: (r.c_index, r.pairs) for r in out.collect()}
    assert generated(out._jdf.queryExecution().executedPlan()) < 12 * n
    more = lambda a, b: (math.isnan(a) and not math.isnan(b)) or a > b
    for g in (0, 1, None):
        own = [r[1:] for r in rows if r[0] == g]
        both = [(a[2], b[2]) for a in own if a[1] == 1 for b in own if a[0] < b[0]]
        right = sum(0 if a is None or b is None else 1 if more(a, b) else 0 if more(b, a) else 0.5 for a, b in both)
        assert got[g] == (round(right / len(both), 6), len(both))
