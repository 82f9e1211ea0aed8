import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import topk


def brute(rows, k):
    v = {}
    for i, x, *_ in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v.setdefault(i, []).append([math.floor(64 * c) for c in x])
    out = []
    for q in v:
        if q % 20 == 0:
            for a in {tuple(x) for x in v[q]}:
                s = sorted((-sum(m * n for m, n in zip(a, b, strict=False)), i) for i in v if i != q for b in v[i])[:k]
                out += [(q, r, i, -t) for r, (t, i) in enumerate(s, 1)]
    return sorted(out)


def rows(seed: int, n: int, big: float = 1.0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, big) for _ in range(6)] for _ in range(n // 3)]
    out = [(i, [float(np.float32(x)) for x in rng.choice(base)], "s") for i in range(n)]
    return [*out, (n, None, "s"), (n + 1, [0.5, None, 1.0], "s"), (20 * n, [math.nan] * 6, "s"), (n + 3, [math.inf] * 6, "s"), (40, [], "s"), (40, [], "s"), (7, [0.1] * 6, "s"), (60, [1.0, 2.0], "s"), (None, [1.0] * 6, "s")]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCKS", 2)
    monkeypatch.setattr(topk, "QUERIES", 16)
    monkeypatch.setattr(topk, "ROWS", 32)
    for r in (rows(1, 700), rows(2, 100, 1e7)):
        df = spark.createDataFrame(r, "vec_id long, embedding array<double>, score string").repartition(5)
        got = sorted(tuple(x) for x in topk.top_k(df, F.col("vec_id") % 20 == 0, 20).collect())
        assert got == brute(r, 20)
    few = spark.createDataFrame(r[:3], "vec_id long, embedding array<double>, score string")
    assert sorted(tuple(x) for x in topk.top_k(few, F.col("vec_id") % 20 == 0).collect()) == brute(r[:3], 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_prune():
    rng = np.random.default_rng(0)
    blocks = [(np.arange(b * 64, b * 64 + 64), (rng.integers(-3, 4, (64, 8)) + 40 * rng.permutation(np.eye(8, dtype=int))[0])) for b in range(40)]
    q = rng.integers(0, 5, (30, 8)) + 20 * np.eye(8, dtype=int)[rng.integers(0, 8, 30)]
    ids, scores, n, scored = topk.best(np.full(30, -1), q, blocks, 5)
    every = np.concatenate([m for _, m in blocks]) @ q.T
    for i in range(30):
        want = sorted((-s, j) for j, s in enumerate(every[:, i].tolist()))[:5]
        assert [(-s, j) for s, j in zip(scores[i].tolist(), ids[i].tolist(), strict=True)] == want
    assert (n == 5).all() and scored < 30 * 40 / 2
