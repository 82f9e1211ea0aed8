import hashlib
import math
import random

import numpy as np
import pytest

from tessera.llm import kmeans

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def brute(rows, k, rounds, dim, scale):
    """Plain rounds in Python's integers."""
    v = [(i, [math.floor(scale * float(np.float32(c))) for c in x]) for i, x, *_ in rows if x is not None and len(x) == dim and all(c is not None and math.isfinite(np.float32(c)) for c in x)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in v if i is not None)[:k]
    cents = [x for _, x in first]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        of = [min(range(len(cents)), key=lambda j: (apart(x, cents[j]), j)) for _, x in v]
        if turn < rounds:
            for j in set(of):
                mine = [x for (_, x), o in zip(v, of, strict=True) if o == j]
                cents[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    far = [apart(x, cents[o]) for (_, x), o in zip(v, of, strict=True)]
    own = [sum(f for f, o in zip(far, of, strict=True) if o == j) for j in range(len(cents))]
    long = lambda n: n if n < 2**63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, o, long(f), long(own[o]), long(sum(far)), sha[o]) for (i, _), o, f in zip(v, of, far, strict=True)), key=repr)


def rows(seed, n, dim, big=1.0):
    rng = random.Random(seed)
    base = [[rng.gauss(0, big) for _ in range(dim)] for _ in range(n // 4)]
    out = [(i * 3, [x + rng.choice([0, 0, 0.3]) for x in rng.choice(base)], 1, "c") for i in range(n)]
    bad = [(5, None, 1, "c"), (7, [1.0] * (dim - 1), 1, "c"), (8, [], 1, "c"), (10, [math.nan] + [0.0] * (dim - 1), 1, "c"), (11, [math.inf] * dim, 1, "c"), (13, [None] + [1.0] * (dim - 1), 1, "c")]
    return [*out, *bad, (None, [0.5] * dim, 1, "c"), out[0], out[0], (out[0][0], [9.0] * dim, 1, "c")]


@pytest.mark.parametrize(("n", "k", "big"), [(150, 7, 1.0), (60, 5, 1e5), (40, 4, 1e9), (30, 4, 1e36), (5, 40, 1.0)])
def test_matches_whole_numbers(spark, monkeypatch, n, k, big):
    monkeypatch.setattr(kmeans, "ROWS", 16)
    r = rows(k, n, 4, big)
    out, found = kmeans.cluster(spark.createDataFrame(r, SCHEMA).repartition(3), k, 5, 4)
    assert sorted((tuple(x) for x in out.collect()), key=repr) == brute(r, k, 5, 4, 256)
    assert sum(found.count) == out.count()


def test_small_and_huge_components_meet(spark):
    """Most rows fit floats, one is beyond 64 bits and starts a centroid."""
    r = [*rows(3, 40, 4), (1_000_001, [3e38, -3e38, 1.0, 0.0], 1, "c"), (1_000_002, [1e14, 0.0, 0.0, 0.0], 1, "c")]
    out, _ = kmeans.cluster(spark.createDataFrame(r, SCHEMA), 50, 3, 4)
    assert sorted((tuple(x) for x in out.collect()), key=repr) == brute(r, 50, 3, 4, 256)


def test_floats_hold_what_the_limit_allows():
    most = kmeans.limit(64)
    x = np.full((2, 64), most, np.int64)
    _, far = kmeans.nearest(x, -x[:1])
    assert far.tolist() == [64 * (2 * most) ** 2] * 2 and far[0] < 2**53
    _, far = kmeans.nearest(x + 1, -x[:1] - 1)
    assert far.tolist() == [64 * (2 * most + 2) ** 2] * 2


def test_empty_table_and_ids_that_are_text(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert kmeans.cluster(none)[0].count() == 0
    unnamed = spark.createDataFrame([(None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert kmeans.cluster(unnamed, 3, 2, 2)[0].count() == 0
    named = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [5.0, 2.0])], "vec_id string, embedding array<double>")
    assert [tuple(r)[:3] for r in kmeans.cluster(named, 1, 0, 2)[0].orderBy("vec_id").collect()][0][0] == "a"
