"""The search by packed blocks against brute force, and what its bounds leave out."""

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import knn, nearest

ASKS, REFS = "row_id long, truth int, vec array<double>", "ref_id long, code int, vec array<double>"


def clustered(seed, n, m, dim=8, centres=12, spread=0.5):
    rng = np.random.default_rng(seed)
    c = rng.normal(0, 20, (centres, dim))
    ref = [(int(i), int(i % 5), (c[i % centres] + rng.normal(0, spread, dim)).tolist()) for i in range(n)]
    ask = [(int(i), None if i % 9 == 0 else int(i % 5), (c[i % centres] + rng.normal(0, spread, dim)).tolist()) for i in range(m)]
    return ask, ref


def brute(ask, ref, k, exclude_self=False):
    x, ids = np.array([r[2] for r in ref]), np.array([r[0] for r in ref])
    out = {}
    for i, _, v in ask:
        d2 = np.zeros(len(x))
        for c in range(x.shape[1]):
            d2 += (v[c] - x[:, c]) ** 2
        order = [j for j in np.lexsort((ids, d2)) if not (exclude_self and ids[j] == i)][:k]
        out[i] = [(int(ids[j]), d2[j]) for j in order]
    return out


def got(df):
    out = {}
    for r in df.orderBy("row_id", "rank").collect():
        out.setdefault(r.row_id, []).append((r.ref_id, r.d2))
        assert r["rank"] == len(out[r.row_id])
    return out


@pytest.mark.parametrize(("k", "rows", "broadcast", "exclude_self"), [(1, 16, True, False), (7, 64, True, True), (7, 64, False, False), (30, 25, False, True), (5000, 100, True, False)])
def test_matches_brute_force(spark, monkeypatch, k, rows, broadcast, exclude_self):
    monkeypatch.setattr(nearest, "FEWEST", 16)
    monkeypatch.setattr(nearest, "CHUNK", 128)
    monkeypatch.setattr(nearest, "BROADCAST", 1 << 30 if broadcast else 0)
    ask, ref = clustered(k, 700, 90)
    ref += [(10_000 + i, 3, ref[5][2]) for i in range(60)] + [(3, None, ref[9][2])]  # ties, an id that is there twice
    df = spark.createDataFrame(ask, ASKS).repartition(3)
    index = nearest.index(spark.createDataFrame(ref, REFS).repartition(4), rows)
    out = nearest.search(df, index, k, exclude_self)
    assert got(out) == brute(ask, ref, k, exclude_self)
    assert {(r.row_id, r.truth) for r in out.collect()} == {(i, t) for i, t, _ in ask}


def test_blocks_beyond_the_kth_distance_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FEWEST", 16)
    ask, ref = clustered(1, 2000, 200, centres=40, spread=0.2)
    index = nearest.index(spark.createDataFrame(ref, REFS), 25)
    rows = nearest.work(spark.createDataFrame(ask, ASKS), index, 5).collect()
    blocks = index.blocks.count()
    assert sum(r.queries for r in rows) == 200
    assert sum(r.sent for r in rows) < 0.5 * blocks * len(rows) and sum(r.scored for r in rows) <= sum(r.sent for r in rows)


def test_single_precision_is_kept_only_where_exact(spark):
    ref = [(i, 0, [0.5 * i, 1.0 / 3]) for i in range(20)]
    index = nearest.index(spark.createDataFrame(ref, REFS), 5)
    out = nearest.search(spark.createDataFrame([(1, 0, [2.0, 1.0 / 3])], ASKS), index, 3).collect()
    assert [(r.ref_id, r.d2) for r in out] == [(4, 0.0), (3, 0.25), (5, 0.25)]


def test_empty_sides(spark):
    ask, ref = clustered(2, 30, 5)
    a, r = spark.createDataFrame(ask, ASKS), spark.createDataFrame(ref, REFS)
    assert nearest.search(a, nearest.index(r.limit(0)), 3).count() == 0
    assert nearest.search(a.limit(0), nearest.index(r), 3).count() == 0


def test_an_index_serves_several_searches(spark):
    ask, ref = clustered(4, 300, 40)
    a, index = spark.createDataFrame(ask, ASKS), nearest.index(spark.createDataFrame(ref, REFS))
    assert got(nearest.search(a.where("row_id < 20"), index, 4)) | got(nearest.search(a.where("row_id >= 20"), index, 4)) == brute(ask, ref, 4)
    assert got(knn.neighbours(a, index, 4)) == brute(ask, ref, 4)


def test_diagnostics_take_the_search_once(spark):
    """a row for each query serves both what is its own and what is foreign."""
    taken = spark.sparkContext.accumulator(0)
    rows = [(i, i % 3, 1000 * i + j, (i + j * j) % 4, float(i + j), j + 1) for i in range(60) for j in range(5)]

    def count(r):
        taken.add(1)
        return r

    near = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(count), "row_id long, truth int, ref_id long, code int, d2 double, rank int")
    got = {r.code: r for r in knn.diagnostics(near).collect()}
    assert taken.value == len(rows)
    for c in range(3):
        mine = [r for r in rows if r[1] == c]
        foreign = [r[3] for r in mine if r[3] != c]
        partner = min(set(foreign), key=lambda k: (-foreign.count(k), k))
        assert (got[c].size, got[c].partner) == (20, partner)
        assert got[c].purity == round(1 - len(foreign) / len(mine), 6) and got[c].dominance == round(foreign.count(partner) / len(foreign), 6)


def test_batches_of_a_search_are_of_bounded_bytes(spark, monkeypatch):
    """What a worker is handed at a time doesn't grow with the references; the session's bound is as before afterwards."""
    monkeypatch.setattr(nearest, "BATCH", 40_000, raising=False)
    ask, ref = clustered(6, 4000, 60, dim=16)
    a, index = spark.createDataFrame(ask, ASKS), nearest.index(spark.createDataFrame(ref, REFS), 100)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sizes(*_):
        def over(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (b.num_rows, b.nbytes, 0)], ["queries", "sent", "scored"])

        return over

    with monkeypatch.context() as m:
        m.setattr(nearest, "_search", sizes)
        seen = nearest.work(a, index, 5).collect()
    one = max(r.bytes for r in index.blocks.selectExpr("length(data) + length(ids) + length(labels) + 1000 AS bytes").collect())
    assert sum(r.sent for r in seen) > 500_000 and max(r.sent for r in seen) <= 40_000 + one
    assert spark.conf.get(key) == before
    monkeypatch.setattr(nearest, "RETURNED", 32, raising=False)
    assert got(nearest.search(a, index, 5)) == brute(ask, ref, 5)
