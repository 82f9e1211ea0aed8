"""Regressions, near names, profiles and displacements against plain NumPy and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cox, knn, names, nearest, ovr, shift, spatial
from tessera.operators import stats as M
from tessera.operators.guards import Refused

COLS = ["a", "b", "c"]


def plain_cox(x, time, event, ridge):
    """Newton steps with risk sets by a mask over all rows."""
    b = np.zeros(x.shape[1])
    for _ in range(60):
        e = np.exp(x @ b)
        g, h = -ridge * b, ridge * np.eye(len(b))
        for i in np.flatnonzero(event):
            at = time >= time[i]
            s0 = e[at].sum()
            m = (e[at, None] * x[at]).sum(0) / s0
            g = g + x[i] - m
            h = h + (e[at, None, None] * x[at, :, None] * x[at, None, :]).sum(0) / s0 - np.outer(m, m)
        step = np.linalg.solve(h, g)
        b = b + step
        if np.abs(step).max() < 1e-12:
            break
    return b, np.sqrt(np.diag(np.linalg.inv(h)))


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(2)
    n = 160
    x = rng.normal(size=(n, 3))
    time = np.ceil(rng.exponential(np.exp(-(0.8 * x[:, 0] - 0.5 * x[:, 2]))) * 12)  # many ties
    event = rng.random(n) < 0.7
    fold = np.arange(n) % 3
    rows = [(i, int(fold[i]), float(time[i]), int(event[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, fold int, time double, event int, a double, b double, c double").repartition(4)
    return df, x, time, event, fold


def test_cox_of_each_fold(people):
    df, x, time, event, fold = people
    got = {(r.fold, r.feature): (r.coef, r.se) for r in M.cox(df, "time", "event", COLS, F.col("fold"), 0.1).collect()}
    for k in range(3):
        b, se = plain_cox(x[fold == k], time[fold == k], event[fold == k], 0.1)
        for i, c in enumerate(COLS):
            assert got[k, c] == pytest.approx((b[i], se[i]), abs=1e-8)


def test_features_alone_and_rows_that_lack_something(people):
    df, x, time, event, _ = people
    more = df.unionByName(df.limit(3).withColumn("time", F.lit(None).cast("double"))).unionByName(df.limit(2).withColumn("a", F.lit(None).cast("double")))
    got = {r.feature: r for r in cox.feature_table(more, "time", "event", COLS, 0.01).collect()}
    for i, c in enumerate(COLS):
        b, se = plain_cox(x[:, [i]], time, event, 0.01)
        assert (got[c].coef, got[c].se, got[c].z) == pytest.approx((b[0], se[0], b[0] / se[0]), abs=1e-8)
        assert got[c].low < got[c].hazard_ratio < got[c].high


def plain_c(time, event, risk):
    right = pairs = 0.0
    for i in np.flatnonzero(event):
        later = time > time[i]
        pairs += later.sum()
        right += (risk[i] > risk[later]).sum() + (risk[i] == risk[later]).sum() / 2
    return right / pairs


def test_best_subset_and_refit(people):
    df, x, time, event, fold = people
    got = {tuple(r.features): r.c_index for r in cox.best_subset(df, "time", "event", "id", COLS, F.col("fold"), 0.1).collect()}
    assert len(got) == 7
    for s in cox.all_subsets(COLS):
        cols = [COLS.index(c) for c in s]
        scores = []
        for k in range(3):
            b, _ = plain_cox(x[fold != k][:, cols], time[fold != k], event[fold != k], 0.1)
            scores.append(plain_c(time[fold == k], event[fold == k], x[fold == k][:, cols] @ b))
        assert got[s] == pytest.approx(np.mean(scores), abs=2e-6)
    out = cox.refit(df, "time", "event", "id", COLS, F.col("fold"), (0.1, 500.0)).collect()
    b, se = plain_cox(x, time, event, out[0].ridge)
    assert [(r.coef, r.se) for r in out] == [pytest.approx((u, v), abs=1e-8) for u, v in zip(b, se, strict=True)]
    top = cox.best_subset(df, "time", "event", "id", COLS, F.col("fold"), 0.1).first()
    assert top.c_index == max(got.values())


def test_score_equations_in_sql(people):
    duckdb = pytest.importorskip("duckdb")
    df, *_ = people
    b, _ = cox.regressions(df, "time", "event", COLS, [cox.Fit(None, 0.1, tuple(COLS))])[0]
    p = df.toPandas()  # noqa: F841  read by name below
    risk = " + ".join(f"{c} * {v!r}" for c, v in zip(COLS, map(float, b), strict=True))
    sums = ", ".join(f"sum({c} * exp({risk})) OVER w AS s_{c}" for c in COLS)
    g = ", ".join(f"sum({c} - s_{c} / s) - 0.1 * {float(v)!r} AS g_{c}" for c, v in zip(COLS, b, strict=True))
    row = duckdb.sql(f"SELECT {g} FROM (SELECT *, sum(exp({risk})) OVER w AS s, {sums} FROM p WINDOW w AS (ORDER BY time DESC)) WHERE event = 1").fetchall()[0]
    assert row == pytest.approx((0.0, 0.0, 0.0), abs=1e-7)


def test_a_fold_without_events_and_features_that_say_the_same(spark, people):
    df, *_ = people
    none = cox.regressions(df.withColumn("event", F.lit(0)), "time", "event", COLS, [cox.Fit(None, 0.25, ("a",))])
    assert none[0][0].tolist() == [0.0, 0.0, 0.0] and none[0][1].tolist() == [2.0, 0.0, 0.0]
    with pytest.raises(Refused, match="penalty"):
        cox.regressions(df.withColumn("b", F.lit(0.0)), "time", "event", COLS, [cox.Fit(None, 0.0, ("a", "b"))])


def test_one_vs_rest(spark):
    rng = np.random.default_rng(5)
    n, d, k = 240, 4, 3
    label = rng.integers(0, k, n)
    x = rng.normal(size=(n, d)) + np.eye(k, d)[label] * 1.5
    fold = np.arange(n) % 2
    df = spark.createDataFrame([(i, int(label[i]), int(fold[i]), x[i].tolist()) for i in range(n)] + [(n, None, 0, x[0].tolist()), (n + 1, 1, 0, None)], "id int, label int, fold int, vec array<double>").repartition(3)
    model = ovr.fit(df, "label", "vec", "fold", ridge=0.5)
    one = np.column_stack([np.ones(n), x])
    for f in range(2):
        use = fold != f
        for c in range(k):
            b = model.b[f, c]
            chance = 1 / (1 + np.exp(-one[use] @ b))
            g = one[use].T @ (chance - (label[use] == c)) + np.concatenate([[0], 0.5 * b[1:]])
            assert np.abs(g).max() < 1e-6
    scored = ovr.predict(df.where("label is not null"), model, "vec", "fold", ("id", "label"))
    rows = {r.id: r for r in scored.collect()}
    for i in range(0, n, 7):
        want = 1 / (1 + np.exp(-(model.b[fold[i]] @ one[i])))
        assert rows[i].chances == pytest.approx(want.tolist()) and rows[i].predicted == int(want.argmax())
    chance = np.array([rows[i].chances for i in range(n)])
    for r in ovr.class_auc(scored, "label", model).collect():
        own, rest = chance[label == r.label, r.label], chance[label != r.label, r.label]
        want = ((own[:, None] > rest).sum() + (own[:, None] == rest).sum() / 2) / (len(own) * len(rest))
        assert r.auc == pytest.approx(want, abs=1e-6) and r.positives == len(own)
    m = {(r.label, r.predicted): r.n for r in ovr.error_matrix(scored, "label").collect()}
    assert sum(m.values()) == n and m[1, 1] == sum(label[i] == 1 and rows[i].predicted == 1 for i in range(n))
    with pytest.raises(Refused):
        ovr.fit(df.limit(0), "label", "vec")


def edited(rng, s):
    s = list(s)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        if s and rng.random() < 0.5:
            s.pop(rng.randrange(len(s)))
        else:
            s.insert(rng.randrange(len(s) + 1), rng.choice("abX0-"))
    return "".join(s)


def plain_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


@pytest.mark.parametrize("least", [90.0, 95.0, 100.0])
def test_near_names_are_all_found(spark, least):
    rng = random.Random(int(least))
    known = [f"TCGA-{rng.choice('AB')}{rng.randrange(9)}-{rng.randrange(300):04d}-{rng.choice(['01A', '11B'])}" for _ in range(60)] + ["", "a", "ab", "aaaa", "aaaaaaaaaa", "Straße-12345", "x" * 40, "日本語のスライド名前です"]
    asked = [edited(rng, s) for s in known for _ in range(2)] + [s.lower() for s in known] + [None]
    a, k = spark.createDataFrame([(x,) for x in asked], "q string"), spark.createDataFrame([(x,) for x in known] + [(None,)], "s string")
    got = {(r.asked, r.known): r.ratio for r in names.near_names(a, k, "q", "s", least).collect()}
    want = {}
    for x in {x.lower() for x in asked if x is not None}:
        for y in {y.lower() for y in known}:
            if (r := plain_ratio(x, y)) >= least:
                want[x, y] = round(r, 6)
    assert got == want
    best = {r.asked: r.known for r in names.closest(a, k, "q", "s", least).collect()}
    for x in {x for x in asked if x is not None}:
        own = sorted((-r, y) for (p, y), r in want.items() if p == x.lower())
        assert (x in best) == bool(own) and (not own or best[x].lower() == own[0][1])


def test_displacements_of_dense_and_sparse_tiles(spark, monkeypatch):
    rng = np.random.default_rng(0)
    at = {(p, *map(int, xy)) for p, n, far in (("a", 900, 300), ("b", 900, 300), ("a", 20, 5000), ("b", 20, 5000)) for xy in rng.integers(-far, far, (n, 2))}
    rows = [("c1", i, float(x), float(y), p) for i, (p, x, y) in enumerate(at)] + [("c2", 1, 0.0, 0.0, "a"), ("c2", 2, 3.0, 4.0, "b"), ("c2", 3, 0.0, 0.0, "b"), ("c3", 1, 1.0, 1.0, "a"), ("c4", 1, None, 1.0, "a"), ("c4", 2, 1.0, 1.0, "b")]
    df = spark.createDataFrame(rows, "core string, cell int, x double, y double, phenotype string")
    a, b = (np.array([(x, y) for p, x, y in at if p == q]) for q in "ab")
    d2 = np.unique(((a[:, None] - b) ** 2).sum(2))
    want = {"c1": round(float(np.sqrt(d2[d2 > 0]).mean()), 6), "c2": 5.0}
    for few in (50_000, 0):
        monkeypatch.setattr(spatial, "FEW_PAIRS", few)
        assert {r.core: r.mean_distance for r in spatial.mean_distance(df, "a", "b").collect()} == want
    parts = df.withColumn("x", F.col("x") + 0.5)
    assert {r.core: r.mean_distance for r in spatial.mean_distance(parts.where("core = 'c2'"), "a", "b").collect()} == {"c2": 5.0}


def test_profile_and_verdicts(spark):
    rng = np.random.default_rng(1)
    ref, near_, far = rng.gamma(4, 1, 3000), rng.gamma(4, 1, 800), rng.gamma(4, 1, 800) + 9
    frame = lambda d: spark.createDataFrame([(f"s{i % 4}", float(x), float(i % 10) / 10) for i, x in enumerate(d)] + [("s0", float("inf"), 0.5), ("s0", None, 0.5)], "slides string, neighbor_distance double, vote_margin double")
    profile = shift.build_profile(frame(ref), "tuned")
    assert profile.distance == pytest.approx(np.quantile(ref, shift.LEVELS).tolist())
    for d, want in ((near_, "consistent"), (far, "alarm")):
        r = shift.compare(frame(d), profile, "tuned").first()
        pct = 100 * np.interp(np.median(d), profile.distance, shift.LEVELS)
        assert (r.n, r.n_finite, r.verdict) == (len(d) + 2, len(d), want)
        assert r.median_percentile == pytest.approx(pct) and r.beyond == pytest.approx((d > profile.distance[8]).mean())
        own = [(d[i::4] > profile.distance[8]).mean() for i in range(4)]
        assert r.spread == pytest.approx(max(own) - min(own))
    mixed = spark.createDataFrame([("good", float(x), 0.5) for x in near_] + [("bad", 99.0, 0.05)] * 60, "slides string, neighbor_distance double, vote_margin double")
    r = shift.compare(mixed, profile, "tuned").first()
    assert (r.verdict, r.concentrated) == ("notice", True)
    with pytest.raises(Refused, match="legacy"):
        shift.compare(frame(near_), profile, "legacy")
    none = shift.compare(frame(near_).where("neighbor_distance > 1e300"), profile, "tuned").first()
    assert (none.verdict, none.n_finite, none.median_percentile) == ("consistent", 0, None)
    with pytest.raises(Refused, match="finite"):
        shift.build_profile(frame(near_).where("neighbor_distance > 1e300"), "tuned")


def test_exact_medoids(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 3), rng.normal(size=5).tolist()) for i in range(900)] + [(1000, 4, [1.0] * 5), (999, 4, [1.0] * 5)]
    got = {r.code: (r.medoid, r.n, r.cost) for r in knn.exact_medoids(spark.createDataFrame(rows, "ref_id long, code int, vec array<double>")).collect()}
    for c in (0, 1, 2):
        x = np.array([v for _, k, v in rows if k == c])
        cost = ((x[:, None] - x) ** 2).sum(2).sum(1)
        assert got[c][0] == 3 * int(cost.argmin()) + c and got[c][2] == pytest.approx(cost.min())
    assert got[4] == (999, 2, 0.0)


def test_a_stream_packs_its_references_once(spark, tmp_path, monkeypatch):
    from tessera.streaming import classify

    made = []
    monkeypatch.setattr(nearest, "index", lambda *a, real=nearest.index, **k: made.append(1) or real(*a, **k))
    refs = spark.createDataFrame([(i, i % 2, [float(i % 2), 1.0 * i]) for i in range(60)], "ref_id long, code int, vec array<double>")
    asks = spark.createDataFrame([(i, 0, [0.0, 1.0 * i]) for i in range(20)], "row_id long, truth int, vec array<double>")
    asks.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(asks.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    classify.classify_stream(stream, refs, f"{tmp_path}/out", f"{tmp_path}/ck", k=3, adaptive_k=5).awaitTermination()
    assert len(made) == 1 and spark.read.parquet(f"{tmp_path}/out").count() == 20
