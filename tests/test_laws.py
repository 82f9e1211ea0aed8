"""Laws that operators must keep, and guards that must be able to fail."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.text import enrich, indel_ratio, partial_ratio
from tessera.operators import grading, guards, knn, profiles, rollup, spatial
from tessera.operators import keys as K
from tessera.operators import stats as M
from tessera.plans import nlq
from tessera.sources import sinks, text


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 3, (6, 8))
    refs = [(int(i), int(i % 6), (centres[i % 6] + rng.normal(0, 1, 8)).tolist()) for i in range(600)]
    asks = [(int(i), int(i % 6), (centres[i % 6] + rng.normal(0, 1, 8)).tolist()) for i in range(90)]
    return spark.createDataFrame(asks, "row_id long, truth int, vec array<double>"), spark.createDataFrame(refs, "ref_id long, code int, vec array<double>"), asks, refs


def test_blocks_never_change_neighbours(vectors):
    asks, refs, a, r = vectors
    one, many = (sorted(map(tuple, knn.neighbours(asks.repartition(n), refs, 7, blocks=b).select("row_id", "ref_id", "rank").collect())) for n, b in ((1, 1), (5, 4)))
    m = np.array([x[2] for x in r])
    want = sorted((i, int(j), k) for i, _, v in a for k, j in enumerate(np.argsort(((m - np.array(v)) ** 2).sum(1), kind="stable")[:7], 1))
    assert one == many == want


def test_votes_of_separated_clusters(vectors):
    asks, refs, *_ = vectors
    v = knn.classify(knn.neighbours(asks, refs, 25), **knn.resolve_vote("tuned")).collect()
    assert sum(r.label == r.truth for r in v) > 80 and all(0 <= r.margin <= 1 for r in v)
    assert knn.neighbours(asks, refs.limit(0), 5).count() == 0


def test_vote_ties_go_to_the_highest_code(spark):
    near = spark.createDataFrame([(1, 0, 10, 3, 1.0, 1), (1, 0, 11, 5, 1.0, 2)], "row_id long, truth int, ref_id long, code int, d2 double, rank int")
    assert knn.vote(near, 2).first().label == 5


def test_vote_settings_refuse():
    assert knn.resolve_vote("legacy", k=5)["k"] == 5
    for bad in ({"preset": "none"}, {"preset": "tuned", "k": 30}, {"preset": "legacy", "adaptive_k": 300}, {"preset": "tuned", "colour": 1}):
        with pytest.raises(guards.Refused):
            knn.resolve_vote(**bad)


def test_projection_centres_on_a_given_mean(vectors, spark):
    asks, _, a, _ = vectors
    w, mean = np.random.default_rng(1).normal(size=(8, 3)), np.arange(8.0)
    got = {r.row_id: r.vec for r in knn.project(asks, w, mean).collect()}
    for i, _, v in a:
        assert np.allclose(got[i], (np.array(v) - mean) @ w)
    with pytest.raises(Exception, match="components"):
        knn.project(asks, np.zeros((5, 2)), None).collect()


def test_medoids(vectors):
    _, refs, _, r = vectors
    for row in knn.medoids(refs).collect():
        m = np.array([v for _, c, v in r if c == row.code])
        ids = [i for i, c, _ in r if c == row.code]
        assert row.medoid == ids[int(((m[:, None] - m[None]) ** 2).sum((1, 2)).argmin())]


def test_shift_escalates(spark):
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame([(float(abs(x)),) for x in rng.normal(0.5, 0.12, 3000)], "neighbor_distance double")
    seen = []
    for move in (0.0, 0.12, 0.5):
        c = spark.createDataFrame([("s", float(abs(x) + move)) for x in rng.normal(0.5, 0.12, 1000)], "slides string, neighbor_distance double")
        seen.append(knn.shift_compare(c, ref, "slides").first().verdict)
    assert seen[0] == "consistent" and seen[2] == "alarm"


def test_pooling_is_not_averaging(spark):
    px = {p: 0 for p in K.PATTERNS}
    rows = [("a", "t", *(px | {"solid": 1000}).values(), 1000), ("b", "t", *(px | {"acinar": 99000}).values(), 99000)]
    df = spark.createDataFrame(rows, "slide_id string, sample string, " + ", ".join(f"{p}_px long" for p in K.PATTERNS) + ", pattern_pixels long")
    r = grading.tumour_grade(df).first()
    assert (r.predominant, r.grade) == ("acinar", 2)
    assert all(x.adds_up for x in grading.slide_proportions(df).collect())


def test_tile_pitch(spark):
    df = spark.createDataFrame([("0.2325",), ("0.2520",), ("0.5015",), ("x",), ("-1",)], "mpp string")
    assert [r[0] for r in df.select(K.native_tile_px(F.col("mpp"))).collect()] == [1734, 1600, 804, 1600, 1600]


def test_guards_can_fail(spark):
    t = spark.createDataFrame([("a", "1"), ("a", "1"), ("", "2")], "slides string, tiles string")
    for bad in (guards.duplicate_keys(t, "slides", "tiles"), guards.blank_keys(t, "slides")):
        with pytest.raises(guards.Refused):
            guards.require_empty(bad, "bad")
    good = t.where("slides = 'b'")
    guards.require_empty(guards.duplicate_keys(good, "slides"), "bad")
    with pytest.raises(guards.Refused):
        guards.one_to_one(t, t.distinct(), ["slides", "tiles"])
    report = spark.createDataFrame([(100, 94, 0)], "n_rows long, matched long, unknown_clusters long")
    with pytest.raises(guards.Refused, match="match"):
        guards.require_match(report)
    guards.require_match(report.withColumn("matched", F.lit(95)))
    with pytest.raises(guards.Refused, match="unknown"):
        guards.require_match(report.withColumn("matched", F.lit(95)).withColumn("unknown_clusters", F.lit(1)))
    with pytest.raises(Exception, match="malignancy"):
        spark.createDataFrame([("perhaps",)], "w string").select(K.parse_malignancy(F.col("w"), strict=True)).collect()


def test_loads(spark, tmp_path):
    old = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 2)], "k string, dataset string, v int")
    new = spark.createDataFrame([("b", "d1", 9)], "k string, dataset string, v int")
    with pytest.raises(guards.Refused):
        sinks.register(old, new, "k", "dataset", "d1")
    fresh = new.withColumn("k", F.lit("c"))
    assert sinks.register(old, fresh, "k", "dataset", "d1", replace=True).count() == 2
    with pytest.raises(guards.Refused):
        sinks.replace_group(old, new, ["k"], owner="dataset")
    path = f"{tmp_path}/t"
    assert sinks.commit(old, path) == 2 and sinks.commit(sinks.replace_group(spark.read.parquet(path), fresh, ["k"]), path, 3) == 3
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(guards.Refused):
        sinks.commit(old, path, 5)
    assert spark.read.parquet(path).count() == 3
    done = spark.createDataFrame([(0, 5, "x")], "lo int, hi int, identity string")
    with pytest.raises(guards.Refused):
        sinks.pending_ranges(done.select("lo", "hi"), done, "y")


def test_text_stays_text(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("samples,slides,tiles,vote_margin,neighbor_distance,leiden\n007,NA,null,,0.5,3\ns,,t,0.1,0.1,1\ns,x,t,abc,1,1\ns,x,u,0.2,1,1.5\n")
    raw = text.read_text_csv(spark, str(p))
    assert raw.first().samples == "007" and raw.first().slides == "NA" and raw.first().tiles == "null" and raw.first().vote_margin == ""
    assert [r.problem for r in text.parse_assignments(raw).collect()] == [None, "blank key", "bad number", "bad cluster"]
    with pytest.raises(guards.Refused):
        text.cluster_column(["samples", "a", "b"])


def test_columns_and_shards(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-b` int, c int")
    assert K.clean_columns(df).columns == ["a_b", "a_b__dup1", "c"]
    shards = spark.createDataFrame([("d", lo, hi) for lo, hi in rollup.shard_plan(10, 4)], "dataset string, lo int, hi int")
    assert rollup.shard_breaks(shards).count() == 0
    assert [r.kind for r in rollup.shard_breaks(shards.where("lo <> 4")).collect()] == ["gap"]


def test_grid_order_does_not_matter(spark):
    rows = [("s", i % 5, i // 5, i % 3, f"t{i:02}") for i in range(25)]
    df = spark.createDataFrame(rows, "slides string, grid_col int, grid_row int, hpc_id int, slide_tile string")
    a, b = (sorted(map(tuple, spatial.edge_counts(spatial.grid_pairs(x)).collect())) for x in (df, df.orderBy(F.desc("slide_tile")).repartition(3)))
    assert a == b and sum(x[3] for x in a) == 2 * 5 * 4 + 2 * 4 * 4


def test_profile_of_awkward_rows(spark):
    t = spark.createDataFrame([("a", "s", 2), ("a", "s", 1), ("a", "s", None)], "samples string, slides string, hpc_id int")
    assert profiles.summary(t.where("hpc_id is not null")).first().dominant_hpc == 1
    assert profiles.proportion(t.withColumn("vote_margin", F.lit(0.5)), 0.9).count() == 0


def test_cox_recovers_a_sign(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    t = rng.exponential(np.exp(-x))
    df = spark.createDataFrame([(float(a), 1, float(b)) for a, b in zip(t, x, strict=True)], "time double, event int, x double")
    assert 0.7 < M.cox(df, "time", "event", ["x"]).first().coef < 1.3


def test_questions():
    assert nlq.plan("Which slides have HPC 40?").intent == "hpc"
    assert nlq.plan("hello there").intent == "greeting" and nlq.plan("hello, slide AB-12x").intent == "slide"
    assert nlq.entities("tiles of slides")["slide"] == []
    assert enrich("Thirty two WSIs, twenty-one clusters") == "32 slides, 21 hpcs"
    p = nlq.plan("highlight tumour in HPC 5 and 7")
    assert p.flags["malignant"] and p.entities["hpc"] == ["5", "7"] and nlq.Plan.from_json(f"so: {p.to_json()}!") == p
    assert nlq.merge(p, nlq.plan("survival of hpc 9")).entities["hpc"] == ["5", "7", "9"]
    assert nlq.validated(p, set(), {5}).entities["hpc"] == ["5"]
    assert nlq.slide_ids("show tcga-05-4244 now", {"TCGA-05-4244", "TCGA-05-4249"}) == ["TCGA-05-4244"]
    assert nlq.slide_ids("show tcga-05-424 now", {"TCGA-05-4244", "TCGA-99-0000"}) == ["TCGA-05-4244"]
    assert indel_ratio("ab", "ab") == 100 and partial_ratio("cluster 12", "the cluster 12 there") == 100
    assert not nlq.needs_data(nlq.plan("good morning"))


def test_stream_matches_batch(spark, vectors, tmp_path):
    from tessera.streaming.classify import classify_stream

    asks, refs, *_ = vectors
    asks.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(asks.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    classify_stream(stream, refs, f"{tmp_path}/out", f"{tmp_path}/ck", k=5, adaptive_k=9).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("row_id", "label").collect()))
    want = knn.classify(knn.neighbours(asks, refs, 9), **knn.resolve_vote("tuned", k=5, adaptive_k=9))
    assert got == sorted(map(tuple, want.select("row_id", "label").collect()))


def test_scratch_tables_can_be_cleared(spark):
    from tessera.sources import scratch

    df, path = scratch.written(spark.range(5), "cleared")
    assert df.count() == 5 and scratch.clear(spark) >= 1
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        spark.read.parquet(path)


def test_one_search_serves_both_votes(vectors):
    asks, refs, *_ = vectors
    out = knn.classify(knn.neighbours(asks, refs, 25), **knn.resolve_vote("tuned"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2  # one search: its bounds and its scores


def test_exclude_self_and_copies(spark):
    rows = [(i, i % 2, [float(i // 3), 1.0]) for i in range(9)]
    asks, refs = spark.createDataFrame(rows, "row_id long, truth int, vec array<double>"), spark.createDataFrame(rows, "ref_id long, code int, vec array<double>")
    got = {(r.row_id, r["rank"]): (r.ref_id, r.d2) for r in knn.neighbours(asks, refs, 3, exclude_self=True, blocks=2).collect()}
    for i in range(9):
        others = sorted(((float(i // 3) - float(j // 3)) ** 2, j) for j in range(9) if j != i)[:3]
        assert [got[i, k] for k in (1, 2, 3)] == [(j, d) for d, j in others]
    assert knn.neighbours(asks, refs.where("ref_id = 4"), 3, exclude_self=True).where("row_id = 4").count() == 0


def test_cluster_quality_by_brute_force(vectors):
    _, refs, _, r = vectors
    x, c = np.array([v for *_, v in r]), np.array([code for _, code, _ in r])
    m = np.array([x[c == k].mean(0) for k in range(6)])
    within = np.array([((x[c == k] - m[k]) ** 2).sum() for k in range(6)])
    spread = np.array([np.sqrt(((x[c == k] - m[k]) ** 2).sum(1)).mean() for k in range(6)])
    between = sum((c == k).sum() * ((m[k] - x.mean(0)) ** 2).sum() for k in range(6))
    dbi = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(m[i] - m[j]) for j in range(6) if j != i) for i in range(6)])
    got = knn.cluster_quality(refs, "x").first()
    assert abs(got.vrc - between / 5 / (within.sum() / (600 - 6))) < 1e-5 and abs(got.dbi - dbi) < 1e-5 and got.clusters == 6


def test_logit_finds_the_sign(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 3, float(x), float(y), int(x - 0.2 * y + rng.normal(0, 0.3) > 0)) for i, (x, y) in enumerate(rng.normal(size=(240, 2)))]
    got = M.logit(spark.createDataFrame(rows, "fold int, x double, y double, label int"), "label", ["x", "y"], "fold").collect()
    assert len(got) == 6 and min(r.accuracy for r in got) > 0.8 and min(r.auc for r in got) > 0.9


def test_penalties_are_compared_on_rows_left_out(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    rows = [(i % 2, float(rng.exponential() * np.exp(-v)), 1, float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "fold int, time double, event int, x double")
    got = M.cross_validated(df, "time", "event", ["x"], "fold", (0.1,)).orderBy("fold").collect()
    assert [(r.ridge, r.fold) for r in got] == [(0.1, 0), (0.1, 1)] and all(r.c_index < 0.35 or r.c_index > 0.65 for r in got)
    share = [M.c_index(df.where(f"fold = {f}"), "time", "event", "x", "fold").first().c_index for f in (0, 1)]
    assert all(min(abs(r.c_index - s), abs(1 - r.c_index - s)) < 1e-6 for r, s in zip(got, share, strict=True))  # one feature orders as its coefficient does
    table = spark.createDataFrame([(0.1, 0, 0.6), (0.1, 1, 0.8), (2.0, 0, 0.7), (2.0, 1, 0.7)], "ridge double, fold int, c_index double")
    assert M.best_ridge(table).first().ridge == 2.0
