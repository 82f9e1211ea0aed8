"""Queries of aggregates, rankings, votes, statistics and questions: the remaining A, W, T, V, M, R and Q rows."""

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.text import enrich, numbers
from tessera.operators import cohort, composition, profiles, rollup
from tessera.operators import keys as K
from tessera.operators import knn as N
from tessera.operators import spatial as X
from tessera.operators import stats as M
from tessera.plans import bindings as B
from tessera.plans import nlq
from tessera.plans.loads import as_csv
from tessera.plans.registry import ORACLE, query
from tessera.plans.search import CUBE, LOO, VOTE, loo, near, shown
from tessera.plans.store import NEAR
from tessera.sources import table, text


@query("a7_tumour_list_rows", "SELECT samples, slides, count(*) AS total_tiles, count(*) FILTER (WHERE malignant) AS malignant_tiles, count(DISTINCT CASE WHEN malignant THEN hpc_id END) AS malignant_hpcs FROM tiles LEFT JOIN dictionary USING (hpc_id) GROUP BY samples, slides")
def _(s, d):
    t = B.tiles(s, d).join(B.dictionary(s), "hpc_id", "left").select("samples", "slides", "hpc_id", F.when(F.col("malignant"), "Malignant ").when(~F.col("malignant"), "benign").otherwise("").alias("said"))
    rows = text.read_text_csv(s, as_csv(t, "tiles-csv"))
    return profiles.tumour_list_from_rows(rows, K.parse_malignancy(F.col("said")))


@query("a19_centroids", "SELECT code, i - 1 AS pos, round(avg(x), 6) AS x FROM (SELECT code, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM refs) GROUP BY ALL")
def _(s, d):
    return N.mean_vector(B.refs(s, d), "vec", "code").select("code", F.posexplode("mean").alias("pos", "x")).withColumn("x", K.rounded(F.col("x")))


@query("a22_purity_thresholds", "SELECT flag, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER () + (100 - 100.0::DOUBLE * count(*) / sum(count(*)) OVER ()) / 2, 6) AS threshold FROM tiles GROUP BY flag")
def _(s, d):
    return profiles.purity_thresholds(B.tiles(s, d), "flag")


@query("a26_institution_presence", """WITH s AS (SELECT substr(samples, 8, 1) AS site, hpc_id FROM tiles), per AS (SELECT site, hpc_id, count(*) AS n, sum(count(*)) OVER (PARTITION BY site) AS o FROM s GROUP BY site, hpc_id), tot AS (SELECT count(*) AS sa, sum(o) AS ta FROM (SELECT site, max(o) AS o FROM per GROUP BY site))
    SELECT hpc_id, round(count(*) FILTER (WHERE n >= 0.005 * o) / any_value(sa)::DOUBLE, 6) AS presence, round(sum(CASE WHEN n >= 0.005 * o THEN o ELSE 0 END) / any_value(ta)::DOUBLE, 6) AS weighted_presence FROM per, tot GROUP BY hpc_id""")
def _(s, d):
    return profiles.presence(B.tiles(s, d).withColumn("site", F.substring("samples", 8, 1)), "hpc_id", "site")


@query("a30_one_hot_counts", "SELECT slides, count(*) FILTER (WHERE flag = 'A') AS \"v_A\", count(*) FILTER (WHERE flag = 'N') AS \"v_N\", count(*) FILTER (WHERE flag = 'R') AS \"v_R\" FROM tiles GROUP BY slides HAVING greatest(\"v_A\", \"v_N\", \"v_R\") >= 0.35 * count(*)")
def _(s, d):
    wide = profiles.crosstab(B.tiles(s, d), "slides", "flag", ["A", "N", "R"])
    return wide.where(F.greatest("v_A", "v_N", "v_R") >= 0.35 * (F.col("v_A") + F.col("v_N") + F.col("v_R")))


@query("a31_enrichment_inputs", "SELECT samples, flag, count(*) AS hits, CAST(sum(count(*)) OVER (PARTITION BY samples) AS BIGINT) AS drawn, CAST(sum(count(*)) OVER (PARTITION BY flag) AS BIGINT) AS good, CAST(sum(count(*)) OVER () AS BIGINT) AS whole FROM tiles GROUP BY samples, flag")
def _(s, d):
    return M.enrichment(B.tiles(s, d), "samples", "flag").drop("p")


@query("w1_share_of_slide", "SELECT slides, flag, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY slides)::DOUBLE, 6) AS proportion FROM tiles GROUP BY slides, flag")
def _(s, d):
    return profiles.proportion(B.tiles(s, d), group=("slides",), label="flag").withColumn("proportion", F.round("proportion", 6))


@query("w4_first_tile", "SELECT slides, min(slide_tile) AS slide_tile FROM tiles GROUP BY slides")
def _(s, d):
    return profiles.first_of(B.tiles(s, d).select("slides", "slide_tile"), ["slides"], "slide_tile")


@query("w5_repeated_rows", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1")
def _(s, d):
    return profiles.repeated_rows(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_orderkey", "l_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey")


@query("w9_newest_run", "SELECT dataset, first(submission_id ORDER BY submitted_at DESC, submission_id DESC) AS submission_id, first(state ORDER BY submitted_at DESC, submission_id DESC) AS state FROM runs WHERE state <> 'pending' GROUP BY dataset")
def _(s, d):
    return rollup.newest(B.runs(s, d), "pending")


@query("w10_neighbour_rank", f"WITH {LOO} SELECT row_id, ref_id, rank FROM loo WHERE rank <= 3")
def _(s, d):
    return loo(s, d, 3).select("row_id", "ref_id", F.col("rank").cast("long").alias("rank"))


@query("w11_risk_normalisers", "SELECT samples, max(abs(round(risk + 1e-9, 6))) AS top FROM (SELECT samples, slides, sum(proportion * coef) AS risk FROM proportion JOIN survival USING (hpc_id) WHERE p < 0.05 GROUP BY ALL) GROUP BY samples")
def _(s, d):
    return profiles.risk(profiles.proportion(B.tiles(s, d)), B.survival(s)).groupBy("samples").agg(F.max(F.abs("risk")).alias("top"))


@query("t6_worst_slides", f"SELECT slides, beyond, ratio FROM ({ORACLE['v24_shift_compare']}) q ORDER BY beyond DESC, ratio DESC, slides LIMIT 10")
def _(s, d):
    t = B.tiles(s, d)
    return N.shift_compare(t, t.where("hpc_id % 2 = 0"), "slides").orderBy(F.desc("beyond"), F.desc("ratio"), "slides").select("slides", "beyond", "ratio").limit(10)


@query("t7_weakest_clusters", f"SELECT code, purity FROM ({ORACLE['v21_cluster_diagnostics']}) q ORDER BY purity, code LIMIT 5")
def _(s, d):
    return N.diagnostics(loo(s, d)).orderBy("purity", "code").select("code", "purity").limit(5)


@query("v23_verdicts", f"SELECT verdict, count(*) AS n FROM ({ORACLE['v21_cluster_diagnostics']}) q GROUP BY verdict")
def _(s, d):
    return profiles.counts_by(N.diagnostics(loo(s, d)), "verdict")


@query("t8_best_settings", f"SELECT k, power, accuracy FROM ({ORACLE['v17_sweep']}) q ORDER BY accuracy DESC, k, power LIMIT 3")
def _(s, d):
    return N.sweep(near(s, d), (5, 10, 25), (0.0, 3.0)).orderBy(F.desc("accuracy"), "k", "power").select("k", "power", "accuracy").limit(3)


@query("t10_slides_in_order", "SELECT DISTINCT slides, samples FROM tiles ORDER BY slides")
def _(s, d):
    return B.tiles(s, d).select("slides", "samples").distinct().orderBy("slides")


@query("t11_latest_run", "SELECT submission_id, dataset FROM runs ORDER BY submitted_at DESC, submission_id DESC LIMIT 1")
def _(s, d):
    return B.runs(s, d).orderBy(F.desc("submitted_at"), F.desc("submission_id")).select("submission_id", "dataset").limit(1)


@query("t13_overlay_cap", "SELECT slide_tile FROM tiles WHERE hpc_id = 40 ORDER BY slide_tile LIMIT 50")
def _(s, d):
    return cohort.first_tiles(B.tiles(s, d).where("hpc_id = 40").select("slide_tile"), 50, "slide_tile")


#: A fixed matrix of components, by a rule that SQL can say too.
WIDTH, KEPT = 64, 8
COMPONENTS = np.array([[((i * 7 + j * 3) % 11 - 5) / 10.0 for j in range(KEPT)] for i in range(WIDTH)])
MEANS = "{name}_m AS (SELECT list(x ORDER BY i) AS mean FROM (SELECT i, avg(x) AS x FROM (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM {name}) GROUP BY i))"
PROJECTED = MEANS + f", {{name}}_z AS (SELECT {{name}}.* EXCLUDE (vec), list_transform(range({KEPT}), lambda j: list_sum(list_transform(range({WIDTH}), lambda i: (vec[i + 1] - mean[i + 1]) * (((i * 7 + j * 3) % 11 - 5) / 10.0::DOUBLE)))) AS z FROM {{name}}, {{name}}_m)"


def projected(df):
    """Centred on the mean of its own rows, as the presets ask, then projected."""
    mean = np.array(N.mean_vector(df).first().mean)
    return N.project(df, COMPONENTS, mean)


@query("v1_projection", f"WITH {PROJECTED.format(name='asks')} SELECT row_id, list_transform(z, lambda v: round(v, 6)) AS vec FROM asks_z")
def _(s, d):
    return projected(B.asks(s, d)).select("row_id", F.transform("vec", lambda x: K.rounded(x)).alias("vec"))


@query("v2_query_mean", "SELECT i - 1 AS pos, round(avg(x), 6) AS x FROM (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM asks) GROUP BY i")
def _(s, d):
    a = B.asks(s, d)
    shards = a.where("row_id % 3 = 0").unionAll(a.where("row_id % 3 <> 0"))  # all shards share one mean
    return N.mean_vector(shards).select(F.posexplode("mean").alias("pos", "x")).withColumn("x", K.rounded(F.col("x")))


NEAR_Z = f"{PROJECTED.format(name='asks')}, {PROJECTED.format(name='refs')}, near_z AS (SELECT row_id, truth, ref_id, code, list_sum(list_transform(list_zip(a.z, r.z), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS d2, row_number() OVER (PARTITION BY row_id ORDER BY d2, ref_id) AS rank FROM asks_z a, refs_z r QUALIFY rank <= 25)"
TUNED = f"WITH {NEAR_Z}, {VOTE.format(name='a', k=10, w=CUBE)}, {VOTE.format(name='b', k=25, w=CUBE)}".replace("FROM near ", "FROM near_z ")


@query("v12_tuned_end_to_end", f"{TUNED} SELECT a_v.row_id, a_v.truth, a_v.margin < 0.15 AS revoted, CASE WHEN a_v.margin < 0.15 THEN b_v.label ELSE a_v.label END AS label, round(CASE WHEN a_v.margin < 0.15 THEN b_v.margin ELSE a_v.margin END, 6) AS margin FROM a_v JOIN b_v USING (row_id)")
def _(s, d):
    vote = N.resolve_vote("tuned")
    found = N.neighbours(projected(B.asks(s, d)), projected(B.refs(s, d)), vote["adaptive_k"])
    return N.classify(found, **vote).select("row_id", "truth", "revoted", "label", F.round("margin", 6).alias("margin"))


@query("v13_legacy_overridden", f"WITH {VOTE.format(name='a', k=15, w='1.0::DOUBLE')} SELECT row_id, truth, label, runner_up, round(margin, 6) AS margin, round(neighbor_distance, 6) AS neighbor_distance, false AS revoted FROM a_v")
def _(s, d):
    return shown(N.classify(near(s, d), **N.resolve_vote("legacy", k=15)))


@query("v9_margins", f"WITH {VOTE.format(name='a', k=10, w='(1 / (sqrt(d2) + 1e-6)) ** 2.0')} SELECT row_id, round(margin, 6) AS margin FROM a_v")
def _(s, d):
    return N.vote(near(s, d, 10), 10, 2.0).select("row_id", F.round("margin", 6).alias("margin"))


@query("v10_neighbor_distance", "SELECT row_id, round(avg(sqrt(d2)), 6) AS neighbor_distance FROM near WHERE rank <= 10 GROUP BY row_id")
def _(s, d):
    scaled = N.vote(near(s, d, 10), 10, 2.0, scales=N.local_scales(B.refs(s, d), 3))  # scales and weights leave it as it is
    return scaled.select("row_id", F.round("neighbor_distance", 6).alias("neighbor_distance"))


@query("j25_knn_join", "SELECT row_id, ref_id, code FROM near WHERE rank = 1")
def _(s, d):
    return near(s, d, 1).select("row_id", "ref_id", "code")


@query("v22_medoids", "WITH c AS (SELECT a.code, a.ref_id, sum(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS cost FROM refs a JOIN refs b ON a.code = b.code GROUP BY ALL) SELECT code, first(ref_id ORDER BY round(cost, 9), ref_id) AS medoid FROM c GROUP BY code")
def _(s, d):
    return N.medoids(B.refs(s, d))


@query("v25_agreement", "WITH j AS (SELECT c_custkey % 7 AS a, (c_custkey + CASE WHEN c_custkey % 300 = 0 THEN 1 ELSE 0 END) % 7 AS b FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0) SELECT count(*) AS n, round(avg(CASE WHEN a = b THEN 1 ELSE 0 END), 6) AS agreement, avg(CASE WHEN a = b THEN 1 ELSE 0 END) >= 0.99 AS passes FROM j")
def _(s, d):
    k = F.col("c_custkey")
    c = table(s, d, "customer")
    truth = c.select(k, F.when(k % 13 != 0, (k + (k % 300 == 0).cast("int")) % 7).alias("label"))
    doubted = c.where((k % 17 == 0) & (k % 13 != 0)).select(k, F.lit(9).cast("long").alias("label"))  # a second label makes truth ambiguous
    return N.agreement(c.select(k, (k % 7).alias("label")), truth.unionAll(doubted), ["c_custkey"], "label")


@query("j8_validated_votes", f"WITH {VOTE.format(name='a', k=10, w=CUBE)} SELECT count(*) AS n, round(avg(CASE WHEN label = truth THEN 1 ELSE 0 END), 6) AS agreement, avg(CASE WHEN label = truth THEN 1 ELSE 0 END) >= 0.5 AS passes FROM a_v")
def _(s, d):
    a = B.asks(s, d)
    return N.agreement(N.vote(near(s, d, 10), 10, 3.0).select("row_id", "label"), a.select("row_id", F.col("truth").alias("label")), ["row_id"], "label", 0.5)


def quality(config, code):
    return f"""SELECT * FROM (WITH r AS (SELECT ref_id, {code} AS k, vec FROM refs), l AS (SELECT k, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM r), c AS (SELECT k, list(x ORDER BY i) AS m FROM (SELECT k, i, avg(x) AS x FROM l GROUP BY ALL) GROUP BY k), g AS (SELECT list(x ORDER BY i) AS g FROM (SELECT i, avg(x) AS x FROM l GROUP BY i)),
    dd AS (SELECT ref_id, r.k, c.k AS ck, sqrt(list_sum(list_transform(list_zip(r.vec, c.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM r, c), p AS (SELECT ref_id, k, min(d) FILTER (WHERE ck = k) AS a, min(d) FILTER (WHERE ck <> k) AS b FROM dd GROUP BY ALL),
    s AS (SELECT k, count(*) AS n, avg(a) AS s, sum(a * a) AS w FROM p GROUP BY k), t AS (SELECT count(*) AS k, sum(n) AS n, sum(w) AS w, sum(n * s) / sum(n) AS disruption FROM s), bt AS (SELECT sum(n * list_sum(list_transform(list_zip(m, g), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS b FROM s JOIN c USING (k), g),
    db AS (SELECT avg(worst) AS dbi FROM (SELECT x.k, max((x.s + y.s) / sqrt(list_sum(list_transform(list_zip(cx.m, cy.m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))) AS worst FROM s x JOIN c cx ON x.k = cx.k JOIN s y ON x.k <> y.k JOIN c cy ON y.k = cy.k GROUP BY x.k))
    SELECT '{config}' AS config, CAST(t.n AS BIGINT) AS n, t.k AS clusters, (SELECT round(avg((b - a) / nullif(greatest(a, b), 0)), 6) FROM p) AS silhouette, round(disruption, 6) AS disruption, round((b / (t.k - 1)) / (t.w / (t.n - t.k)), 6) AS vrc, round(dbi, 6) AS dbi FROM t, bt, db)"""


@query("v26_cluster_quality", quality("code", "code"))
def _(s, d):
    return N.cluster_quality(B.refs(s, d), "code")


@query("r9_configurations", " UNION ALL ".join(quality(f"modulo {m}", f"code % {m}") for m in (2, 3, 5)))
def _(s, d):
    return N.configurations(B.refs(s, d), {f"modulo {m}": F.col("code") % m for m in (2, 3, 5)})


@query("v15_holdout_votes", """WITH p AS (SELECT a.vec_id AS row_id, CAST(a.label AS INTEGER) AS truth, CAST(b.label AS INTEGER) AS code, b.vec_id AS ref_id, list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM embeddings a JOIN embeddings b ON a.vec_id % 10 = 3 AND b.vec_id % 10 <> 3),
    n AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d2, ref_id) <= 5), v AS (SELECT row_id, truth, code, count(*) AS w FROM n GROUP BY ALL), b AS (SELECT row_id, truth, first(code ORDER BY w DESC, code DESC) AS label FROM v GROUP BY ALL)
    SELECT count(*) AS n, round(avg(CASE WHEN label = truth THEN 1 ELSE 0 END), 6) AS accuracy FROM b""")
def _(s, d):
    e = table(s, d, "embeddings").select("vec_id", (F.col("vec_id") % 10).alias("slides"), F.col("label").cast("int").alias("code"), F.col("embedding").cast("array<double>").alias("vec"))
    held, reduced = e.where("slides = 3"), e.where("slides <> 3")
    cohort.check_holdout(held, reduced)
    asks = held.select(F.col("vec_id").alias("row_id"), F.col("code").alias("truth"), "vec")
    return N.accuracy(N.vote(N.neighbours(asks, reduced.select(F.col("vec_id").alias("ref_id"), "code", "vec"), 5), 5))


FLIPS = (0.0, 0.01, 0.1)


@query("r32_compared_tiebreaks", f"""WITH {VOTE.format(name='a', k=10, w=CUBE)}, n AS (SELECT near.row_id, near.truth, a_v.label, a_v.runner_up, code, d2, ref_id FROM near JOIN a_v USING (row_id) WHERE rank <= 10 AND a_v.margin < 0.2 AND code IN (a_v.label, a_v.runner_up)),
    g AS (SELECT row_id, truth, label, runner_up, first(code ORDER BY d2, ref_id) AS nearest, avg(sqrt(d2)) FILTER (WHERE code = label) AS a, avg(sqrt(d2)) FILTER (WHERE code <> label) AS b FROM n GROUP BY ALL), f AS (SELECT unnest([0.0, 0.01, 0.1]::DOUBLE[]) AS flip)
    SELECT flip, count(*) AS n, count(*) FILTER (WHERE label = truth) AS vote, count(*) FILTER (WHERE nearest = truth) AS nearest, count(*) FILTER (WHERE CASE WHEN (a - b) / (abs(a) + abs(b) + 1e-6) > flip THEN runner_up ELSE label END = truth) AS mean_distance FROM g, f GROUP BY flip""")
def _(s, d):
    n = near(s, d, 10)
    return N.compared_tiebreaks(n, N.vote(n, 10, 3.0).where("margin < 0.2"), 10, FLIPS)


COUNTS = "f AS (SELECT slides, hpc_id, count(*) AS n FROM tiles GROUP BY ALL), w AS (SELECT s.slides, CAST(h.i AS INTEGER) AS pos, coalesce(f.n, 0)::DOUBLE AS n FROM (SELECT DISTINCT slides FROM tiles) s CROSS JOIN range(71) h(i) LEFT JOIN f ON f.slides = s.slides AND f.hpc_id = h.i)"


def dense(s, d):
    return composition.dense_counts(B.tiles(s, d), "slides", "hpc_id", list(range(B.CLUSTERS)))


@query("m3_clr_pseudocount", f"WITH {COUNTS} SELECT slides, pos, round(ln(n + 1) - avg(ln(n + 1)) OVER (PARTITION BY slides), 6) AS x FROM w")
def _(s, d):
    vec = composition.clr(composition.closure(F.transform("counts", lambda v: v + 1)), B.CLUSTERS)
    return dense(s, d).select("slides", F.posexplode(vec).alias("pos", "x")).withColumn("x", F.round("x", 6))


@query("r3_cluster_ratios", f"WITH {COUNTS} SELECT slides, pos, round(100 * n / sum(n) OVER (PARTITION BY slides), 6) AS percent FROM w")
def _(s, d):
    return dense(s, d).select("slides", F.posexplode(composition.closure(F.col("counts"))).alias("pos", "x")).select("slides", "pos", F.round(100 * F.col("x"), 6).alias("percent"))


@query("r6_train_selection", f"WITH {COUNTS}, v AS (SELECT pos, var_pop(n) AS v FROM w WHERE CAST(slides AS INTEGER) % 5 < 3 GROUP BY pos), c AS (SELECT quantile_cont(v, 0.5) AS cut FROM v) SELECT w.pos, round(avg(n), 6) AS test_mean FROM w JOIN v USING (pos), c WHERE v.v > c.cut AND CAST(slides AS INTEGER) % 5 >= 3 GROUP BY w.pos")
def _(s, d):
    fold = F.col("slides").cast("int") % 5
    rows = dense(s, d)
    chosen = composition.variance_selection(rows.where(fold < 3), "counts", 0.5).select("pos")  # fitted on train rows alone
    return rows.where(fold >= 3).select(F.posexplode("counts").alias("pos", "x")).join(chosen, "pos").groupBy("pos").agg(F.round(F.avg("x"), 6).alias("test_mean"))


RANKED = "(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE)"
SPEARMAN = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]


@query("m12_spearman_pairs", " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr(ra, rb), 4) AS r FROM (SELECT {RANKED.format(c=a)} AS ra, {RANKED.format(c=b)} AS rb FROM lineitem)" for a, b in SPEARMAN))
def _(s, d):
    return M.correlation(table(s, d, "lineitem"), SPEARMAN, "spearman").select("x", "y", F.round("r", 4).alias("r"))


@query("m15_density_correlation", f"""WITH {NEAR}, n AS (SELECT core, a, count(*) FILTER (WHERE pb = 'click') AS na, count(*) FILTER (WHERE pb = 'view') AS nb FROM np WHERE d < 25 GROUP BY ALL), c AS (SELECT cells.core, coalesce(na, 0) + CASE WHEN phenotype = 'click' THEN 1 ELSE 0 END AS na, coalesce(nb, 0) + CASE WHEN phenotype = 'view' THEN 1 ELSE 0 END AS nb FROM cells LEFT JOIN n ON cells.core = n.core AND cell = a),
    r AS (SELECT core, rank() OVER (PARTITION BY core ORDER BY na) + (count(*) OVER (PARTITION BY core, na) - 1) / 2.0::DOUBLE AS ra, rank() OVER (PARTITION BY core ORDER BY nb) + (count(*) OVER (PARTITION BY core, nb) - 1) / 2.0::DOUBLE AS rb FROM c)
    SELECT core, count(*) AS n, CASE WHEN min(ra) < max(ra) AND min(rb) < max(rb) THEN round(corr(ra, rb), 6) END AS rho FROM r GROUP BY core""")
def _(s, d):
    return X.density_correlation(B.cells(s, d), "click", "view", 25.0)


@query("r8_masked_correlations", " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, n, r, CASE WHEN abs(r) * sqrt((n - 2) / (1 - r * r)) >= 1.959964 THEN r END AS masked FROM (SELECT count(*) AS n, round(corr({a}, {b}), 6) AS r FROM tiles)" for a, b in (("hpc_id", "vote_margin"), ("grid_row", "hpc_id"))))
def _(s, d):
    return M.masked_correlation(B.tiles(s, d), [("hpc_id", "vote_margin"), ("grid_row", "hpc_id")])


@query("r10_best_penalty")
def _(s, d):
    k = F.col("c_custkey")
    c = table(s, d, "customer").select((k % 2).alias("fold"), ((k * 37) % 120 + 1).alias("time"), (k % 3 != 0).cast("int").alias("event"), (F.col("c_acctbal") / 10_000).alias("balance"), ((k * 37) % 120 / 120.0 + (k % 7) / 7.0).alias("marker"))
    return M.best_ridge(M.cross_validated(c, "time", "event", ["balance", "marker"], "fold", (0.1, 100.0)))


@query("r11_combined_risk", "WITH c AS (SELECT " + ", ".join(f"quantile_cont(c_acctbal, 0.5) FILTER (WHERE c_custkey % 5 <> {i}) AS c{i}" for i in range(5)) + " FROM customer), h AS (SELECT c_custkey, " + " + ".join(f"CASE WHEN c_acctbal > c{i} THEN 1 ELSE 0 END" for i in range(5)) + " AS n_high FROM customer, c) SELECT c_custkey, n_high, CASE WHEN n_high > 2 THEN 'high' ELSE 'low' END AS risk_group FROM h")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_acctbal", (F.col("c_custkey") % 5).alias("fold"))
    return M.combined_risk(c, "c_acctbal", "fold", 5).select("c_custkey", "n_high", "risk_group")


@query("r12_coefficient_summary", "WITH f AS (SELECT hpc_id, CAST(slides AS INTEGER) % 5 AS fold, avg(vote_margin) AS coef FROM tiles GROUP BY ALL) SELECT hpc_id, count(*) AS n, round(avg(coef), 6) AS mean, CASE count(*) WHEN 5 THEN round(2.776445 * stddev_samp(coef) / sqrt(5), 6) WHEN 4 THEN round(3.182446 * stddev_samp(coef) / 2, 6) WHEN 3 THEN round(4.302653 * stddev_samp(coef) / sqrt(3), 6) WHEN 2 THEN round(12.706205 * stddev_samp(coef) / sqrt(2), 6) END AS half_width FROM f GROUP BY hpc_id")
def _(s, d):
    folds = B.tiles(s, d).groupBy("hpc_id", (F.col("slides").cast("int") % 5).alias("fold")).agg(F.avg("vote_margin").alias("coef"))
    return M.mean_ci(folds, "coef", "hpc_id")


@query("r13_class_balance", "WITH f AS (SELECT c_custkey % 5 AS fold, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS p FROM customer GROUP BY 1) SELECT fold, round((sum(p) OVER () - p) / (sum(n) OVER () - n)::DOUBLE, 2) AS train, round(p / n::DOUBLE, 2) AS test FROM f")
def _(s, d):
    return M.class_balance(table(s, d, "customer").select((F.col("c_custkey") % 5).alias("fold"), (F.col("c_acctbal") > 0).alias("y")), "y", "fold")


@query("r13_logit")
def _(s, d):
    e = table(s, d, "embeddings")
    rows = e.select((F.col("vec_id") % 3).alias("fold"), (F.col("label") % 2).alias("y"), *(F.get("embedding", F.lit(i)).alias(f"x{i}") for i in range(8)))
    return M.logit(rows, "y", [f"x{i}" for i in range(8)], "fold")


@query("r17_sampled_cores", "SELECT core, cell FROM cells WHERE core IN (SELECT core FROM (SELECT DISTINCT core FROM cells) ORDER BY md5('3:' || core), core LIMIT 8)")
def _(s, d):
    return cohort.sample_of(B.cells(s, d).select("core", "cell"), "core", 8, 3)


@query("r33_stage_states", "SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'running' WHEN bool_or(event_type = 'signup') THEN 'pending' WHEN bool_or(event_type = 'purchase') THEN 'failed' ELSE 'complete' END AS state FROM events GROUP BY user_id")
def _(s, d):
    kind = F.col("event_type")
    state = F.when(kind == "error", "running").when(kind == "signup", "pending").when(kind == "purchase", "failed").otherwise("complete")
    return table(s, d, "events").select("user_id", state.alias("state")).groupBy("user_id").agg(rollup.coarse_state().alias("state"))


def said(s, rows, fields):
    return s.createDataFrame(rows, fields)


@query("p35_number_words", "SELECT * FROM (VALUES ('slides thirty two and forty', 'slides 32 and 40'), ('seven or twenty-one', '7 or 21')) v(q, found)")
def _(s, d):
    return said(s, [(q, numbers(q)) for q in ("slides thirty two and forty", "seven or twenty-one")], "q string, found string")


@query("q1_enriched", "SELECT * FROM (VALUES ('show  WSI thirty-two', 'show slide 32'), ('tumour patches', 'malignant tiles')) v(q, found)")
def _(s, d):
    return said(s, [(q, enrich(q)) for q in ("show  WSI thirty-two", "tumour patches")], "q string, found string")


@query("q2_slide_names", "SELECT * FROM (VALUES ('open TCGA-AB-0012 now', ['TCGA-AB-0012']), ('open TCGA-AB-0O12', ['TCGA-AB-0012']), ('open nothing', []::VARCHAR[])) v(q, found)")
def _(s, d):
    names = {"TCGA-AB-0012", "TCGA-CD-7777"}
    return said(s, [(q, nlq.slide_ids(q, names)) for q in ("open TCGA-AB-0012 now", "open TCGA-AB-0O12", "open nothing")], "q string, found array<string>")


@query("q5_merged_plan", "SELECT 'hpc' AS intent, ['32', '40'] AS hpcs, ['TCGA-AB-0012'] AS slides, true AS malignant")
def _(s, d):
    merged = nlq.merge(nlq.plan("clusters 32 and 99 of slide TCGA-AB-0O12"), nlq.Plan("hpc", {"hpc": ["40"]}, {"malignant": True}, [], {}, 0.95, "other"))
    p = nlq.validated(merged, {"TCGA-AB-0012", "TCGA-CD-7777"}, set(range(B.CLUSTERS)))
    return said(s, [(p.intent, p.entities["hpc"], p.entities["slide"], p.flags["malignant"])], "intent string, hpcs array<string>, slides array<string>, malignant boolean")


@query("q6_needs_data", "SELECT * FROM (VALUES ('Hello!', false), ('how many tiles', true), ('risk of cluster 41', true), ('what a day', false)) v(q, needed)")
def _(s, d):
    return said(s, [(q, nlq.needs_data(nlq.plan(q))) for q in ("Hello!", "how many tiles", "risk of cluster 41", "what a day")], "q string, needed boolean")


@query("q7_entities", "SELECT * FROM (VALUES ('hpc', ['5', '12']), ('slide', ['77']), ('tile', ['a_1_2.jpeg']), ('sample', ['LUAD-3'])) v(kind, found)")
def _(s, d):
    e = nlq.entities("hpcs 5 and 12 on slide 77, tile a_1_2.jpeg of sample LUAD-3, hpc 5 again")
    return said(s, list(e.items()), "kind string, found array<string>")


@query("q9_tile_answer", "SELECT min(tiles) AS q, min(tiles) AS found FROM tiles")
def _(s, d):
    t = B.tiles(s, d)
    return nlq.execute(nlq.plan(f"show me tile {t.agg(F.min('tiles')).first()[0]}"), t, B.dictionary(s), B.survival(s))


@query("q11_sample_answer", "SELECT samples, hpc_id, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS proportion FROM tiles WHERE samples = 'NATION_7' GROUP BY ALL ORDER BY n DESC, hpc_id LIMIT 5")
def _(s, d):
    answer = nlq.execute(nlq.plan("what are the top clusters of sample nation_7?"), B.tiles(s, d), B.dictionary(s), B.survival(s))
    return answer.withColumn("proportion", F.round("proportion", 6))


@query("r37_plan_from_text", "SELECT 'survival' AS intent, 0.5::DOUBLE AS confidence, 'unknown' AS without")
def _(s, d):
    p = nlq.Plan.from_json('Here it is: {"intent": "survival", "confidence": 0.5} - done')
    return said(s, [(p.intent, p.confidence, nlq.Plan.from_json("no plan").intent)], "intent string, confidence double, without string")


@query("r38_view_state", "SELECT '9' AS slide, '5' AS heat, ['5'] AS highlight, 3 AS a, 5 AS b")
def _(s, d):
    pairs = said(s, [(3, 5, 7), (4, 5, 2), (5, 5, 90)], "a int, b int, edges long")
    v = nlq.view_state(nlq.plan("highlight what is adjacent to HPC 5 on slide 9"), pairs)
    return said(s, [(v["slide"], v["heat"], v["highlight"], *v["pair"])], "slide string, heat string, highlight array<string>, a int, b int")
