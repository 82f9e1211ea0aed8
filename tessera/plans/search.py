"""Queries of vector search, votes and what is measured on them."""

from pyspark.sql import functions as F

from tessera.operators import keys as K
from tessera.operators import knn as N
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.sources import table
from tessera.sources.scratch import written

VOTE = """{name} AS (SELECT row_id, truth, code, sum({w}) AS w, sum(sqrt(d2)) AS d, count(*) AS n FROM near WHERE rank <= {k} GROUP BY row_id, truth, code),
    {name}_r AS (SELECT row_id, truth, first(code ORDER BY w DESC, code DESC) AS label, max(w) AS top, sum(w) AS total, sum(d) / sum(n) AS neighbor_distance, list(w ORDER BY w DESC, code DESC) AS ws, list(code ORDER BY w DESC, code DESC) AS cs FROM {name} GROUP BY row_id, truth),
    {name}_v AS (SELECT row_id, truth, label, cs[2] AS runner_up, (ws[1] - coalesce(ws[2], 0)) / greatest(total, 1e-12) AS margin, neighbor_distance FROM {name}_r)"""
CUBE = "(1 / (sqrt(d2) + 1e-6)) ** 3.0"


def near(s, d, k=25):
    return N.neighbours(B.asks(s, d), B.refs(s, d), k)


@query("v3_neighbours", "SELECT row_id, ref_id, code, round(d2, 6) AS d2, rank FROM near WHERE rank <= 10")
def _(s, d):
    return near(s, d, 10).select("row_id", "ref_id", "code", F.round("d2", 6).alias("d2"), F.col("rank").cast("long").alias("rank"))


@query("v4_cosine_neighbours", """WITH u AS (SELECT *, sqrt(list_sum(list_transform(vec, lambda x: x * x))) AS norm FROM (SELECT 'q' AS side, row_id AS id, vec FROM asks UNION ALL SELECT 'r', ref_id, vec FROM refs)),
    n AS (SELECT side, id, list_transform(vec, lambda x: x / greatest(norm, 1e-12)) AS vec FROM u), p AS (SELECT a.id AS row_id, b.id AS ref_id, list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM n a JOIN n b ON a.side = 'q' AND b.side = 'r')
    SELECT row_id, ref_id, round(d2, 6) AS d2, row_number() OVER (PARTITION BY row_id ORDER BY d2, ref_id) AS rank FROM p QUALIFY rank <= 5""")
def _(s, d):
    return N.neighbours(B.asks(s, d), B.refs(s, d), 5, "cosine").select("row_id", "ref_id", F.round("d2", 6).alias("d2"), F.col("rank").cast("long").alias("rank"))


def shown(df):
    return df.withColumn("margin", F.round("margin", 6)).withColumn("neighbor_distance", F.round("neighbor_distance", 6))


@query("v5_majority_vote", f"WITH {VOTE.format(name='a', k=10, w='1.0::DOUBLE')} SELECT row_id, truth, label, runner_up, round(margin, 6) AS margin, round(neighbor_distance, 6) AS neighbor_distance FROM a_v")
def _(s, d):
    return shown(N.vote(near(s, d, 10), 10))


@query("v6_weighted_vote", f"WITH {VOTE.format(name='a', k=10, w=CUBE)} SELECT row_id, truth, label, runner_up, round(margin, 6) AS margin, round(neighbor_distance, 6) AS neighbor_distance FROM a_v")
def _(s, d):
    return shown(N.vote(near(s, d, 10), 10, 3.0))


@query("v7_class_weighted_vote", f"""WITH cw AS (SELECT code AS c, 1.0::DOUBLE / count(*) AS weight FROM refs GROUP BY code), {VOTE.format(name='a', k=10, w='weight').replace('FROM near', 'FROM near JOIN cw ON near.code = cw.c')}
    SELECT row_id, truth, label, runner_up, round(margin, 6) AS margin, round(neighbor_distance, 6) AS neighbor_distance FROM a_v""")
def _(s, d):
    w = B.refs(s, d).groupBy("code").agg((1 / F.count("*")).alias("weight"))
    return shown(N.vote(near(s, d, 10), 10, class_weights=w))


@query("v8_local_scales", """SELECT a.ref_id, round(sqrt(quantile_disc(d2, 1.0)), 6) AS scale FROM (SELECT a.ref_id, list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM refs a JOIN refs b ON a.ref_id <> b.ref_id
    QUALIFY row_number() OVER (PARTITION BY a.ref_id ORDER BY d2, b.ref_id) <= 3) a GROUP BY a.ref_id""")
def _(s, d):
    return N.local_scales(B.refs(s, d), 3).withColumn("scale", F.round("scale", 6))


ADAPTIVE = f"""WITH {VOTE.format(name='a', k=10, w=CUBE)}, {VOTE.format(name='b', k=25, w=CUBE)},
    j AS (SELECT a_v.row_id, a_v.truth, a_v.margin < 0.15 AS revoted, CASE WHEN a_v.margin < 0.15 THEN b_v.label ELSE a_v.label END AS label, CASE WHEN a_v.margin < 0.15 THEN b_v.runner_up ELSE a_v.runner_up END AS runner_up,
    CASE WHEN a_v.margin < 0.15 THEN b_v.margin ELSE a_v.margin END AS margin, CASE WHEN a_v.margin < 0.15 THEN b_v.neighbor_distance ELSE a_v.neighbor_distance END AS neighbor_distance FROM a_v JOIN b_v USING (row_id))"""


@query("v11_adaptive_vote", f"{ADAPTIVE} SELECT row_id, truth, label, runner_up, round(margin, 6) AS margin, round(neighbor_distance, 6) AS neighbor_distance, revoted FROM j")
def _(s, d):
    return shown(N.classify(near(s, d), **N.resolve_vote("tuned")))


LOO = """loo_p AS (SELECT a.vec_id AS row_id, a.label AS truth, b.vec_id AS ref_id, b.label AS code, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2
    FROM (SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a JOIN (SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b ON a.vec_id <> b.vec_id),
    loo AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, ref_id) AS rank FROM loo_p QUALIFY rank <= 10)"""


def loo(s, d, k=10):
    e = table(s, d, "embeddings")
    vec = F.col("embedding").cast("array<double>").alias("vec")
    asks = e.select(F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("truth"), vec)
    return N.neighbours(asks, e.select(F.col("vec_id").alias("ref_id"), F.col("label").cast("int").alias("code"), vec), k, exclude_self=True)


@query("v14_leave_one_out", f"WITH {LOO}, v AS (SELECT row_id, truth, code, count(*) AS w FROM loo GROUP BY ALL), b AS (SELECT row_id, truth, first(code ORDER BY w DESC, code DESC) AS label FROM v GROUP BY ALL) SELECT count(*) AS n, round(avg(CASE WHEN label = truth THEN 1 ELSE 0 END), 6) AS accuracy FROM b")
def _(s, d):
    return N.accuracy(N.vote(loo(s, d), 10))


@query("v17_sweep", f"""WITH g AS (SELECT k, p FROM (SELECT unnest([5, 10, 25]) AS k) a, (SELECT unnest([0.0, 3.0]::DOUBLE[]) AS p) b), w AS (SELECT k, p, row_id, truth, code, sum((1 / (sqrt(d2) + 1e-6)) ** p) AS w FROM near, g WHERE rank <= k GROUP BY ALL),
    b AS (SELECT k, p, row_id, truth, first(code ORDER BY w DESC, code DESC) AS label FROM w GROUP BY ALL) SELECT k, p AS power, count(*) AS n, round(count(*) FILTER (WHERE label = truth) / count(*)::DOUBLE, 6) AS accuracy FROM b GROUP BY k, p""")
def _(s, d):
    return N.sweep(near(s, d), (5, 10, 25), (0.0, 3.0))


@query("v18_mcnemar", f"""WITH {VOTE.format(name='a', k=10, w='1.0::DOUBLE')}, {VOTE.format(name='b', k=10, w=CUBE)}, j AS (SELECT a_v.label = a_v.truth AS a, b_v.label = b_v.truth AS b FROM a_v JOIN b_v USING (row_id)), c AS (SELECT count(*) FILTER (WHERE NOT a AND b) AS fixed, count(*) FILTER (WHERE a AND NOT b) AS broke FROM j)
    SELECT fixed, broke, fixed - broke AS net, round((fixed - broke) / sqrt(nullif(fixed + broke, 0)), 6) AS z FROM c""")
def _(s, d):
    n = near(s, d, 10)
    return N.mcnemar(N.vote(n, 10), N.vote(n, 10, 3.0))


@query("v19_tiebreak", f"""WITH {VOTE.format(name='a', k=10, w=CUBE)}, n AS (SELECT near.row_id, near.truth, a_v.label, a_v.runner_up, code, d2, ref_id FROM near JOIN a_v USING (row_id) WHERE rank <= 10 AND a_v.margin < 0.1 AND code IN (a_v.label, a_v.runner_up)),
    g AS (SELECT row_id, truth, label, runner_up, first(code ORDER BY d2, ref_id) AS nearest, avg(sqrt(d2)) FILTER (WHERE code = label) AS a, avg(sqrt(d2)) FILTER (WHERE code <> label) AS b FROM n GROUP BY ALL)
    SELECT row_id, truth, label, nearest, CASE WHEN (a - b) / (abs(a) + abs(b) + 1e-6) > 0.001 THEN runner_up ELSE label END AS mean_distance FROM g""")
def _(s, d):
    n, _ = written(near(s, d, 10), "near")  # votes and ties are taken from one search
    return N.tiebreak(n, N.vote(n, 10, 3.0).where("margin < 0.1"), 10, 0.001)


@query("v21_cluster_diagnostics", f"""WITH {LOO}, per AS (SELECT row_id, truth, avg(CASE WHEN code = truth THEN 1 ELSE 0 END) AS own, avg(sqrt(d2)) AS radius FROM loo GROUP BY ALL), o AS (SELECT truth, count(*) AS size, avg(own) AS purity, avg(CASE WHEN own >= 0.8 THEN 1 ELSE 0 END) AS core, avg(radius) AS radius FROM per GROUP BY truth),
    f AS (SELECT truth, code, count(*) AS n FROM loo WHERE code <> truth GROUP BY ALL), t AS (SELECT truth, first(code ORDER BY n DESC, code) AS partner, max(n) / sum(n)::DOUBLE AS dominance FROM f GROUP BY truth)
    SELECT o.truth AS code, size, round(purity, 6) AS purity, round(core, 6) AS core, round(radius, 6) AS radius, t.partner, round(t.dominance, 6) AS dominance, coalesce(b.partner = o.truth, false) AS mutual,
    CASE WHEN purity < 0.5 AND t.dominance >= 0.6 AND b.partner = o.truth THEN 'duplicate' WHEN purity < 0.5 AND t.dominance >= 0.6 THEN 'engulfed' WHEN core < 0.1 THEN 'diffuse' ELSE 'boundary' END AS verdict FROM o LEFT JOIN t ON o.truth = t.truth LEFT JOIN t b ON t.partner = b.truth""")
def _(s, d):
    return N.diagnostics(loo(s, d))


@query("v26_centroid_silhouette", """WITH l AS (SELECT code, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM refs), c AS (SELECT code, list(x ORDER BY i) AS mean FROM (SELECT code, i, avg(x) AS x FROM l GROUP BY ALL) GROUP BY code),
    dd AS (SELECT ref_id, r.code, c.code AS c, sqrt(list_sum(list_transform(list_zip(r.vec, c.mean), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM refs r, c), p AS (SELECT ref_id, code, min(d) FILTER (WHERE c = code) AS a, min(d) FILTER (WHERE c <> code) AS b FROM dd GROUP BY ALL)
    SELECT code, round(avg((b - a) / nullif(greatest(a, b), 0)), 6) AS silhouette, round(avg(a), 6) AS spread FROM p GROUP BY code""")
def _(s, d):
    return N.centroid_scores(B.refs(s, d))


@query("v27_graph_silhouette", f"WITH {LOO}, e AS (SELECT truth, code, avg(sqrt(d2)) AS d FROM loo GROUP BY ALL), g AS (SELECT truth, min(d) FILTER (WHERE truth = code) AS a, min(d) FILTER (WHERE truth <> code) AS b FROM e GROUP BY truth) SELECT truth AS code, round((b - a) / greatest(a, b), 6) AS silhouette FROM g")
def _(s, d):
    return N.graph_silhouette(loo(s, d))


@query("a18_mean_vector", "SELECT list(x ORDER BY i) AS mean FROM (SELECT i, round(avg(x), 6) AS x FROM (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM asks) GROUP BY i)")
def _(s, d):
    return N.mean_vector(B.asks(s, d)).select(F.transform("mean", lambda x: K.rounded(x)).alias("mean"))


@query("v24_shift_compare", """WITH r AS (SELECT quantile_cont(neighbor_distance, 0.99) AS p99, quantile_cont(neighbor_distance, 0.5) AS p50 FROM tiles WHERE hpc_id % 2 = 0), g AS (SELECT slides, avg(CASE WHEN neighbor_distance > p99 THEN 1 ELSE 0 END) AS beyond, quantile_cont(neighbor_distance, 0.5) / nullif(first(p50), 0) AS ratio FROM tiles, r GROUP BY slides)
    SELECT slides, round(beyond, 6) AS beyond, round(ratio, 6) AS ratio, CASE WHEN beyond > 0.05 OR ratio > 1.5 THEN 'alarm' WHEN beyond > 0.02 OR ratio > 1.15 THEN 'notice' ELSE 'consistent' END AS verdict FROM g""")
def _(s, d):
    t = B.tiles(s, d)
    return N.shift_compare(t, t.where("hpc_id % 2 = 0"), "slides")
