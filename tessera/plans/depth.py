"""Queries over whole tables of what takes more than one aggregation: loads by version, profiles, regressions, near names, exact medoids."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import cox, knn, names, ovr, scan, shift
from tessera.operators import spatial as X
from tessera.operators import stats as M
from tessera.plans import bindings as B
from tessera.plans.loads import LOADED, load
from tessera.plans.measures import people
from tessera.plans.registry import query
from tessera.sources import table, versions
from tessera.sources.scratch import new_path


@query("k3_published_load", LOADED)
def _(s, d):
    path = new_path(s, "published")
    planned = load(s, d)
    first = versions.publish(B.tiles(s, d).select("slide_tile", "slides", "hpc_id"), path)
    planned.publish(path, base=first)
    return versions.read(s, path).groupBy("slides", "hpc_id").agg(F.count("*").alias("n"))


@query("k7_versions_read_back", "SELECT 'first' AS version, flag, count(*) AS n FROM tiles GROUP BY flag UNION ALL SELECT 'second', flag, count(*) FROM tiles WHERE hpc_id % 2 = 0 GROUP BY flag")
def _(s, d):
    t, path = B.tiles(s, d).select("slide_tile", "flag", "hpc_id"), new_path(s, "versions")
    made = {"first": versions.publish(t.repartition(8), path, t.count())}
    made["second"] = versions.publish(versions.read(s, path).where("hpc_id % 2 = 0"), path, base=made["first"])
    parts = (versions.read(s, path, v).groupBy("flag").agg(F.count("*").alias("n")).select(F.lit(name).alias("version"), "flag", "n") for name, v in made.items())
    return reduce(DataFrame.unionAll, parts)


def sides(s, d):
    t = B.tiles(s, d)
    return t.where("hpc_id % 2 = 1"), t.where("hpc_id % 2 = 0")


@query("v24_profile", "WITH r AS (SELECT * FROM tiles WHERE hpc_id % 2 = 0) " + " UNION ALL ".join(f"SELECT 'tuned' AS vote, count(*) AS n, {x}::DOUBLE AS level, round(quantile_cont(neighbor_distance::DOUBLE, {x}), 6) AS distance, round(quantile_cont(vote_margin::DOUBLE, {x}), 6) AS margin FROM r" for x in shift.LEVELS))
def _(s, d):
    _, reference = sides(s, d)
    return shift.build_profile(reference, "tuned").to_frame(s).withColumn("distance", F.round("distance", 6)).withColumn("margin", F.round("margin", 6))


SHIFT = "WITH r AS (SELECT neighbor_distance::DOUBLE AS d FROM tiles WHERE hpc_id % 2 = 0), q AS (SELECT " + ", ".join(f"quantile_cont(d, {x}) AS q{i}" for i, x in enumerate(shift.LEVELS)) + " FROM r), c AS (SELECT slides, neighbor_distance::DOUBLE AS d, vote_margin::DOUBLE AS m FROM tiles WHERE hpc_id % 2 = 1)"
SLIDES = "sl AS (SELECT slides, count(*) AS n, avg(CASE WHEN d > q8 THEN 1.0 ELSE 0.0 END::DOUBLE) AS beyond, quantile_cont(d, 0.5) AS median_distance, avg(CASE WHEN m < 0.10 THEN 1.0 ELSE 0.0 END::DOUBLE) AS low_margin FROM c, q GROUP BY slides)"


def interpolated(x: str) -> str:
    parts = " ".join(f"WHEN {x} < q{i + 1} THEN {a}::DOUBLE + ({x} - q{i}) * ({b}::DOUBLE - {a}::DOUBLE) / nullif(q{i + 1} - q{i}, 0)" for i, (a, b) in enumerate(zip(shift.LEVELS, shift.LEVELS[1:], strict=False)))
    return f"CASE WHEN {x} < q0 THEN {shift.LEVELS[0]}::DOUBLE {parts} ELSE {shift.LEVELS[-1]}::DOUBLE END"


@query("v24_slide_spread", f"{SHIFT}, {SLIDES} SELECT slides, n, round(beyond, 6) AS beyond, round(median_distance, 6) AS median_distance, round(low_margin, 6) AS low_margin FROM sl")
def _(s, d):
    cohort, reference = sides(s, d)
    out = shift.per_slide(cohort, shift.build_profile(reference, "tuned"))
    return out.select("slides", "n", *(F.round(c, 6).alias(c) for c in ("beyond", "median_distance", "low_margin")))


@query("v24_cohort_verdict", f"""{SHIFT}, {SLIDES}, w AS (SELECT count(*) AS n, avg(CASE WHEN d > q8 THEN 1.0 ELSE 0.0 END::DOUBLE) AS beyond, quantile_cont(d, 0.5) AS med FROM c, q),
    p AS (SELECT w.n, beyond, q8 AS envelope, 100 * {interpolated('med')} AS pct, (SELECT max(beyond) - min(beyond) FROM sl) AS spread FROM w, q)
    SELECT n, n AS n_finite, round(envelope, 6) AS envelope, round(beyond, 6) AS beyond, round(beyond / (1.0::DOUBLE - 0.99::DOUBLE), 6) AS novelty_ratio, round(pct, 6) AS median_percentile, round(spread, 6) AS spread, spread > 0.10 AS concentrated,
    CASE WHEN pct >= 85 THEN 'alarm' WHEN beyond / 0.01 >= 2 OR pct >= 65 THEN 'notice' ELSE 'consistent' END AS verdict FROM p""")
def _(s, d):
    cohort, reference = sides(s, d)
    out = shift.compare(cohort, shift.build_profile(reference, "tuned"), "tuned")
    return out.select("n", "n_finite", *(F.round(c, 6).alias(c) for c in ("envelope", "beyond", "novelty_ratio", "median_percentile", "spread")), "concentrated", "verdict")


QS = (0.0, 0.001, 0.33, 0.5, 0.66, 0.999, 1.0)


@query("w12_exact_quantiles", " UNION ALL ".join(f"SELECT {q}::DOUBLE AS q, round(quantile_cont(l_extendedprice::DOUBLE, {q}), 6) AS value FROM lineitem" for q in QS))
def _(s, d):
    found = scan.quantiles(table(s, d, "lineitem"), "l_extendedprice", QS)
    return s.createDataFrame([(q, v) for q, v in zip(QS, found, strict=True)], "q double, value double").withColumn("value", F.round("value", 6))


@query("w12_price_ranks", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem")
def _(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return scan.ranked(li, "l_extendedprice", ("l_orderkey", "l_linenumber"), descending=True).drop("l_extendedprice")


@query("m7_adjusted_p_of_tiles", "WITH t AS (SELECT hpc_id, avg(vote_margin) AS v FROM tiles GROUP BY hpc_id), p AS (SELECT *, round(v - floor(v), 6) AS p FROM t), r AS (SELECT *, count(*) OVER (ORDER BY p) AS k, count(*) OVER () AS n FROM p) SELECT hpc_id, p, round(least(1.0, min(p * n / k) OVER (ORDER BY p DESC)), 6) AS q FROM r")
def _(s, d):
    t = B.tiles(s, d).groupBy("hpc_id").agg(F.avg("vote_margin").alias("v")).select("hpc_id", F.round(F.col("v") - F.floor("v"), 6).alias("p"))
    return M.benjamini_hochberg(t, "p").withColumn("q", F.round("q", 6))


@query("v22_exact_medoids", """WITH p AS (SELECT a.code, a.ref_id, count(*) AS n, sum(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS cost FROM refs a JOIN refs b ON a.code = b.code GROUP BY ALL)
    SELECT code, ref_id AS medoid, n, round(cost, 4) AS cost FROM p QUALIFY row_number() OVER (PARTITION BY code ORDER BY round(cost, 6), ref_id) = 1""")
def _(s, d):
    return knn.exact_medoids(B.refs(s, d)).withColumn("cost", F.round("cost", 4))


# Newton steps have no SQL; tests hold these against plain NumPy, and the score equations against SQL
@query("r10_feature_table")
def _(s, d):
    out = cox.feature_table(people(s, d), "time", "event", ["x", "y"], 0.1)
    return out.select("feature", *(F.round(c, 6).alias(c) for c in ("coef", "se", "z", "hazard_ratio", "low", "high")))


def marked(s, d):
    k = F.col("c_custkey")
    return table(s, d, "customer").select("c_custkey", (k % 3).alias("fold"), ((k * 37) % 120 + 1).alias("time"), (k % 3 != 0).cast("int").alias("event"), (F.col("c_acctbal") / 10_000).alias("balance"), ((k * 37) % 120 / 120.0 + (k % 7) / 7.0).alias("marker"), ((k % 11) / 11.0).alias("noise"))


@query("r10_best_subsets")
def _(s, d):
    return cox.best_subset(marked(s, d), "time", "event", "c_custkey", ["balance", "marker", "noise"], F.col("fold"))


@query("r10_refit")
def _(s, d):
    out = cox.refit(marked(s, d), "time", "event", "c_custkey", ["balance", "marker"], F.col("fold"), (0.1, 10.0, 1000.0))
    return out.select("ridge", "c_index", "feature", F.round("coef", 6).alias("coef"), F.round("se", 6).alias("se"))


def classes(s, d):
    return table(s, d, "embeddings").select("vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vec"), (F.col("vec_id") % 3).alias("fold"))


def predicted(s, d):
    e = classes(s, d)
    model = ovr.fit(e, "label", "vec", "fold")
    return ovr.predict(e, model, "vec", "fold", ("vec_id", "label")), model


@query("m21_class_auc")
def _(s, d):
    scored, model = predicted(s, d)
    return ovr.class_auc(scored, "label", model)


@query("m21_error_matrix")
def _(s, d):
    return ovr.error_matrix(predicted(s, d)[0], "label")


# SQL has no longest common subsequence; a test tries all pairs
@query("q2_near_names")
def _(s, d):
    c = table(s, d, "customer").select("c_name", "c_custkey")
    # one letter dropped, one doubled, or the case changed, by turns
    at = F.pmod(F.col("c_custkey"), F.length("c_name")).cast("int") + 1
    less = F.concat(F.substring(F.col("c_name"), F.lit(1), at - 1), F.substring(F.col("c_name"), at + 1, F.lit(99)))
    more = F.concat(F.substring(F.col("c_name"), F.lit(1), at), F.substring(F.col("c_name"), at, F.lit(99)))
    k = F.col("c_custkey") % 3
    asked = c.select(F.when(k == 0, less).when(k == 1, more).otherwise(F.upper("c_name")).alias("asked"))
    return names.closest(asked, c, "asked", "c_name")


@query("j24_last_phenotypes", """WITH p AS (SELECT DISTINCT core, x, y, phenotype FROM cells), t AS (SELECT DISTINCT phenotype FROM cells ORDER BY 1 DESC LIMIT 2), k AS (SELECT max(phenotype) AS a, min(phenotype) AS b FROM t),
    dd AS (SELECT DISTINCT m.core, (m.x - n.x) * (m.x - n.x) + (m.y - n.y) * (m.y - n.y) AS d FROM k, p m JOIN p n ON m.core = n.core WHERE m.phenotype = k.a AND n.phenotype = k.b) SELECT core, round(avg(sqrt(d)), 6) AS mean_distance FROM dd WHERE d > 0 GROUP BY core""")
def _(s, d):
    c = B.cells(s, d)
    a, b = (r.phenotype for r in c.select("phenotype").distinct().orderBy(F.desc("phenotype")).limit(2).collect())
    return X.mean_distance(c, a, b)
