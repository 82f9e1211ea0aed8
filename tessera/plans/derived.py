"""Queries of registration, selections and derived frames."""

from pyspark.sql import functions as F

from tessera.operators import cohort as C
from tessera.operators import knn as N
from tessera.operators import profiles as P
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.plans.search import CUBE, VOTE, near
from tessera.sources import table


@query("s13_ambiguous_files", r"SELECT ambiguous, count(*) AS n, CAST(sum(files) AS BIGINT) AS files FROM (SELECT regexp_extract(url, '([^/?#]+?)(\.[A-Za-z0-9]+)?/?([?#].*)?$', 1) AS slide, count(*) AS files, count(*) > 1 AS ambiguous FROM pages GROUP BY 1) GROUP BY ambiguous")
def _(s, d):
    return C.slide_files(table(s, d, "pages"), "url").groupBy("ambiguous").agg(F.count("*").alias("n"), F.sum("files").alias("files"))


@query("k14_normalising_updates", "SELECT count(*) FILTER (WHERE p_name <> upper(trim(p_name))) AS p_name, count(*) FILTER (WHERE p_brand <> upper(trim(p_brand))) AS p_brand FROM part")
def _(s, d):
    return C.normalising_updates(table(s, d, "part"), "p_name", "p_brand")


@query("p13_low_confidence", "SELECT slides, count(*) AS n FROM tiles WHERE vote_margin < 0.1 GROUP BY slides")
def _(s, d):
    return P.counts_by(C.low_confidence(B.tiles(s, d)), "slides")


@query("p14_contains", "SELECT p_partkey FROM part WHERE contains(lower(p_type), 'an')")
def _(s, d):
    return C.containing(table(s, d, "part"), "p_type", "AN").select("p_partkey")


@query("p15_enough_tiles", "SELECT slides, count(*) FILTER (WHERE malignant) AS n FROM tiles LEFT JOIN dictionary USING (hpc_id) GROUP BY slides HAVING count(*) FILTER (WHERE malignant) >= 190")
def _(s, d):
    n = B.tiles(s, d).join(B.dictionary(s), "hpc_id", "left").groupBy("slides").agg(F.count_if("malignant").alias("n"))
    return C.enough_tiles(n, "n", 190)


@query("p37_threshold_flags", "SELECT c_custkey, c_acctbal > 65 AS over_c_acctbal_65 FROM customer")
def _(s, d):
    return C.over(table(s, d, "customer").select("c_custkey", "c_acctbal"), c_acctbal=65).drop("c_acctbal")


@query("j2_heatmap_merge", "SELECT t.slide_tile, h.p FROM tiles t LEFT JOIN (SELECT slide_tile, hpc_id / 71.0::DOUBLE AS p FROM tiles WHERE run % 2 = 0) h ON t.slide_tile = h.slide_tile WHERE t.slides = '6'")
def _(s, d):
    t = B.tiles(s, d)
    heat = t.where("run % 2 = 0").select("slide_tile", (F.col("hpc_id") / 71.0).alias("p"))
    return C.with_probabilities(t.where("slides = '6'").select("slide_tile"), heat)


@query("j9_orphan_summaries", "SELECT count(*) AS n FROM (SELECT DISTINCT slides FROM tiles) a LEFT JOIN (SELECT DISTINCT slides FROM tiles WHERE CAST(slides AS INTEGER) % 6 <> 0) b ON a.slides = b.slides WHERE b.slides IS NULL")
def _(s, d):
    k = B.tiles(s, d).select("slides").distinct()
    return k.join(k.where(F.col("slides").cast("int") % 6 != 0).withColumn("hit", F.lit(1)), "slides", "left").where("hit is null").agg(F.count("*").alias("n"))


@query("j29_exact_join", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(s, d):
    n = table(s, d, "nation").select(F.col("n_regionkey").alias("k"), "n_nationkey", "n_name")
    r = table(s, d, "region").select(F.col("r_regionkey").alias("k"))
    named = C.joined_exactly(n, r, "k")
    return table(s, d, "supplier").join(named, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query("w7_pitch", "WITH a AS (SELECT DISTINCT slides, grid_col * 1600 AS x FROM tiles), b AS (SELECT slides, x - lag(x) OVER (PARTITION BY slides ORDER BY x) AS step FROM a) SELECT slides, min(step) AS pitch FROM b WHERE step > 0 GROUP BY slides")
def _(s, d):
    return C.pitch(B.tiles(s, d).withColumn("x", F.col("grid_col") * 1600), "x")


@query("t3_first_tiles", "SELECT slide_tile FROM tiles WHERE hpc_id = 12 ORDER BY slide_tile LIMIT 6")
def _(s, d):
    return C.first_tiles(B.tiles(s, d).where("hpc_id = 12").select("slide_tile"), 6, "slide_tile")


@query("t12_seeded_sample", "SELECT slides, slide_tile FROM tiles WHERE slides IN (SELECT slides FROM (SELECT DISTINCT slides FROM tiles) ORDER BY md5('7:' || slides), slides LIMIT 5)")
def _(s, d):
    return C.sample_of(B.tiles(s, d).select("slides", "slide_tile"), "slides", 5, 7).orderBy("slides", "slide_tile")


@query("u2_expected_tables", "SELECT name, name IN ('tile_registry', 'hpc_dictionary') AS present FROM (SELECT unnest(['tile_registry', 'hpc_dictionary', 'wsi_registry']) AS name)")
def _(s, d):
    there = s.createDataFrame([("tile_registry",), ("hpc_dictionary",), ("other",)], "name string")
    return C.expected_tables(["tile_registry", "hpc_dictionary", "wsi_registry"], there)


@query("u6_key_differences", "SELECT side, count(*) AS n FROM (SELECT 'left' AS side, vec_id AS k FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels) UNION SELECT 'right', doc_id FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) GROUP BY side")
def _(s, d):
    a, b = table(s, d, "embeddings").select(F.col("vec_id").alias("k")), table(s, d, "labels").select(F.col("doc_id").alias("k"))
    return C.key_differences(a, b, "k").groupBy("side").agg(F.count("*").alias("n"))


@query("v20_margin_bands", f"WITH {VOTE.format(name='a', k=10, w=CUBE)} SELECT CASE WHEN margin >= 0.75 THEN 4 WHEN margin >= 0.5 THEN 3 WHEN margin >= 0.25 THEN 2 WHEN margin >= 0.1 THEN 1 ELSE 0 END AS band, count(*) AS n, round(avg(CASE WHEN label = truth THEN 1 ELSE 0 END), 6) AS accuracy, round(avg(CASE WHEN runner_up = truth THEN 1 WHEN runner_up IS NULL THEN NULL ELSE 0 END), 6) AS if_swapped FROM a_v GROUP BY 1")
def _(s, d):
    return C.banded_accuracy(N.vote(near(s, d, 10), 10, 3.0))


@query("v16_holdout_accuracy", f"WITH {VOTE.format(name='a', k=10, w='1.0::DOUBLE')}, p AS (SELECT row_id % 50 AS g, avg(CASE WHEN label = truth THEN 1 ELSE 0 END) AS a, count(*) AS n FROM a_v GROUP BY 1) SELECT count(*) AS slides, CAST(sum(n) AS BIGINT) AS tiles, round(avg(a), 6) AS mean, round(stddev_samp(a), 6) AS sd FROM p")
def _(s, d):
    return C.holdout_accuracy(N.vote(near(s, d, 10), 10).withColumn("slides", F.col("row_id") % 50))


@query("v30_pca")
def _(s, d):
    out, _ = C.pca(B.refs(s, d), 4)
    return out.select("ref_id", F.transform("pca", lambda x: F.round(F.abs(x), 4)).alias("pca"))


@query("r30_build_reference", "SELECT ref_id, code, 'cluster ' || code AS label, len(vec) AS width FROM refs")
def _(s, d):
    r = B.refs(s, d)
    labels = r.select("code").distinct().withColumn("label", F.concat(F.lit("cluster "), F.col("code").cast("string")))
    return C.build_reference(r.select("ref_id", "code"), labels, r.select("ref_id", "vec")).select("ref_id", "code", "label", F.size("vec").cast("long").alias("width"))


@query("r31_unreachable_clusters", "SELECT DISTINCT hpc_id AS code FROM tiles WHERE slides = '1' AND hpc_id NOT IN (SELECT hpc_id FROM tiles WHERE slides IN ('2', '3'))")
def _(s, d):
    t = B.tiles(s, d).select("slides", F.col("hpc_id").alias("code"))
    return C.check_holdout(t.where("slides = '1'"), t.where("slides in ('2', '3')"))


REGISTRY = "(SELECT slide_tile, min(samples) AS samples, min(slides) AS slides FROM tiles GROUP BY slide_tile)"


def registration(s, d):
    t = B.tiles(s, d).groupBy("slide_tile").agg(F.min("samples").alias("samples"), F.min("slides").alias("slides"))
    identity = t.withColumn("image_index", F.xxhash64("slide_tile"))
    coords = t.where(F.col("slides").cast("int") % 8 != 0).select("slide_tile", "slides", F.lit(1).alias("x"))
    return C.build_registration(identity, coords, t.where(F.col("slides").cast("int") <= 60).select("slides"))


@query("r21_build_registration", f"WITH r AS (SELECT * FROM {REGISTRY} WHERE CAST(slides AS INTEGER) <= 60) SELECT 'registry' AS part, count(*) AS n FROM r UNION ALL SELECT 'coordinates', count(*) FROM r WHERE CAST(slides AS INTEGER) % 8 <> 0 UNION ALL SELECT 'slides', count(DISTINCT slides) FROM r UNION ALL SELECT 'unmatched', count(*) FROM r WHERE CAST(slides AS INTEGER) % 8 = 0 UNION ALL SELECT 'conflicts', 0")
def _(s, d):
    parts = [df.agg(F.lit(k).alias("part"), F.count("*").alias("n")) for k, df in registration(s, d).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("r23_registration_preview", f"SELECT count(*) FILTER (WHERE samples = 'FRANCE') AS existing, count(*) FILTER (WHERE samples <> 'FRANCE') AS foreign_, (SELECT count(*) FROM {REGISTRY} WHERE CAST(slides AS INTEGER) % 3 = 0) AS incoming FROM {REGISTRY} WHERE CAST(slides AS INTEGER) % 3 = 0")
def _(s, d):
    t = B.tiles(s, d).groupBy("slide_tile").agg(F.min("samples").alias("samples"), F.min("slides").alias("slides"))
    return C.registration_preview(t, t.where(F.col("slides").cast("int") % 3 == 0), "slide_tile", "samples", "FRANCE").withColumnRenamed("foreign", "foreign_")


@query("r1_cluster_frames", """WITH n AS (SELECT hpc_id, flag, count(*) AS n FROM tiles GROUP BY ALL), g AS (SELECT hpc_id, CAST(sum(n) AS BIGINT) AS size, first(flag ORDER BY n DESC, flag) AS dominant, 100.0::DOUBLE * max(n) / sum(n) AS p FROM n GROUP BY hpc_id),
    v AS (SELECT hpc_id, count(*) AS n_samples, max(n) AS most_tiles FROM (SELECT hpc_id, slides, count(*) AS n FROM tiles GROUP BY ALL) GROUP BY hpc_id) SELECT hpc_id, size, CASE WHEN p >= 50 THEN dominant ELSE '-1' END AS subtype, round(p, 4) AS purity, n_samples, most_tiles FROM g JOIN v USING (hpc_id)""")
def _(s, d):
    return C.frames(B.tiles(s, d), "hpc_id", "flag", "slides").select("hpc_id", "size", "subtype", "purity", "n_samples", "most_tiles")


@query("r5_connectivity_features", "SELECT samples, count(*) FILTER (WHERE hpc_id < 5) AS own, count(*) FILTER (WHERE flag = 'R') AS conn FROM tiles GROUP BY samples")
def _(s, d):
    t = B.tiles(s, d)
    own = t.groupBy("samples").agg(F.count_if(F.col("hpc_id") < 5).alias("own"))
    return C.with_connectivity(own, t.groupBy("samples").agg(F.count_if(F.col("flag") == "R").alias("conn")), "samples", True)


@query("r7_purity_row", "SELECT kind, count(*) AS n FROM (SELECT 'sample' AS kind FROM tiles GROUP BY samples UNION ALL SELECT 'purity') GROUP BY kind")
def _(s, d):
    t = B.tiles(s, d)
    purity = t.agg(F.round(F.avg("vote_margin"), 6).alias("purity"))
    return C.with_purity(P.counts_by(t, "samples"), purity).groupBy("kind").agg(F.count("*").alias("n"))


@query("r14_group_counts", "SELECT slides, count(*) FILTER (WHERE hpc_id < 10) AS hot, count(*) FILTER (WHERE hpc_id BETWEEN 10 AND 29) AS cold FROM tiles GROUP BY slides")
def _(s, d):
    return C.group_counts(B.tiles(s, d), "slides", "hpc_id", {"hot": list(range(10)), "cold": list(range(10, 30))})


@query("r15_core_ids", "SELECT s_suppkey, 'A' || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS core FROM supplier WHERE s_suppkey < 1000")
def _(s, d):
    k = table(s, d, "supplier").where("s_suppkey < 1000")
    return k.select("s_suppkey", C.core_id(F.concat(F.lit("a"), F.col("s_suppkey").cast("string"))).alias("core"))


@query("r16_topography", "SELECT hpc_id, CASE WHEN malignant THEN 'malignant' ELSE 'stromal' END AS side FROM dictionary WHERE malignant IS NOT NULL")
def _(s, d):
    return C.topography(B.dictionary(s))


@query("r20_participants", "SELECT slide_tile, split_part(slide_tile, '_', 1) AS slide, split_part(slide_tile, '_', 1) AS participant FROM tiles")
def _(s, d):
    return C.with_participants(B.tiles(s, d).select("slide_tile"), "slide_tile")


@query("m25_combined_sets", "SELECT part, count(*) AS n FROM (SELECT 'train' AS part FROM tiles WHERE run % 5 > 0 UNION ALL SELECT 'test' FROM tiles WHERE run % 5 = 0) GROUP BY part")
def _(s, d):
    t = B.tiles(s, d).select("slide_tile", "run")
    return C.combined({"train": t.where("run % 5 > 0"), "test": t.where("run % 5 = 0")}).groupBy("part").agg(F.count("*").alias("n"))


@query("a14_cohort_rows", "SELECT samples, count(*) AS n FROM tiles GROUP BY samples")
def _(s, d):
    return P.counts_by(B.tiles(s, d), "samples")


@query("a47_label_composition", "SELECT slides, " + ", ".join(f"count(*) FILTER (WHERE hpc_id % 4 = {i}) AS v_{i}" for i in range(4)) + " FROM tiles GROUP BY slides")
def _(s, d):
    return P.crosstab(B.tiles(s, d).withColumn("part", F.col("hpc_id") % 4), "slides", "part", [0, 1, 2, 3])


@query("j27_clinical_merge", "SELECT t.samples, c.n_customers, t.n FROM (SELECT samples, count(*) AS n FROM tiles GROUP BY samples) t LEFT JOIN (SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) c ON t.samples = c.n_name")
def _(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("samples")).agg(F.count("*").alias("n_customers"))
    return P.counts_by(B.tiles(s, d), "samples").join(c, "samples", "left")


@query("j16_coords_embeddings", "SELECT e.vec_id, count(*) AS n FROM embeddings e JOIN tiles t ON e.vec_id = t.run GROUP BY e.vec_id")
def _(s, d):
    e = table(s, d, "embeddings").select(F.col("vec_id").alias("run"))
    return B.tiles(s, d).select("run").join(e, "run").groupBy(F.col("run").alias("vec_id")).agg(F.count("*").alias("n"))


@query("q15_slide_view", "SELECT t.slide_tile, d.malignant FROM tiles t LEFT JOIN dictionary d ON t.hpc_id = d.hpc_id WHERE t.slides = '4' AND t.grid_col = 21 AND t.grid_row = 13")
def _(s, d):
    return C.tile_at(B.tiles(s, d), "4", 35000, 21000, 1600.0).join(B.dictionary(s), "hpc_id", "left").select("slide_tile", "malignant")


@query("s11_sql_scan", "SELECT slides, max(vote_margin) AS top FROM tiles WHERE hpc_id = 3 GROUP BY slides")
def _(s, d):
    return C.sql_frame(B.tiles(s, d), "t", "SELECT slides, max(vote_margin) AS top FROM {t} WHERE hpc_id = 3 GROUP BY slides")


@query("s18_descriptions", "SELECT hpc_id, hpc_title AS description FROM dictionary WHERE hpc_id % 9 <> 0")
def _(s, d):
    sheet = B.dictionary(s).select("hpc_id", F.concat(F.lit(" "), "hpc_title").alias("description"), F.when(F.col("hpc_id") % 9 == 0, "X").alias("removed"))
    return C.descriptions(sheet)[0]


@query("k17_wide_to_long", "SELECT slides, hpc_id, n / 10.0::DOUBLE AS p FROM proportion WHERE hpc_id IN (1, 2, 30)")
def _(s, d):
    n = P.counts_by(B.tiles(s, d), "slides", "hpc_id").select("slides", "hpc_id", (F.col("n") / 10).alias("p"))
    return C.to_long(C.to_wide(n, "slides", [1, 2, 30]), "slides")


@query("j5_preview_match", "SELECT count(*) AS n FROM tiles WHERE upper(trim(slide_tile)) IN (SELECT upper(trim(slide_tile)) FROM tiles WHERE run % 3 = 0)")
def _(s, d):
    t = B.tiles(s, d).select("slide_tile", "run")
    lower = t.where("run % 3 = 0").select(F.concat(F.lit(" "), F.lower("slide_tile")).alias("slide_tile"))
    return C.matched(t, lower).agg(F.count("*").alias("n"))


@query("j10_malignancy_map", "SELECT malignant, count(*) AS n FROM tiles LEFT JOIN dictionary USING (hpc_id) GROUP BY malignant")
def _(s, d):
    return C.titled(B.tiles(s, d), B.dictionary(s), strict=True).groupBy("malignant").agg(F.count("*").alias("n"))


@query("a3_unfiltered_profiles", "SELECT samples, slides, CAST(sum(n) AS BIGINT) AS total_tiles, round(max(proportion), 6) AS top FROM proportion GROUP BY samples, slides")
def _(s, d):
    p = P.proportion(B.tiles(s, d))
    return p.groupBy("samples", "slides").agg(F.sum("n").alias("total_tiles"), F.round(F.max("proportion"), 6).alias("top"))
