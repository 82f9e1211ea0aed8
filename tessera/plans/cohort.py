"""Queries on composition, lookups and selections of the cohort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import keys as K
from tessera.operators import profiles as P
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.sources import table


@query("a1_profile_proportion", "SELECT samples, slides, hpc_id, n, round(proportion, 6) AS proportion FROM proportion")
def _(s, d):
    return P.proportion(B.tiles(s, d)).withColumn("proportion", F.round("proportion", 6))


@query("a1_profile_min_margin", """SELECT samples, slides, hpc_id, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY samples, slides) AS DOUBLE), 6) AS proportion
    FROM tiles WHERE vote_margin >= 0.3 GROUP BY samples, slides, hpc_id""")
def _(s, d):
    return P.proportion(B.tiles(s, d), 0.3).withColumn("proportion", F.round("proportion", 6))


@query("a2_profile_summary", """SELECT samples, slides, CAST(sum(n) AS BIGINT) AS total_tiles, arg_min(hpc_id, -n * 1000 + hpc_id) AS dominant_hpc FROM proportion GROUP BY samples, slides""")
def _(s, d):
    return P.summary(B.tiles(s, d))


@query("a4_count_hpcs", """SELECT count(*) AS n, count(*) FILTER (WHERE malignant) AS n_true, count(*) FILTER (WHERE NOT malignant) AS n_false, count(*) FILTER (WHERE malignant IS NULL) AS n_null,
    round(100.0::DOUBLE * count(*) FILTER (WHERE malignant) / count(*), 2) AS pct_true, round(100.0::DOUBLE * count(*) FILTER (WHERE NOT malignant) / count(*), 2) AS pct_false,
    round(100.0::DOUBLE * count(*) FILTER (WHERE malignant IS NULL) / count(*), 2) AS pct_null FROM dictionary""")
def _(s, d):
    return P.tri_counts(B.dictionary(s))


@query("a5_malignant_coverage", """SELECT slides, round(100.0::DOUBLE * sum(CASE WHEN malignant THEN n ELSE 0 END) / nullif(sum(n), 0), 2) AS pct_malignant,
    round(100.0::DOUBLE * sum(CASE WHEN NOT malignant THEN n ELSE 0 END) / nullif(sum(n), 0), 2) AS pct_other FROM proportion LEFT JOIN dictionary USING (hpc_id) GROUP BY slides""")
def _(s, d):
    return P.coverage(P.proportion(B.tiles(s, d)), B.dictionary(s))


TUMOUR = """SELECT samples, slides, CAST(sum(n) AS BIGINT) AS total_tiles, CAST(sum(CASE WHEN malignant THEN n ELSE 0 END) AS BIGINT) AS malignant_tiles,
    count(DISTINCT CASE WHEN malignant THEN hpc_id END) AS malignant_hpcs, sum(CASE WHEN malignant THEN n ELSE 0 END) / sum(n)::DOUBLE AS fraction
    FROM proportion LEFT JOIN dictionary USING (hpc_id) GROUP BY samples, slides"""


def tumours(s, d):
    return P.tumour_list(P.proportion(B.tiles(s, d)), B.dictionary(s))


@query("a6_tumour_list", f"SELECT samples, slides, total_tiles, malignant_tiles, malignant_hpcs, round(fraction, 6) AS fraction, CAST(round_even(fraction * total_tiles, 0) AS BIGINT) AS tiles FROM ({TUMOUR})")
def _(s, d):
    return tumours(s, d).withColumn("tiles", F.bround(F.col("fraction") * F.col("total_tiles"), 0).cast("long")).withColumn("fraction", F.round("fraction", 6))


@query("a8_fraction_distribution", f"""SELECT floor, count(*) FILTER (WHERE fraction >= floor) AS kept, count(*) FILTER (WHERE fraction < floor) AS dropped,
    CAST(sum(CASE WHEN fraction >= floor THEN malignant_tiles ELSE 0 END) AS BIGINT) AS tiles, round(count(*) FILTER (WHERE fraction >= floor) / count(*)::DOUBLE, 6) AS share
    FROM ({TUMOUR}) t, (SELECT unnest([0.0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.75]::DOUBLE[]) AS floor) f GROUP BY floor""")
def _(s, d):
    return P.fraction_distribution(tumours(s, d))


@query("a9_cohort_report", f"""SELECT count(*) AS n_slides, CAST(sum(malignant_tiles) AS BIGINT) AS tiles, round(median(fraction), 6) AS median_fraction, round(min(fraction), 6) AS least_fraction,
    count(*) FILTER (WHERE malignant_tiles <= 1) AS slides_of_one_tile FROM ({TUMOUR})""")
def _(s, d):
    return P.cohort_report(tumours(s, d))


#: Published accuracies of margin bands.
BANDS = ((0.0, 0.1, 61.7), (0.1, 0.25, 81.2), (0.25, 0.5, 95.5), (0.5, 0.75, 99.5), (0.75, 1.01, 100.0))


@query("a10_margin_tradeoff", """WITH acc AS (SELECT vote_margin, CASE WHEN vote_margin < 0.1 THEN 61.7 WHEN vote_margin < 0.25 THEN 81.2 WHEN vote_margin < 0.5 THEN 95.5 WHEN vote_margin < 0.75 THEN 99.5 WHEN vote_margin < 1.01 THEN 100.0 END::DOUBLE AS accuracy FROM tiles)
    SELECT cut, count(*) FILTER (WHERE vote_margin >= cut) AS kept, round(count(*) FILTER (WHERE vote_margin >= cut) / count(*)::DOUBLE, 6) AS share, round(avg(accuracy) FILTER (WHERE vote_margin >= cut) + 1e-9, 6) AS accuracy
    FROM acc, (SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.75]::DOUBLE[]) AS cut) GROUP BY cut""")
def _(s, d):
    return P.margin_tradeoff(B.tiles(s, d), (0.0, 0.1, 0.25, 0.5, 0.75), BANDS)


@query("a11_inspect_report", """SELECT count(*) AS n_rows, count(r.slide_tile) AS matched, count(*) FILTER (WHERE r.hpc_id IS NOT NULL AND r.hpc_id <> t.hpc_id) AS overwriting,
    count(DISTINCT CASE WHEN dc.hpc_id IS NULL THEN t.hpc_id END) AS unknown_clusters, count(*) FILTER (WHERE t.vote_margin < 0.1) AS low_margin
    FROM tiles t LEFT JOIN (SELECT slide_tile, hpc_id + 1 AS hpc_id FROM tiles WHERE run % 7 <> 0) r ON t.slide_tile = r.slide_tile LEFT JOIN (SELECT * FROM dictionary WHERE hpc_id < 60) dc ON t.hpc_id = dc.hpc_id""")
def _(s, d):
    from tessera.operators.guards import inspect

    t = B.tiles(s, d)
    registry = t.where("run % 7 <> 0").select("slide_tile", (F.col("hpc_id") + 1).alias("hpc_id"))
    return inspect(t, registry, B.dictionary(s).where("hpc_id < 60"))


@query("a12_existing_scope", "SELECT samples AS dataset, count(*) AS n_rows, count(DISTINCT slides) AS n_slides FROM tiles GROUP BY samples")
def _(s, d):
    return B.tiles(s, d).groupBy(F.col("samples").alias("dataset")).agg(F.count("*").alias("n_rows"), F.countDistinct("slides").alias("n_slides"))


@query("a13_foreign_scope", "SELECT samples AS dataset, count(*) AS n FROM tiles WHERE samples <> 'FRANCE' AND hpc_id IN (SELECT hpc_id FROM tiles WHERE run % 100 = 0) GROUP BY samples")
def _(s, d):
    t = B.tiles(s, d)
    return t.where("samples <> 'FRANCE'").join(t.where("run % 100 = 0").select("hpc_id").distinct(), "hpc_id", "left_semi").groupBy(F.col("samples").alias("dataset")).agg(F.count("*").alias("n"))


@query("a17_class_weights", "SELECT hpc_id, count(*) AS n, round(1.0::DOUBLE / greatest(count(*), 1), 9) AS weight FROM tiles GROUP BY hpc_id")
def _(s, d):
    return P.counts_by(B.tiles(s, d), "hpc_id").withColumn("weight", F.round(1 / F.greatest("n", F.lit(1)), 9))


@query("a20_majority_vote", """WITH n AS (SELECT hpc_id, flag, count(*) AS n FROM tiles GROUP BY ALL) SELECT hpc_id, first(flag ORDER BY n DESC, flag) AS label, round(max(n) / sum(n)::DOUBLE, 2) AS agreement FROM n GROUP BY hpc_id""")
def _(s, d):
    return P.majority(B.tiles(s, d), "hpc_id", "flag")


@query("a23_cluster_purities", """WITH n AS (SELECT hpc_id, flag, count(*) AS n FROM tiles GROUP BY ALL), g AS (SELECT hpc_id, CAST(sum(n) AS BIGINT) AS size, first(flag ORDER BY n DESC, flag) AS dominant, 100.0::DOUBLE * max(n) / sum(n) AS p FROM n GROUP BY hpc_id)
    SELECT hpc_id, size, dominant, round(p, 4) AS purity, CASE WHEN p >= 50 THEN dominant ELSE '-1' END AS subtype FROM g""")
def _(s, d):
    return P.purities(B.tiles(s, d), "hpc_id", "flag")


@query("a24_cluster_diversity", """WITH n AS (SELECT hpc_id, slides, count(*) AS n FROM tiles GROUP BY ALL) SELECT hpc_id, round(avg(n), 6) AS mean_tiles, max(n) AS most_tiles, count(*) AS n_samples,
    round(100.0::DOUBLE * count(*) / (SELECT count(DISTINCT slides) FROM tiles), 4) AS pct_samples FROM n GROUP BY hpc_id""")
def _(s, d):
    return P.diversity(B.tiles(s, d), "hpc_id", "slides")


@query("a25_patient_presence", """WITH n AS (SELECT slides, hpc_id, count(*) AS n, sum(count(*)) OVER (PARTITION BY slides) AS t FROM tiles GROUP BY slides, hpc_id), a AS (SELECT count(DISTINCT slides) AS ns, count(*) AS nt FROM tiles)
    SELECT hpc_id, round(count(*) FILTER (WHERE n >= 0.005::DOUBLE * t) / max(ns)::DOUBLE, 6) AS presence, round(sum(CASE WHEN n >= 0.005::DOUBLE * t THEN t ELSE 0 END) / max(nt)::DOUBLE, 6) AS weighted_presence FROM n, a GROUP BY hpc_id""")
def _(s, d):
    return P.presence(B.tiles(s, d), "hpc_id", "slides")


@query("a27_crosstab_shares", """SELECT samples, round(count(*) FILTER (WHERE flag = 'A') / nullif(count(*), 0)::DOUBLE, 6) AS "v_A", round(count(*) FILTER (WHERE flag = 'N') / nullif(count(*), 0)::DOUBLE, 6) AS "v_N", round(count(*) FILTER (WHERE flag = 'R') / nullif(count(*), 0)::DOUBLE, 6) AS "v_R" FROM tiles GROUP BY samples""")
def _(s, d):
    return P.crosstab(B.tiles(s, d), "samples", "flag", ["A", "N", "R"], share=True)


@query("a28_pivot_mean", "SELECT samples, round(avg(vote_margin) FILTER (WHERE flag = 'A') + 1e-9, 6) AS a, round(avg(vote_margin) FILTER (WHERE flag = 'N') + 1e-9, 6) AS n, round(avg(vote_margin) FILTER (WHERE flag = 'R') + 1e-9, 6) AS r FROM tiles GROUP BY samples")
def _(s, d):
    wide = B.tiles(s, d).groupBy("samples").pivot("flag", ["A", "N", "R"]).agg(F.avg("vote_margin"))
    return wide.select("samples", *(F.round(F.col(c) + 1e-9, 6).alias(c.lower()) for c in ("A", "N", "R")))  # off the halves, where orders of summation would show


@query("a29_melt", "SELECT slides, 'n_a' AS measure, count(*) FILTER (WHERE flag = 'A') AS n FROM tiles GROUP BY slides UNION ALL SELECT slides, 'n_r', count(*) FILTER (WHERE flag = 'R') FROM tiles GROUP BY slides")
def _(s, d):
    wide = B.tiles(s, d).groupBy("slides").agg(F.count_if(F.col("flag") == "A").alias("n_a"), F.count_if(F.col("flag") == "R").alias("n_r"))
    return wide.unpivot("slides", ["n_a", "n_r"], "measure", "n")


@query("a33_category_counts", """SELECT hpc_id, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct FROM tiles GROUP BY hpc_id ORDER BY n DESC, hpc_id LIMIT 14""")
def _(s, d):
    n = P.counts_by(B.tiles(s, d), "hpc_id")
    total = n.agg(F.sum("n").alias("total"))
    return n.crossJoin(total).select("hpc_id", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct")).orderBy(F.desc("n"), "hpc_id").limit(14)


@query("a34_survival_risk", """WITH r AS (SELECT samples, slides, sum(proportion * coef) AS risk FROM proportion JOIN survival USING (hpc_id) WHERE p < 0.05 GROUP BY ALL)
    SELECT samples, slides, round(risk + 1e-9, 6) AS risk, round(risk / nullif(max(abs(risk)) OVER (PARTITION BY samples), 0) + 1e-9, 6) AS norm FROM r""")
def _(s, d):
    return P.risk(P.proportion(B.tiles(s, d)), B.survival(s))


@query("a38_duplicates", "SELECT l_suppkey, l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS n_values FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return P.duplicates(table(s, d, "lineitem"), "l_suppkey", "l_orderkey", "l_linenumber", value="l_partkey")


@query("a43_diversity_indices", """WITH p AS (SELECT slides, count(*) / CAST(sum(count(*)) OVER (PARTITION BY slides) AS DOUBLE) AS p FROM tiles GROUP BY slides, hpc_id)
    SELECT slides, round(-sum(p * ln(p)), 6) AS shannon, round(1 - sum(p * p), 6) AS simpson, round(-sum(p * log2(p)), 6) AS bits FROM p GROUP BY slides""")
def _(s, d):
    return P.shannon_simpson(B.tiles(s, d), "slides", "hpc_id")


@query("a44_kl_divergence", """WITH p AS (SELECT slides, hpc_id, count(*) / CAST(sum(count(*)) OVER (PARTITION BY slides) AS DOUBLE) AS p FROM tiles GROUP BY slides, hpc_id), q AS (SELECT hpc_id, count(*) / (SELECT count(*) FROM tiles)::DOUBLE AS q FROM tiles GROUP BY hpc_id)
    SELECT slides, round(sum(p * log2(p / q)), 6) AS kl FROM p JOIN q USING (hpc_id) GROUP BY slides""")
def _(s, d):
    return P.divergence(B.tiles(s, d), "slides", "hpc_id")


@query("a46_robust_z", """SELECT hpc_id, round(median(vote_margin), 6) AS med, round(avg(vote_margin) + 1e-9, 6) AS mean, round(quantile_cont(vote_margin, 0.25), 6) AS q1, round(quantile_cont(vote_margin, 0.75), 6) AS q3 FROM tiles GROUP BY hpc_id""")
def _(s, d):
    q = lambda x: F.round(F.percentile("vote_margin", x), 6)
    return B.tiles(s, d).groupBy("hpc_id").agg(F.round(F.median("vote_margin"), 6).alias("med"), F.round(F.avg("vote_margin") + 1e-9, 6).alias("mean"), q(0.25).alias("q1"), q(0.75).alias("q3"))


@query("a48_site_positives", "SELECT samples AS site, count(*) FILTER (WHERE malignant) AS positives, count(*) AS total FROM tiles LEFT JOIN dictionary USING (hpc_id) GROUP BY samples")
def _(s, d):
    return B.tiles(s, d).join(B.dictionary(s), "hpc_id", "left").groupBy(F.col("samples").alias("site")).agg(F.count_if("malignant").alias("positives"), F.count("*").alias("total"))


@query("w2_winner_runner_up", """WITH n AS (SELECT slides, hpc_id, n, row_number() OVER (PARTITION BY slides ORDER BY n DESC, hpc_id DESC) AS k FROM proportion)
    SELECT slides, max(hpc_id) FILTER (WHERE k = 1) AS winner, max(hpc_id) FILTER (WHERE k = 2) AS runner_up FROM n WHERE k <= 2 GROUP BY slides""")
def _(s, d):
    n = P.counts_by(B.tiles(s, d), "slides", "hpc_id").withColumn("k", F.row_number().over(Window.partitionBy("slides").orderBy(F.desc("n"), F.desc("hpc_id")))).where("k <= 2")
    return n.groupBy("slides").agg(F.max(F.when(F.col("k") == 1, F.col("hpc_id"))).alias("winner"), F.max(F.when(F.col("k") == 2, F.col("hpc_id"))).alias("runner_up"))


@query("w3_truth_rank", "SELECT slides, hpc_id, n, rank() OVER (PARTITION BY slides ORDER BY n DESC) AS rank FROM proportion")
def _(s, d):
    return P.counts_by(B.tiles(s, d), "slides", "hpc_id").withColumn("rank", F.rank().over(Window.partitionBy("slides").orderBy(F.desc("n"))).cast("long"))


@query("w6_first_occupant", "SELECT slides, grid_col, grid_row, slide_tile FROM first_tiles")
def _(s, d):
    return P.first_of(B.tiles(s, d), ["slides", "grid_col", "grid_row"], "slide_tile").select("slides", "grid_col", "grid_row", "slide_tile")


@query("w12_quantile_buckets", """WITH q AS (SELECT samples, quantile_cont(vote_margin, 0.33) AS lo, quantile_cont(vote_margin, 0.66) AS hi FROM tiles GROUP BY samples)
    SELECT samples, CASE WHEN vote_margin <= lo THEN 'low' WHEN vote_margin <= hi THEN 'mid' ELSE 'high' END AS bucket, count(*) AS n FROM tiles JOIN q USING (samples) GROUP BY ALL""")
def _(s, d):
    t = B.tiles(s, d)
    q = t.groupBy("samples").agg(F.percentile("vote_margin", 0.33).alias("lo"), F.percentile("vote_margin", 0.66).alias("hi"))
    m = F.col("vote_margin")
    return t.join(q, "samples").groupBy("samples", F.when(m <= F.col("lo"), "low").when(m <= F.col("hi"), "mid").otherwise("high").alias("bucket")).agg(F.count("*").alias("n"))


@query("t1_top_hpcs_of_slide", "SELECT hpc_id, n FROM proportion WHERE slides = '7' ORDER BY n DESC, hpc_id LIMIT 5")
def _(s, d):
    return P.counts_by(B.tiles(s, d).where("slides = '7'"), "hpc_id").orderBy(F.desc("n"), "hpc_id").limit(5)


@query("t2_top_survival", "SELECT hpc_id, round(p, 6) AS p, round(-log2(greatest(p, 1e-300)), 6) AS log2_p FROM survival WHERE p IS NOT NULL ORDER BY p, hpc_id LIMIT 10")
def _(s, d):
    top = B.survival(s).where("p is not null").orderBy("p", "hpc_id").limit(10)
    return top.select("hpc_id", F.round("p", 6).alias("p"), F.round(K.log2_p(F.col("p")), 6).alias("log2_p"))


@query("t4_rank_slides_by_hpc", "SELECT d.hpc_id, t.slides, t.n FROM dictionary d LEFT JOIN (SELECT hpc_id, slides, n FROM proportion WHERE hpc_id = 40) t ON d.hpc_id = t.hpc_id WHERE d.hpc_id IN (40, 41) ORDER BY n DESC NULLS LAST, slides LIMIT 20")
def _(s, d):
    n = P.counts_by(B.tiles(s, d).where("hpc_id = 40"), "hpc_id", "slides")
    return B.dictionary(s).where("hpc_id in (40, 41)").select("hpc_id").join(n, "hpc_id", "left").orderBy(F.desc_nulls_last("n"), "slides").limit(20)


@query("t5_top_disagreements", "SELECT slide_tile, round(vote_margin, 6) AS vote_margin FROM tiles LEFT JOIN dictionary USING (hpc_id) WHERE malignant AND flag = 'N' ORDER BY vote_margin DESC, slide_tile LIMIT 5")
def _(s, d):
    t = B.tiles(s, d).join(B.dictionary(s), "hpc_id", "left").where("malignant and flag = 'N'")
    return t.orderBy(F.desc("vote_margin"), "slide_tile").limit(5).select("slide_tile", F.round("vote_margin", 6).alias("vote_margin"))


@query("u4_unknown_clusters", "SELECT DISTINCT hpc_id FROM tiles EXCEPT SELECT hpc_id FROM dictionary WHERE hpc_id % 5 <> 0")
def _(s, d):
    return B.tiles(s, d).select("hpc_id").distinct().join(B.dictionary(s).where("hpc_id % 5 <> 0"), "hpc_id", "left_anti")


@query("u5_symmetric_difference", """(SELECT slides, 'left' AS side FROM tiles WHERE hpc_id < 3 EXCEPT SELECT slides, 'left' FROM tiles WHERE hpc_id > 68) UNION ALL (SELECT slides, 'right' FROM tiles WHERE hpc_id > 68 EXCEPT SELECT slides, 'right' FROM tiles WHERE hpc_id < 3)""")
def _(s, d):
    t = B.tiles(s, d)
    a, b = (t.where(c).select("slides").distinct() for c in ("hpc_id < 3", "hpc_id > 68"))
    return a.join(b, "slides", "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, "slides", "left_anti").withColumn("side", F.lit("right")))


@query("u7_same_rows", "SELECT count(*) AS n_differences FROM ((SELECT samples, slides, hpc_id FROM tiles EXCEPT ALL SELECT samples, slides, hpc_id FROM tiles WHERE run % 50 <> 0) UNION ALL (SELECT samples, slides, hpc_id FROM tiles WHERE run % 50 <> 0 EXCEPT ALL SELECT samples, slides, hpc_id FROM tiles))")
def _(s, d):
    t = B.tiles(s, d)
    a, b = t.select("samples", "slides", "hpc_id"), t.where("run % 50 <> 0").select("samples", "slides", "hpc_id")
    return a.exceptAll(b).unionAll(b.exceptAll(a)).agg(F.count("*").alias("n_differences"))


@query("u8_intersect", "SELECT hpc_id FROM survival WHERE p < 0.05 INTERSECT SELECT hpc_id FROM tiles WHERE vote_margin > 0.9")
def _(s, d):
    return B.survival(s).where("p < 0.05").select("hpc_id").intersect(B.tiles(s, d).where("vote_margin > 0.9").select("hpc_id"))


@query("u9_distinct_pairs", "SELECT DISTINCT slides, hpc_id FROM tiles")
def _(s, d):
    return B.tiles(s, d).select("slides", "hpc_id").distinct()


@query("u1_readiness_counts", "SELECT 'tiles' AS part, count(*) AS n FROM tiles UNION ALL SELECT 'malignant', count(*) FROM dictionary WHERE malignant UNION ALL SELECT 'other', count(*) FROM dictionary WHERE NOT malignant")
def _(s, d):
    one = lambda name, df: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    k = B.dictionary(s)
    return one("tiles", B.tiles(s, d)).unionAll(one("malignant", k.where("malignant"))).unionAll(one("other", k.where("not malignant")))


@query("j1_tiles_meta", """SELECT t.slide_tile, t.grid_col, t.grid_row, t.hpc_id, d.malignant, d.hpc_title FROM tiles t LEFT JOIN dictionary d ON t.hpc_id = d.hpc_id WHERE t.slides = '5'""")
def _(s, d):
    return B.tiles(s, d).where("slides = '5'").join(B.dictionary(s), "hpc_id", "left").select("slide_tile", "grid_col", "grid_row", "hpc_id", "malignant", "hpc_title")


@query("j4_slide_malignant_hpcs", "SELECT DISTINCT slides, hpc_id FROM tiles JOIN dictionary USING (hpc_id) WHERE malignant")
def _(s, d):
    return B.tiles(s, d).select("slides", "hpc_id").distinct().join(B.dictionary(s).where("malignant"), "hpc_id").select("slides", "hpc_id")


@query("j6_unmatched", "SELECT count(*) AS n, min(slide_tile) AS example FROM tiles WHERE slide_tile NOT IN (SELECT slide_tile FROM tiles WHERE run % 9 <> 0)")
def _(s, d):
    t = B.tiles(s, d)
    return t.join(t.where("run % 9 <> 0"), "slide_tile", "left_anti").agg(F.count("*").alias("n"), F.min("slide_tile").alias("example"))


@query("j11_reconcile", """SELECT CASE WHEN e.slides IS NULL THEN 'unexpected' WHEN c.slides IS NULL THEN 'missing' WHEN e.samples <> c.samples THEN 'relabelled' ELSE 'ok' END AS state, count(*) AS n
    FROM (SELECT DISTINCT slides, samples FROM tiles WHERE CAST(slides AS INTEGER) % 4 <> 0) e FULL OUTER JOIN (SELECT DISTINCT slides, CASE WHEN CAST(slides AS INTEGER) % 7 = 0 THEN 'x' ELSE samples END AS samples FROM tiles WHERE CAST(slides AS INTEGER) % 5 <> 0) c ON e.slides = c.slides GROUP BY 1""")
def _(s, d):
    from tessera.operators.guards import reconcile

    t = B.tiles(s, d).select("slides", "samples").distinct()
    n = F.col("slides").cast("int")
    counted = t.where(n % 5 != 0).withColumn("samples", F.when(n % 7 == 0, "x").otherwise(F.col("samples")))
    return reconcile(t.where(n % 4 != 0), counted, "slides", "samples").groupBy("state").agg(F.count("*").alias("n"))


@query("j17_three_way_outer", """SELECT coalesce(a.k, b.k, c.k) AS k, a.n AS n_p1, b.n AS n_p2, c.n AS n_p3 FROM (SELECT hpc_id AS k, count(*) AS n FROM tiles WHERE slides = '1' GROUP BY 1) a FULL JOIN (SELECT hpc_id AS k, count(*) AS n FROM tiles WHERE slides = '2' GROUP BY 1) b ON a.k = b.k
    FULL JOIN (SELECT hpc_id AS k, count(*) AS n FROM tiles WHERE slides = '3' GROUP BY 1) c ON coalesce(a.k, b.k) = c.k""")
def _(s, d):
    t = B.tiles(s, d).where("slides in ('1', '2', '3')")
    n = lambda i: F.nullif(F.count_if(F.col("slides") == str(i)), F.lit(0)).alias(f"n_p{i}")
    return t.groupBy(F.col("hpc_id").alias("k")).agg(n(1), n(2), n(3))


@query("j30_first_match", """SELECT q, coalesce(max(CASE WHEN lower(n_name) = q THEN n_name END), min(CASE WHEN contains(lower(n_name), q) THEN n_name END)) AS found FROM (SELECT unnest(['france', 'an', 'zz', 'united']) AS q) LEFT JOIN nation ON contains(lower(n_name), q) GROUP BY q""")
def _(s, d):
    from tessera.operators.lookup import first_match

    q = s.createDataFrame([(x,) for x in ("france", "an", "zz", "united")], "q string")
    return first_match(q, table(s, d, "nation"), "n_name")
