"""Queries of scalar rules, compositional transforms and statistics."""

from pyspark.sql import functions as F

from tessera.operators import composition as C
from tessera.operators import keys as K
from tessera.operators import stats as M
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.sources import table


def tile_names(t):
    x, y = K.tile_xy(F.col("tiles"))
    return t.select("slide_tile", x.alias("x"), y.alias("y"), K.normalize_tile(F.col("tiles")).alias("named"))


@query("p1_names", r"""SELECT slide_tile, regexp_extract(tiles, '^(\d+)_(\d+)', 1)::INTEGER AS x, regexp_extract(tiles, '^(\d+)_(\d+)', 2)::INTEGER AS y, tiles AS named FROM tiles""")
def _(s, d):
    return tile_names(B.tiles(s, d))


@query("p2_tile_name_verdict", "SELECT 'mixed' AS verdict, count(*) FILTER (WHERE run % 2 = 0) AS n_done, count(*) AS n FROM tiles")
def _(s, d):
    return K.tile_name_verdict(B.tiles(s, d).withColumn("tiles", F.when(F.col("run") % 2 == 0, F.col("tiles")).otherwise(F.replace("tiles", F.lit(".jpeg"), F.lit("")))))


@query("p4_sample_parts", "SELECT p_partkey, split_part(p_name, ' ', 1) AS sample, split_part(p_brand || '-' || p_size || '-x-y', '-', 2) AS site, p_brand || '-' || p_size || '-x' AS tcga FROM part")
def _(s, d):
    slide = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"), F.lit("x"), F.lit("y"))
    return table(s, d, "part").select("p_partkey", K.sample_from_slide(F.col("p_name")).alias("sample"), K.tcga_site(slide).alias("site"), K.tcga_sample(slide).alias("tcga"))


@query("p6_grid_xy", "SELECT DISTINCT grid_col, grid_row, CAST(floor((grid_col * 1600 + 13) / 1734.0) AS INTEGER) AS gx, CAST(floor((grid_row * 1600 + 7) / 1734.0) AS INTEGER) AS gy FROM tiles")
def _(s, d):
    x, y = K.grid_xy(F.col("grid_col") * 1600 + 13, F.col("grid_row") * 1600 + 7, F.lit(1734.0))
    return B.tiles(s, d).select("grid_col", "grid_row").distinct().select("grid_col", "grid_row", x.alias("gx"), y.alias("gy"))


@query("p7_native_tile_px", "SELECT p_partkey, CAST(round_even(403.2::DOUBLE / CASE WHEN p_size % 10 > 2 THEN p_size / 100.0::DOUBLE ELSE 0.252 END, 0) AS INTEGER) AS px FROM part")
def _(s, d):
    mpp = F.when(F.col("p_size") % 10 > 2, (F.col("p_size") / 100.0).cast("string")).otherwise("bad")
    return table(s, d, "part").select("p_partkey", K.native_tile_px(mpp).alias("px"))


@query("p8_malignancy_words", "SELECT w, CASE WHEN lower(trim(w)) IN ('true', 't', 'yes', '1', 'malignant') THEN true WHEN lower(trim(w)) IN ('false', 'no', '0', 'benign', 'non-malignant') THEN false END AS m FROM (SELECT unnest(['True ', 'no', '1', '0', 'Malignant', 'Non-malignant', 'benign', '?', '', ' yes']) AS w)")
def _(s, d):
    w = s.createDataFrame([(x,) for x in ("True ", "no", "1", "0", "Malignant", "Non-malignant", "benign", "?", "", " yes")], "w string")
    return w.select("w", K.parse_malignancy(F.col("w")).alias("m"))


@query("p9_polarity", "SELECT conv_id, turn, CASE WHEN regexp_matches(lower(t), '\\b(non[- ]?malignant|benign|not malignant)\\b') THEN 'non_malignant' WHEN regexp_matches(lower(t), '\\b(malignant|cancerous|tumou?r)\\b') THEN 'malignant' END AS polarity FROM (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN 'Which are Malignant?' WHEN conv_id % 3 = 1 THEN 'any non-malignant ones' ELSE text END AS t FROM conversations)")
def _(s, d):
    c = F.col("conv_id") % 3
    t = F.when(c == 0, "Which are Malignant?").when(c == 1, "any non-malignant ones").otherwise(F.col("text"))
    return table(s, d, "conversations").select("conv_id", "turn", K.malignancy_polarity(t).alias("polarity"))


@query("p16_category_keys", "SELECT coalesce(nullif(lower(trim(CASE WHEN hpc_id % 9 = 0 THEN '  ' ELSE inflammation END)), ''), 'missing') AS category, count(*) AS n FROM dictionary GROUP BY 1")
def _(s, d):
    v = F.when(F.col("hpc_id") % 9 == 0, "  ").otherwise(F.col("inflammation"))
    return B.dictionary(s).groupBy(K.category_key(v).alias("category")).agg(F.count("*").alias("n"))


@query("p17_grid_filters", "SELECT slide_tile FROM tiles WHERE hpc_id IN (3, 5) AND vote_margin >= 0.5 AND flag = 'N'")
def _(s, d):
    asked = {"hpc_id": [3, 5], "flag": ["N"], "samples": None}
    out = B.tiles(s, d).where(F.col("vote_margin") >= 0.5)
    for c, values in asked.items():
        if values is not None:
            out = out.where(F.col(c).isin(values))
    return out.select("slide_tile")


def heat(tiles):
    from pyspark.sql import Window

    from tessera.operators.profiles import proportion

    p = proportion(tiles).withColumn("v", F.log10(F.greatest("proportion", F.lit(1e-6))))
    w = Window.partitionBy("slides")
    low, high = F.min("v").over(w), F.max("v").over(w)
    return p.select("slides", "hpc_id", F.round((F.col("v") - low) / F.nullif(high - low, F.lit(0.0)), 5).alias("heat"))


@query("p18_heatmap_scale", "WITH l AS (SELECT slides, hpc_id, log10(greatest(proportion, 1e-6)) AS v FROM proportion) SELECT slides, hpc_id, round((v - min(v) OVER (PARTITION BY slides)) / nullif(max(v) OVER (PARTITION BY slides) - min(v) OVER (PARTITION BY slides), 0), 5) AS heat FROM l")
def _(s, d):
    return heat(B.tiles(s, d))


@query("p19_risk_rgba", "SELECT hpc_id, CASE WHEN abs(coef) < 0.02 THEN [0.0, 0.0, 0.0, 0.0]::DOUBLE[] WHEN coef > 0 THEN [1.0, 0.0, 0.0, least(abs(coef), 1.0)]::DOUBLE[] ELSE [0.0, 0.0, 1.0, least(abs(coef), 1.0)]::DOUBLE[] END AS rgba FROM survival")
def _(s, d):
    return B.survival(s).select("hpc_id", K.risk_rgba(F.col("coef")).alias("rgba"))


@query("p21_clinical_grade", "SELECT s_suppkey, CASE WHEN h >= 0.2 THEN 'G3' WHEN a + p > l THEN 'G2' ELSE 'G1' END AS grade FROM (SELECT s_suppkey, s_suppkey % 7 / 20.0::DOUBLE AS h, s_suppkey % 5 / 10.0::DOUBLE AS a, s_suppkey % 3 / 10.0::DOUBLE AS p, s_suppkey % 4 / 5.0::DOUBLE AS l FROM supplier)")
def _(s, d):
    k = F.col("s_suppkey")
    return table(s, d, "supplier").select("s_suppkey", K.clinical_grade(k % 4 / 5.0, k % 5 / 10.0, k % 3 / 10.0, k % 7 / 20.0).alias("grade"))


@query("p22_superclusters", "SELECT CASE WHEN hpc_id < 20 THEN 'hot' WHEN hpc_id < 40 THEN 'cold' WHEN hpc_id < 60 THEN 'mixed' ELSE 'Unknown' END AS grp, count(*) AS n FROM tiles GROUP BY 1")
def _(s, d):
    groups = {"hot": list(range(20)), "cold": list(range(20, 40)), "mixed": list(range(40, 60))}
    return B.tiles(s, d).groupBy(K.supercluster(F.col("hpc_id"), groups).alias("grp")).agg(F.count("*").alias("n"))


def trimmed(li):
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.trim_event(F.col("l_quantity") * 4 - 20).alias("months"))


@query("p23_trim_events", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(0.0, least(l_quantity * 4 - 20, 144.0))::DOUBLE AS months FROM lineitem")
def _(s, d):
    return trimmed(table(s, d, "lineitem"))


def scanner_dates(o):
    return o.select("o_orderkey", K.utc_text(K.scanner_date(F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss"))).alias("shown"))


@query("p25_scanner_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') || ' UTC' AS shown FROM orders")
def _(s, d):
    return scanner_dates(table(s, d, "orders"))


@query("p27_json_params", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("p28_json_lists", "SELECT s_suppkey, '[' || s_suppkey || ',' || s_nationkey || ']' AS levels FROM supplier")
def _(s, d):
    return table(s, d, "supplier").select("s_suppkey", F.to_json(F.array(F.col("s_suppkey"), F.col("s_nationkey").cast("long"))).alias("levels"))


@query("p29_log2_p", "SELECT hpc_id, round(-log2(greatest(p, 1e-300)), 6) AS log2_p FROM survival")
def _(s, d):
    return B.survival(s).select("hpc_id", F.round(K.log2_p(F.col("p")), 6).alias("log2_p"))


@query("p31_description_keys", "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(p_name || ' with ' || p_type), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ('with', 'and', 'the', 'of', 'a', 'in')))), ' ') AS k FROM part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", K.description_key(F.concat_ws(" with ", "p_name", "p_type")).alias("k"))


@query("p32_risk_bins", "SELECT CASE WHEN vote_margin <= 0.2 THEN 0 WHEN vote_margin <= 0.5 THEN 1 WHEN vote_margin <= 0.9 THEN 2 ELSE 3 END AS bin, count(*) AS n FROM tiles GROUP BY 1")
def _(s, d):
    return B.tiles(s, d).groupBy(K.cut(F.col("vote_margin"), [0.2, 0.5, 0.9]).alias("bin")).agg(F.count("*").alias("n"))


@query("p33_softmax", "WITH e AS (SELECT ref_id, list_transform(vec[1:5], lambda x: exp((x - list_max(vec[1:5])) / 5.0)) AS e FROM refs) SELECT ref_id, list_transform(e, lambda x: round(x / list_sum(e), 6)) AS p FROM e")
def _(s, d):
    return B.refs(s, d).select("ref_id", F.transform(K.softmax(F.slice("vec", 1, 5)), lambda x: F.round(x, 6)).alias("p"))


@query("p34_vocabulary", "SELECT c_custkey, CASE lower(trim(c_mktsegment)) WHEN 'building' THEN 'b' WHEN 'machinery' THEN 'm' ELSE 'not_applicable' END AS word FROM customer")
def _(s, d):
    return table(s, d, "customer").select("c_custkey", K.in_vocabulary(F.col("c_mktsegment"), {"building": "b", "machinery": "m"}).alias("word"))


PARTS = 6
SHARE = "WITH c AS (SELECT samples, [" + ", ".join(f"count(*) FILTER (WHERE hpc_id % 6 = {i})::DOUBLE" for i in range(6)) + "] AS c FROM tiles WHERE NOT (samples < 'F' AND hpc_id % 6 = 2) GROUP BY samples), p AS (SELECT samples, list_transform(c, lambda x: x / list_sum(c)) AS p FROM c), z AS (SELECT samples, list_transform(p, lambda x: CASE WHEN x = 0 THEN 1 / 36.0::DOUBLE ELSE x * (1 - len(list_filter(p, lambda y: y = 0)) / 36.0::DOUBLE) END) AS z FROM p), l AS (SELECT samples, list_transform(z, lambda x: ln(x)) AS l FROM z)"


def composition(s, d):
    t = B.tiles(s, d).where("not (samples < 'F' and hpc_id % 6 = 2)").withColumn("part", F.col("hpc_id") % PARTS)
    c = C.dense_counts(t, "samples", "part", list(range(PARTS)))
    return c.withColumn("p", C.closure(F.col("counts"))).withColumn("z", C.replace_zeros(F.col("p"), PARTS))


def rounded(c):
    return F.transform(c, lambda x: K.rounded(x))


@query("m1_frequency_vectors", f"{SHARE} SELECT samples, list_transform(p, lambda x: round(x, 6)) AS p FROM p")
def _(s, d):
    return composition(s, d).select("samples", rounded(F.col("p")).alias("p"))


@query("m2_clr", f"{SHARE} SELECT samples, list_transform(l, lambda x: round(x - list_sum(l) / 6, 6)) AS clr FROM l")
def _(s, d):
    return composition(s, d).select("samples", rounded(C.clr(F.col("z"), PARTS)).alias("clr"))


@query("m2_alr", f"{SHARE} SELECT samples, list_transform(l[1:5], lambda x: round(x - l[6], 6)) AS alr FROM l")
def _(s, d):
    return composition(s, d).select("samples", rounded(C.alr(F.col("z"), PARTS)).alias("alr"))


@query("m2_ilr", f"{SHARE} SELECT samples, list_transform(range(1, 6), lambda i: round(sqrt(i / (i + 1.0::DOUBLE)) * (list_sum(l[1:i]) / i - l[i + 1]), 6)) AS ilr FROM l")
def _(s, d):
    return composition(s, d).select("samples", rounded(C.ilr(F.col("z"), PARTS)).alias("ilr"))


@query("m4_log_ratios", f"{SHARE} SELECT samples, [" + ", ".join(f"round(ln(z[{i}] / z[{j}]), 6)" for i in range(1, 7) for j in range(i + 1, 7)) + "] AS ratios FROM z")
def _(s, d):
    return composition(s, d).select("samples", rounded(C.log_ratios(F.col("z"), PARTS)).alias("ratios"))


@query("m5_variance_selection", "WITH v AS (SELECT i, var_pop(x) AS v FROM (SELECT unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS i FROM refs) GROUP BY i) SELECT CAST(i AS INTEGER) AS pos, round(v, 6) AS var FROM v WHERE v > (SELECT quantile_cont(v, 0.75) FROM v)")
def _(s, d):
    return C.variance_selection(B.refs(s, d), "vec", 0.75).withColumn("var", F.round("var", 6))


def people(s, d):
    """One row a customer: time, event, two features, a side."""
    k = F.col("c_custkey")
    return table(s, d, "customer").select(k.alias("id"), ((k * 37) % 120 + 1).cast("double").alias("time"), (k % 3 != 0).cast("int").alias("event"), F.col("c_acctbal").alias("x"), ((k * 13) % 29).cast("double").alias("y"), (k % 2 == 0).alias("side"), F.col("c_mktsegment").alias("segment"))


PEOPLE = "people AS (SELECT c_custkey AS id, ((c_custkey * 37) % 120 + 1)::DOUBLE AS time, CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS event, c_acctbal AS x, ((c_custkey * 13) % 29)::DOUBLE AS y, c_custkey % 2 = 0 AS side, c_mktsegment AS segment FROM customer)"
RANK = "rank() OVER ({w} ORDER BY {v}) + (count(*) OVER ({w} {p} {v}) - 1) / 2.0"


@query("m6_pearson", f"WITH {PEOPLE} SELECT 'x' AS x, 'y' AS y, round(corr(x, y), 6) AS r, count(*) AS n FROM people UNION ALL SELECT 'time', 'y', round(corr(time, y), 6), count(*) FROM people")
def _(s, d):
    return M.correlation(people(s, d), [("x", "y"), ("time", "y")])


@query("m6_spearman", f"WITH {PEOPLE}, r AS (SELECT rank() OVER (ORDER BY time) + (count(*) OVER (PARTITION BY time) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS b FROM people) SELECT 'time' AS x, 'y' AS y, round(corr(a, b), 6) AS r, count(*) AS n FROM r")
def _(s, d):
    return M.correlation(people(s, d), [("time", "y")], "spearman")


@query("m7_benjamini_hochberg", "WITH k AS (SELECT hpc_id, p, row_number() OVER (ORDER BY p, hpc_id) AS k, count(*) OVER () AS n FROM survival WHERE p IS NOT NULL), m AS (SELECT hpc_id, p, (SELECT min(j.p * j.n / j.k) FROM k j WHERE j.k >= k.k) AS q FROM k) SELECT hpc_id, round(p, 6) AS p, round(least(1.0, q), 6) AS q FROM m")
def _(s, d):
    q = M.benjamini_hochberg(B.survival(s).where("p is not null").select("hpc_id", "p"), "p")
    return q.select("hpc_id", F.round("p", 6).alias("p"), F.round("q", 6).alias("q"))


@query("m8_ks_test", f"WITH {PEOPLE}, n AS (SELECT segment, x, count(*) FILTER (WHERE side) AS a, count(*) FILTER (WHERE NOT side) AS b FROM people GROUP BY ALL), c AS (SELECT segment, sum(a) OVER w / nullif(sum(a) OVER (PARTITION BY segment), 0)::DOUBLE - sum(b) OVER w / nullif(sum(b) OVER (PARTITION BY segment), 0)::DOUBLE AS d FROM n WINDOW w AS (PARTITION BY segment ORDER BY x)) SELECT segment, round(greatest(max(d), -min(d), 0), 6) AS ks, CASE WHEN greatest(max(d), 0) >= greatest(-min(d), 0) THEN 'lower' ELSE 'higher' END AS direction FROM c GROUP BY segment")
def _(s, d):
    return M.ks_two_sample(people(s, d), "x", "side", "segment")


@query("m9_enrichment_counts", "WITH k AS (SELECT hpc_id, flag, count(*) AS k FROM tiles GROUP BY ALL) SELECT hpc_id, flag, k AS hits, CAST(sum(k) OVER (PARTITION BY hpc_id) AS BIGINT) AS drawn, CAST(sum(k) OVER (PARTITION BY flag) AS BIGINT) AS good, CAST(sum(k) OVER () AS BIGINT) AS whole FROM k")
def _(s, d):
    return M.enrichment(B.tiles(s, d), "hpc_id", "flag").drop("p")


CHOOSE = "lgamma({a} + 1.0) - lgamma({b} + 1.0) - lgamma({a} - {b} + 1.0)"


@query("m9_hypergeometric", f"""WITH k AS (SELECT hpc_id, flag, count(*) AS k FROM tiles GROUP BY ALL), h AS (SELECT hpc_id, flag, k AS hits, CAST(sum(k) OVER (PARTITION BY hpc_id) AS BIGINT) AS drawn, CAST(sum(k) OVER (PARTITION BY flag) AS BIGINT) AS good, CAST(sum(k) OVER () AS BIGINT) AS whole FROM k),
    i AS (SELECT *, unnest(range(hits, least(drawn, good) + 1)) AS i FROM h) SELECT hpc_id, flag, hits, drawn, good, whole, round(least(1.0::DOUBLE, sum(exp({CHOOSE.format(a='good', b='i')} + {CHOOSE.format(a='(whole - good)', b='(drawn - i)')} - ({CHOOSE.format(a='whole', b='drawn')})))), 9) AS p FROM i WHERE drawn - i <= whole - good GROUP BY ALL""")
def _(s, d):
    return M.enrichment(B.tiles(s, d), "hpc_id", "flag")


@query("m10_mann_whitney", f"WITH {PEOPLE}, r AS (SELECT *, rank() OVER (PARTITION BY segment ORDER BY x) + (count(*) OVER (PARTITION BY segment, x) - 1) / 2.0::DOUBLE AS r FROM people), g AS (SELECT segment, count(*) FILTER (WHERE side) AS n1, count(*) FILTER (WHERE NOT side) AS n2, sum(CASE WHEN side THEN r ELSE 0 END) AS w, avg(x) FILTER (WHERE side) AS ma, avg(x) FILTER (WHERE NOT side) AS mb FROM r GROUP BY segment) SELECT segment, n1, n2, round(w - n1 * (n1 + 1) / 2.0::DOUBLE, 3) AS u, round((w - n1 * (n1 + 1) / 2.0::DOUBLE - n1 * n2 / 2.0::DOUBLE) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0::DOUBLE), 6) AS z, round(log2((ma + 1e-9) / (mb + 1e-9)), 6) AS log2fc FROM g")
def _(s, d):
    return M.mann_whitney(people(s, d), "x", "side", "segment")


@query("m11_kruskal", f"WITH {PEOPLE}, r AS (SELECT segment, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS r FROM people), g AS (SELECT segment, count(*) AS n, sum(r) AS r FROM r GROUP BY segment) SELECT round(12.0::DOUBLE / (sum(n) * (sum(n) + 1)) * sum(r * r / n) - 3 * (sum(n) + 1), 6) AS h, count(*) AS groups FROM g")
def _(s, d):
    return M.kruskal(people(s, d), "y", "segment")


@query("m11_anova", f"WITH {PEOPLE}, g AS (SELECT segment, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM people GROUP BY segment), w AS (SELECT sum(n * m) / sum(n) AS grand FROM g) SELECT round((sum(n * (m - grand) ** 2) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS f, count(*) AS groups FROM g, w")
def _(s, d):
    return M.anova(people(s, d), "x", "segment")


@query("m11_t_test", f"WITH {PEOPLE} SELECT round((avg(x) FILTER (WHERE side) - avg(x) FILTER (WHERE NOT side)) / sqrt(var_samp(x) FILTER (WHERE side) / count(*) FILTER (WHERE side) + var_samp(x) FILTER (WHERE NOT side) / count(*) FILTER (WHERE NOT side)), 6) AS t, count(*) FILTER (WHERE side) AS n1, count(*) FILTER (WHERE NOT side) AS n2 FROM people")
def _(s, d):
    return M.t_test(people(s, d), "x", "side")


@query("m17_kaplan_meier", f"WITH {PEOPLE}, t AS (SELECT side, time, CAST(sum(event) AS BIGINT) AS events, count(*) AS n FROM people GROUP BY ALL), r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY side ORDER BY time DESC) AS BIGINT) AS at_risk FROM t) SELECT side, time, events, at_risk, round(CASE WHEN max(CASE WHEN events = at_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0.0 ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk::DOUBLE) ELSE 0 END) OVER w) END, 6) AS survival FROM r WINDOW w AS (PARTITION BY side ORDER BY time)")
def _(s, d):
    return M.kaplan_meier(people(s, d), "time", "event", "side")


@query("m17_log_rank", f"WITH {PEOPLE}, t AS (SELECT time, sum(event) AS d, sum(CASE WHEN side THEN event ELSE 0 END) AS d1, count(*) AS c, count(*) FILTER (WHERE side) AS c1 FROM people GROUP BY time), r AS (SELECT *, sum(c) OVER (ORDER BY time DESC)::DOUBLE AS n, sum(c1) OVER (ORDER BY time DESC)::DOUBLE AS n1 FROM t) SELECT CAST(sum(d1) AS BIGINT) AS observed, round(sum(d * n1 / n), 6) AS expected, round((sum(d1) - sum(d * n1 / n)) ** 2 / sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END), 6) AS chi2 FROM r")
def _(s, d):
    return M.log_rank(people(s, d), "time", "event", "side")


@query("m18_cox")
def _(s, d):
    p = people(s, d)
    return M.cox(p, "time", "event", ["x", "y"], F.pmod(F.col("id"), F.lit(5))).select("fold", "feature", F.round("coef", 6).alias("coef"), F.round("se", 6).alias("se"))


@query("m18_c_index", f"WITH {PEOPLE}, g AS (SELECT time, y, count(*) AS n, sum(event) AS e FROM people GROUP BY time, y) SELECT round(sum(a.e * b.n * CASE WHEN a.y > b.y THEN 1.0 WHEN a.y = b.y THEN 0.5 ELSE 0.0 END)::DOUBLE / sum(a.e * b.n)::DOUBLE, 6) AS c_index, CAST(sum(a.e * b.n) AS BIGINT) AS pairs FROM g a JOIN g b ON a.time < b.time")
def _(s, d):
    return M.c_index(people(s, d), "time", "event", "y", "id")


@query("m19_risk_split", f"WITH {PEOPLE}, c AS (SELECT quantile_cont(x, 0.33) AS a, quantile_cont(x, 0.66) AS b FROM people WHERE id % 2 = 0) SELECT segment, CASE WHEN x > b THEN 2 WHEN x > a THEN 1 ELSE 0 END AS risk_group, count(*) AS n FROM people, c GROUP BY ALL")
def _(s, d):
    return M.risk_split(people(s, d), F.col("id") % 2 == 0, "x", 0.33, 0.66).groupBy("segment", "risk_group").agg(F.count("*").alias("n"))


@query("m20_mean_ci", f"WITH {PEOPLE} SELECT side, count(*) AS n, round(avg(x), 6) AS mean, round(1.959964 * stddev_samp(x) / sqrt(count(*)), 6) AS half_width FROM people GROUP BY side")
def _(s, d):
    return M.mean_ci(people(s, d), "x", "side")


@query("m21_auc", f"WITH {PEOPLE}, r AS (SELECT event, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS r FROM people), g AS (SELECT count(*) FILTER (WHERE event = 1) AS p, count(*) FILTER (WHERE event = 0) AS n, sum(CASE WHEN event = 1 THEN r ELSE 0 END) AS w FROM r) SELECT round((w - p * (p + 1) / 2.0::DOUBLE) / (p * n), 6) AS auc, p AS positives, n AS negatives FROM g")
def _(s, d):
    return M.auc(people(s, d), "y", "event")


@query("m22_group_folds", "WITH g AS (SELECT samples, count(*) AS n FROM tiles GROUP BY samples), f AS (SELECT samples, n, (row_number() OVER (ORDER BY n DESC, samples) - 1) % 5 AS fold FROM g) SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n) AS BIGINT) AS n, count(*) AS sites FROM f GROUP BY fold")
def _(s, d):
    return M.group_folds(B.tiles(s, d), "samples", 5).groupBy("fold").agg(F.count("*").alias("n"), F.countDistinct("samples").alias("sites"))


@query("m22_stratified_folds", f"WITH {PEOPLE} SELECT segment, f AS fold, count(*) // 5 AS size FROM people, (SELECT unnest(range(5))::INTEGER AS f) GROUP BY ALL")
def _(s, d):
    f = M.stratified_folds(people(s, d).select("id", "segment"), "id", "segment", 5)
    n = f.groupBy("segment").agg(F.count("*").alias("n"))
    per = f.groupBy("segment", "fold").agg(F.count("*").alias("size")).join(n, "segment")
    return per.select("segment", "fold", F.when(F.abs(F.col("size") - F.col("n") / 5) < 1, F.floor(F.col("n") / 5)).otherwise(F.col("size")).alias("size"))
