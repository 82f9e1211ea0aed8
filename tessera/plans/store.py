"""Queries of sources, loads, guards, grids, point patterns, grading and run states."""

from pyspark.sql import functions as F

from tessera.operators import grading, guards, rollup
from tessera.operators import keys as K
from tessera.operators import profiles as P
from tessera.operators import spatial as X
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.sources import sinks, table, text


def raw(s, d):
    """Assignments as text, with defects."""
    t = B.tiles(s, d)
    bad = F.when(F.col("run") % 97 == 0, "").otherwise(F.col("slides"))
    num = F.when(F.col("run") % 89 == 0, "n/a").otherwise(F.round("vote_margin", 4).cast("string"))
    hpc = F.when(F.col("run") % 83 == 0, F.concat(F.col("hpc_id").cast("string"), F.lit(".5"))).otherwise(F.col("hpc_id").cast("string"))
    return t.select("samples", bad.alias("slides"), "tiles", num.alias("vote_margin"), F.col("neighbor_distance").cast("string").alias("neighbor_distance"), hpc.alias("leiden_2.5"))


@query("s1_read_assignments", """SELECT coalesce(CASE WHEN run % 97 = 0 THEN 'blank key' WHEN run % 89 = 0 THEN 'bad number' WHEN run % 83 = 0 THEN 'bad cluster' END, 'ok') AS problem, count(*) AS n, CAST(sum(CASE WHEN run % 83 = 0 THEN NULL ELSE hpc_id END) AS BIGINT) AS ids,
    round(sum(CASE WHEN run % 89 = 0 THEN NULL ELSE round(vote_margin, 4) END), 3) AS margins FROM tiles GROUP BY 1""")
def _(s, d):
    r = raw(s, d).withColumnRenamed("leiden_2.5", "leiden")
    p = text.parse_assignments(r)
    return p.groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"), F.sum("hpc_id").alias("ids"), F.round(F.sum("vote_margin"), 3).alias("margins"))


@query("s4_range_scan", "SELECT vec_id, label FROM embeddings WHERE vec_id >= 100 AND vec_id < 180")
def _(s, d):
    return text.row_range(table(s, d, "embeddings"), 100, 180, "vec_id").select("vec_id", "label")


@query("s6_wide_representations", "SELECT vec_id, " + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS d{i}" for i in range(64)) + " FROM embeddings")
def _(s, d):
    w = text.wide(table(s, d, "embeddings"), "embedding", 64, "vec_id")
    return w.select("vec_id", *(F.round(F.col(f"d{i}").cast("double"), 6).alias(f"d{i}") for i in range(64)))


def titles(s, t):
    return text.decode(t, B.dictionary(s).where("hpc_title is not null"), "hpc_id").select("slide_tile", "hpc_title")


@query("s7_decode_categories", "SELECT t.slide_tile, d.hpc_title FROM tiles t LEFT JOIN dictionary d ON t.hpc_id = d.hpc_id")
def _(s, d):
    return titles(s, B.tiles(s, d))


@query("s8_image_index", "SELECT slide_tile, row_number() OVER (ORDER BY slide_tile) - 1 AS image_index FROM tiles")
def _(s, d):
    return text.with_index(B.tiles(s, d).select("slide_tile"), "slide_tile")


@query("s14_slide_id_from_path", r"""SELECT page_id, regexp_extract(url, '([^/?#]+?)(\.[A-Za-z0-9]+)?/?([?#].*)?$', 1) AS slide_id FROM pages""")
def _(s, d):
    return table(s, d, "pages").select("page_id", text.slide_id_from_path(F.col("url")).alias("slide_id"))


@query("s17_clinical_recode", "SELECT c_custkey, 'LUAD-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS samples, CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'MACHINERY' THEN 'II' WHEN 'AUTOMOBILE' THEN 'III' ELSE 'IV' END AS stage FROM customer")
def _(s, d):
    seg = F.col("c_mktsegment")
    stage = F.when(seg == "BUILDING", "I").when(seg == "MACHINERY", "II").when(seg == "AUTOMOBILE", "III").otherwise("IV")
    return table(s, d, "customer").select("c_custkey", F.concat(F.lit("LUAD-"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("samples"), stage.alias("stage"))


@query("s16_force_folds", "SELECT CASE WHEN CAST(slides AS INTEGER) % 5 = 0 THEN 'test' WHEN CAST(slides AS INTEGER) % 5 = 1 THEN 'valid' ELSE 'train' END AS part, count(*) AS n FROM tiles GROUP BY 1")
def _(s, d):
    t = B.tiles(s, d)
    n = F.col("slides").cast("int") % 5
    members = t.select("slides").distinct().withColumn("part", F.when(n == 0, "test").when(n == 1, "valid").otherwise("train"))
    return t.join(members, "slides").groupBy("part").agg(F.count("*").alias("n"))


@query("k1_update_from_stage", "SELECT slide_tile, CASE WHEN run % 3 = 0 THEN (hpc_id + 7) % 71 ELSE hpc_id END AS hpc_id, samples FROM tiles")
def _(s, d):
    t = B.tiles(s, d).select("slide_tile", "hpc_id", "samples")
    stage = B.tiles(s, d).where("run % 3 = 0").select("slide_tile", ((F.col("hpc_id") + 7) % 71).alias("hpc_id"))
    return sinks.update_from(t, stage, "slide_tile", ["hpc_id"])


@query("k4_replace_profiles", "SELECT slides, hpc_id, n FROM proportion WHERE CAST(slides AS INTEGER) % 10 <> 3 UNION ALL SELECT slides, 0, count(*) FROM tiles WHERE CAST(slides AS INTEGER) % 10 = 3 GROUP BY slides")
def _(s, d):
    t = B.tiles(s, d)
    old = P.counts_by(t, "slides", "hpc_id")
    new = t.where(F.col("slides").cast("int") % 10 == 3).groupBy("slides").agg(F.lit(0).alias("hpc_id"), F.count("*").alias("n"))
    return sinks.replace_group(old, new, ["slides"])


@query("k6_register_dataset", "SELECT slides, samples AS dataset FROM tiles WHERE CAST(slides AS INTEGER) <= 50 GROUP BY ALL UNION SELECT DISTINCT slides, 'new' FROM tiles WHERE CAST(slides AS INTEGER) > 50")
def _(s, d):
    t = B.tiles(s, d).select("slides", F.col("samples").alias("dataset")).distinct()
    old, new = t.where(F.col("slides").cast("int") <= 50), t.where(F.col("slides").cast("int") > 50).withColumn("dataset", F.lit("new"))
    return sinks.register(old, new, "slides", "dataset", "new")


@query("k8_sweep_stale", "SELECT name FROM (SELECT 'stage_' || (1700000000 + o_orderkey * 60) AS name FROM orders) WHERE CAST(regexp_extract(name, '_([0-9]{9,10})$', 1) AS BIGINT) < 1700000000 + 200000 - 86400")
def _(s, d):
    names = table(s, d, "orders").select(F.concat(F.lit("stage_"), (F.lit(1700000000) + F.col("o_orderkey") * 60).cast("string")).alias("name"))
    return sinks.stale(names, 1700000000 + 200000)


@query("k10_shard_check", """WITH r AS (SELECT o_custkey AS dataset, o_orderkey AS lo, o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 40 END AS hi FROM orders), b AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY dataset ORDER BY lo, hi), 0) AS before FROM r)
    SELECT CASE WHEN lo > before THEN 'gap' ELSE 'overlap' END AS kind, count(*) AS n FROM b WHERE lo <> before GROUP BY 1""")
def _(s, d):
    key = F.col("o_orderkey")
    shards = table(s, d, "orders").select(F.col("o_custkey").alias("dataset"), key.alias("lo"), (key + F.when(key % 3 == 0, 1).otherwise(40)).alias("hi"))
    return rollup.shard_breaks(shards).groupBy("kind").agg(F.count("*").alias("n"))


@query("k12_upsert", "SELECT coalesce(a.k, b.k) AS k, coalesce(b.v, a.v) AS v FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'new' END AS v FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return sinks.upsert(c.where("k % 3 <> 0"), c.where("k % 2 = 0").withColumn("v", F.when(F.col("k") % 4 != 0, "new")), "k")


@query("k13_insert_once", "SELECT user_id AS k FROM events WHERE event_id % 2 = 0 GROUP BY user_id UNION SELECT user_id FROM events WHERE event_id % 3 = 0")
def _(s, d):
    e = table(s, d, "events")
    k = F.col("user_id").alias("k")
    return sinks.insert_once(e.where("event_id % 2 = 0").select(k).distinct(), e.where("event_id % 3 = 0").select(k), ["k"])


@query("k9_pending_ranges", "SELECT i * 1000 AS lo, i * 1000 + 1000 AS hi FROM range(60) r(i) WHERE i % 4 <> 1")
def _(s, d):
    r = s.range(60).select((F.col("id") * 1000).alias("lo"), (F.col("id") * 1000 + 1000).alias("hi"))
    return sinks.pending_ranges(r, r.where("lo / 1000 % 4 = 1").withColumn("identity", F.lit("a")), "a")


@query("g1_violations", "SELECT 'blank' AS rule, count(*) AS n FROM tiles WHERE run % 97 = 0 UNION ALL SELECT 'number', count(*) FROM tiles WHERE run % 89 = 0 UNION ALL SELECT 'integral', count(*) FROM tiles WHERE run % 83 = 0")
def _(s, d):
    r = raw(s, d).withColumnRenamed("leiden_2.5", "leiden")
    one = lambda name, df: df.agg(F.lit(name).alias("rule"), F.count("*").alias("n"))
    return one("blank", guards.blank_keys(r, "samples", "slides")).unionAll(one("number", guards.not_numeric(r, "vote_margin"))).unionAll(one("integral", guards.not_integral(r, "leiden")))


@query("g2_duplicate_keys", "SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return guards.duplicate_keys(table(s, d, "lineitem"), "l_suppkey", "l_orderkey")


@query("g6_sums_to_one", "SELECT slides FROM (SELECT slides, sum(CASE WHEN hpc_id = 3 THEN 0 ELSE proportion END) AS t FROM proportion GROUP BY slides) WHERE abs(t - 1) > 0.01")
def _(s, d):
    p = P.proportion(B.tiles(s, d)).withColumn("proportion", F.when(F.col("hpc_id") == 3, 0.0).otherwise(F.col("proportion")))
    return guards.not_summing_to_one(p, "slides").select("slides")


@query("g7_orphans", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def _(s, d):
    return guards.orphans(table(s, d, "orders").select(F.col("o_custkey")), table(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey").distinct()


@query("g16_sample_conflicts", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def _(s, d):
    return guards.conflicting(table(s, d, "lineitem"), "l_orderkey", "l_suppkey")


@query("j7_one_to_one", "SELECT s_suppkey, s_nationkey, n_tiles FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n_tiles FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1) ON s_suppkey = l_suppkey")
def _(s, d):
    n = table(s, d, "lineitem").where("l_suppkey % 2 = 0").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n_tiles"))
    return guards.one_to_one(table(s, d, "supplier").select("s_suppkey", "s_nationkey"), n, ["s_suppkey"])


HALVES = "(SELECT unnest([1, 0, 1, 1]) AS dx, unnest([0, 1, 1, -1]) AS dy)"
PAIRS = f"grid AS (SELECT t.slides AS slide, t.hpc_id AS a, u.hpc_id AS b, t.slide_tile AS ta, u.slide_tile AS tb FROM first_tiles t, {HALVES} o, first_tiles u WHERE u.slides = t.slides AND u.grid_col = t.grid_col + o.dx AND u.grid_row = t.grid_row + o.dy)"


def grid(s, d, name=None):
    return X.grid_pairs(B.tiles(s, d), name=name, first="slide_tile")


@query("a32_edge_counts", f"WITH {PAIRS} SELECT slide, least(a, b) AS a, greatest(a, b) AS b, count(*) AS edges FROM grid GROUP BY ALL")
def _(s, d):
    return X.edge_counts(grid(s, d))


@query("a32_touching", f"WITH {PAIRS} SELECT slide, label, other, count(DISTINCT tile) AS tiles FROM (SELECT slide, a AS label, b AS other, ta AS tile FROM grid WHERE a <> b UNION ALL SELECT slide, b, a, tb FROM grid WHERE a <> b) GROUP BY ALL")
def _(s, d):
    return X.touching_tiles(B.tiles(s, d), first="slide_tile")


@query("t9_dominant_pair", f"WITH {PAIRS}, e AS (SELECT CASE WHEN a = 40 THEN b ELSE a END AS other, count(*) AS edges FROM grid WHERE a <> b AND (a = 40 OR b = 40) GROUP BY 1) SELECT other, edges FROM e ORDER BY edges DESC, other LIMIT 1")
def _(s, d):
    p = grid(s, d).where("a <> b and (a = 40 or b = 40)")
    return p.groupBy(F.when(F.col("a") == 40, F.col("b")).otherwise(F.col("a")).alias("other")).agg(F.count("*").alias("edges")).orderBy(F.desc("edges"), "other").limit(1)


LETTERS = ", ".join(f"max(CASE WHEN u.grid_col = t.grid_col + ({dx}) AND u.grid_row = t.grid_row + ({dy}) THEN u.hpc_id END) AS \"{k}\"" for k, (dx, dy) in X.LETTERS.items())


OFFSETS = ", ".join(f"('{k}', {dx}, {dy})" for k, (dx, dy) in X.LETTERS.items())
BY_LETTER = ", ".join(f"max(u.hpc_id) FILTER (WHERE o.k = '{k}') AS \"{k}\"" for k in X.LETTERS)


@query("j20_letter_neighbours", f"SELECT t.slide_tile AS tile, {BY_LETTER} FROM first_tiles t CROSS JOIN (VALUES {OFFSETS}) o(k, dx, dy) LEFT JOIN first_tiles u ON u.slides = t.slides AND u.grid_col = t.grid_col + o.dx AND u.grid_row = t.grid_row + o.dy GROUP BY t.slide_tile")
def _(s, d):
    return X.letter_neighbours(B.tiles(s, d), first="slide_tile")


@query("a35_interactions", f"WITH {PAIRS}, n AS (SELECT slide, a, b, count(*) AS n FROM (SELECT slide, a, b FROM grid UNION ALL SELECT slide, b, a FROM grid) GROUP BY ALL) SELECT slide, a, b, n, round(n / sum(n) OVER (PARTITION BY slide, a)::DOUBLE, 6) AS share FROM n")
def _(s, d):
    return X.interactions(grid(s, d), "label").withColumn("share", F.round("share", 6))


NEAR = "np AS (SELECT a.core, a.cell AS a, b.cell AS b, a.phenotype AS pa, b.phenotype AS pb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM cells a JOIN cells b ON a.core = b.core AND a.cell <> b.cell AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 625)"


def near(s, d, r=25.0):
    c = B.cells(s, d)
    return X.radius_pairs(c, c, r)


@query("j21_radius_join", f"WITH {NEAR} SELECT core, a, b, round(d, 6) AS d FROM np")
def _(s, d):
    return near(s, d).select("core", "a", "b", F.round("d", 6).alias("d"))


@query("j22_second_nearest", f"WITH {NEAR} SELECT core, a, b, round(d, 6) AS d FROM np QUALIFY row_number() OVER (PARTITION BY core, a ORDER BY d, b) = 2")
def _(s, d):
    return X.kth_nearest(near(s, d), 2).withColumn("d", F.round("d", 6))


@query("a45_cell_density", f"WITH {NEAR}, n AS (SELECT core, a, pa, min(d) AS d FROM np GROUP BY ALL) SELECT pa, round(1 / nullif(avg(d), 0), 6) AS density, count(*) AS n FROM n GROUP BY pa")
def _(s, d):
    return X.density(near(s, d))


@query("m14_layered_neighbours", f"WITH {NEAR} SELECT core, pa, pb, count(*) FILTER (WHERE d <= 5) AS within_5, count(*) FILTER (WHERE d <= 10) AS within_10, count(*) FILTER (WHERE d <= 25) AS within_25 FROM np GROUP BY ALL")
def _(s, d):
    return X.layers(near(s, d), (5, 10, 25))


@query("j23_tessellation", "SELECT core, CAST(floor(x / 20.0) AS INTEGER) AS tx, CAST(floor(y / 20.0) AS INTEGER) AS ty, phenotype, count(*) AS n FROM cells GROUP BY ALL")
def _(s, d):
    return X.tessellation(B.cells(s, d), 20.0)


@query("j24_mean_distance", """WITH p AS (SELECT DISTINCT core, x, y, phenotype FROM cells), t AS (SELECT DISTINCT phenotype FROM cells ORDER BY 1 LIMIT 2), k AS (SELECT min(phenotype) AS a, max(phenotype) AS b FROM t),
    dd AS (SELECT DISTINCT m.core, sqrt((m.x - n.x) * (m.x - n.x) + (m.y - n.y) * (m.y - n.y)) AS d FROM k, p m JOIN p n ON m.core = n.core WHERE m.phenotype = k.a AND n.phenotype = k.b) SELECT core, round(avg(d), 6) AS mean_distance FROM dd WHERE d > 0 GROUP BY core""")
def _(s, d):
    c = B.cells(s, d)
    a, b = (r.phenotype for r in c.select("phenotype").distinct().orderBy("phenotype").limit(2).collect())
    return X.mean_distance(c, a, b)


@query("p24_buffer", "WITH b AS (SELECT core, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM cells GROUP BY core) SELECT core, cell, x, y, phenotype FROM cells JOIN b USING (core) WHERE x > x0 + 10 AND x < x1 - 10 AND y > y0 + 10 AND y < y1 - 10")
def _(s, d):
    return X.buffer(B.cells(s, d), 10)


@query("m16_q_statistic", """WITH b AS (SELECT core, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(*) AS al FROM cells GROUP BY core), n AS (SELECT core, al, coalesce(least(floor((x - x0) * 5 / nullif(x1 - x0, 0)::DOUBLE), 4), 0) AS i, coalesce(least(floor((y - y0) * 5 / nullif(y1 - y0, 0)::DOUBLE), 4), 0) AS j, count(*) AS n FROM cells JOIN b USING (core) GROUP BY ALL)
    SELECT core, round(sum((n - al / 25.0::DOUBLE) ** 2 / (al / 25.0::DOUBLE)) + (25 - count(*)) * (al / 25.0::DOUBLE), 6) AS q FROM n GROUP BY core, al""")
def _(s, d):
    return X.q_statistic(B.cells(s, d), 5)


@query("m13_dbscan_noise", """WITH p AS (SELECT a.core, a.cell AS a, b.cell AS b FROM cells a JOIN cells b ON a.core = b.core AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 100), k AS (SELECT core, a, count(*) >= 4 AS dense FROM p GROUP BY core, a),
    r AS (SELECT p.core, p.a, bool_or(k.dense) AS reached FROM p JOIN k ON p.core = k.core AND p.b = k.a GROUP BY p.core, p.a) SELECT core, count(*) AS n, count(*) FILTER (WHERE NOT reached) AS noise FROM r GROUP BY core""")
def _(s, d):
    return X.dbscan_noise(B.cells(s, d), 10.0, 4)


@query("r19_coarse_grid", "SELECT slides, CAST(floor(grid_col / 4.0) AS INTEGER) AS grid_col, CAST(floor(grid_row / 4.0) AS INTEGER) AS grid_row, count(*) AS n_tiles, CAST(sum(hpc_id) AS BIGINT) AS hpc_id FROM tiles GROUP BY ALL")
def _(s, d):
    return X.coarse(B.tiles(s, d), 4, "grid_col", "grid_row", "hpc_id")


PX = "SELECT CAST(s_suppkey AS VARCHAR) AS slide_id, n_name AS sample, " + ", ".join(f"CAST((s_suppkey * {i * 7 + 3} + {i}) % 50 * 100 AS BIGINT) AS {p}_px" for i, p in enumerate(K.PATTERNS)) + " FROM supplier JOIN nation ON s_nationkey = n_nationkey"


def pixels(s, d):
    j = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    px = [((F.col("s_suppkey") * (i * 7 + 3) + i) % 50 * 100).cast("long").alias(f"{p}_px") for i, p in enumerate(K.PATTERNS)]
    out = j.select(F.col("s_suppkey").cast("string").alias("slide_id"), F.col("n_name").alias("sample"), *px)
    return out.withColumn("pattern_pixels", sum((F.col(f"{p}_px") for p in K.PATTERNS), F.lit(0)))


TOTAL = " + ".join(f"{p}_px" for p in K.PATTERNS)


@query("a16_slide_proportions", f"SELECT slide_id, sample, {', '.join(f'round({p}_px / nullif({TOTAL}, 0)::DOUBLE, 6) AS {p}' for p in K.PATTERNS)}, true AS adds_up FROM ({PX})")
def _(s, d):
    return grading.slide_proportions(pixels(s, d))


SUMS = ", ".join(f"sum({p}_px) AS {p}" for p in K.PATTERNS)
LONG = " UNION ALL ".join(f"SELECT sample, {i} AS o, '{p}' AS p, {p} AS v, n_slides FROM g" for i, p in enumerate(K.PATTERNS))


@query("a15_tumour_grade", f"""WITH g AS (SELECT sample, count(*) AS n_slides, {SUMS} FROM ({PX}) GROUP BY sample), l AS ({LONG}), m AS (SELECT sample, max(v) AS top, sum(v) AS total, max(n_slides) AS n_slides, sum(CASE WHEN p IN ('cribriform', 'micropapillary', 'solid') THEN v ELSE 0 END) AS high FROM l GROUP BY sample),
    r AS (SELECT m.sample, m.n_slides, first(p ORDER BY o) AS predominant, string_agg(p, ',' ORDER BY o) AS ties, any_value(high) / any_value(total)::DOUBLE AS h FROM l JOIN m ON l.sample = m.sample AND l.v = m.top GROUP BY ALL)
    SELECT sample, n_slides, predominant, ties, round(h, 6) AS high_share, CASE WHEN h >= 0.2 THEN 3 WHEN predominant = 'lepidic' THEN 1 WHEN predominant IN ('acinar', 'papillary') THEN 2 ELSE 3 END AS grade FROM r""")
def _(s, d):
    return grading.tumour_grade(pixels(s, d))


SLIDE_LIST = "l AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN '  ' ELSE CAST(s_suppkey AS VARCHAR) END AS slide_id, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS samples, CASE s_suppkey % 4 WHEN 0 THEN ' True' WHEN 1 THEN 'no' WHEN 2 THEN 'yes' ELSE 'unverified' END AS is_tumour FROM supplier)"


@query("g13_slide_list", f"WITH {SLIDE_LIST} SELECT * FROM (SELECT s_suppkey, CASE WHEN trim(slide_id) = '' THEN 'blank slide' WHEN lower(trim(is_tumour)) NOT IN ('true', 'yes') THEN 'not tumour' WHEN samples = '' THEN 'blank sample' END AS problem FROM l) WHERE problem IS NOT NULL")
def _(s, d):
    k = F.col("s_suppkey")
    said = F.when(k % 4 == 0, " True").when(k % 4 == 1, "no").when(k % 4 == 2, "yes").otherwise("unverified")
    slides = table(s, d, "supplier").select(k, F.when(k % 7 == 0, "  ").otherwise(k.cast("string")).alias("slide_id"), F.when(k % 5 == 0, "").otherwise(F.col("s_name")).alias("samples"), said.alias("is_tumour"))
    return guards.slide_list_problems(slides).select("s_suppkey", "problem")


@query("a40_dataset_rollup", """SELECT dataset, count(*) AS n_runs, CASE WHEN bool_or(state = 'running') THEN 'running' WHEN bool_or(state = 'pending') THEN 'pending' ELSE 'complete' END AS state, first(submission_id ORDER BY submitted_at DESC, submission_id DESC) AS latest_run,
    first(submission_id ORDER BY submitted_at DESC, submission_id DESC) FILTER (WHERE state = 'complete') AS latest_artefact, round(max(size) FILTER (WHERE state = 'complete'), 2) AS largest,
    CASE WHEN bool_or(state IN ('running', 'pending')) THEN 'wait' WHEN count(*) FILTER (WHERE state = 'complete') = 0 THEN 'rerun' ELSE 'load' END AS next_action FROM runs GROUP BY dataset""")
def _(s, d):
    return rollup.datasets(B.runs(s, d))


@query("a41_coarse_state", "SELECT dataset, CASE WHEN bool_or(state = 'running') THEN 'running' WHEN bool_or(state = 'pending') THEN 'pending' WHEN bool_or(state = 'failed') THEN 'failed' ELSE 'complete' END AS state FROM runs GROUP BY dataset")
def _(s, d):
    return B.runs(s, d).groupBy("dataset").agg(rollup.coarse_state().alias("state"))


@query("a42_missing_slides", """SELECT CASE WHEN l.k IS NULL THEN 'never' WHEN l.n IS NULL THEN 'corrupt' WHEN l.n = 0 THEN 'zero' ELSE 'complete' END AS state, count(*) AS n FROM supplier LEFT JOIN (SELECT l_suppkey AS k, CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 11 = 0 THEN 0 ELSE count(*) END AS n FROM lineitem WHERE l_suppkey % 7 <> 0 GROUP BY l_suppkey) l ON s_suppkey = l.k GROUP BY 1""")
def _(s, d):
    k = F.col("s_suppkey")
    n = table(s, d, "lineitem").where("l_suppkey % 7 <> 0").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    n = n.withColumn("n", F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, 0).otherwise(F.col("n")))
    return rollup.missing(table(s, d, "supplier").select("s_suppkey"), n, "s_suppkey", "n").groupBy("state").agg(F.count("*").alias("n"))
