"""Queries of questions, remaining joins and derived forms."""

from pyspark.sql import functions as F

from tessera.plans import bindings as B
from tessera.plans import nlq
from tessera.plans.registry import query
from tessera.sources import table
from tessera.streaming.classify import windowed_events


def ask(question):
    return lambda s, d: nlq.execute(nlq.plan(question), B.tiles(s, d), B.dictionary(s), B.survival(s))


query("q8_count_answer", """SELECT count(*) AS n, count(*) FILTER (WHERE malignant) AS n_true, count(*) FILTER (WHERE NOT malignant) AS n_false, count(*) FILTER (WHERE malignant IS NULL) AS n_null, round(100.0::DOUBLE * count(*) FILTER (WHERE malignant) / count(*), 2) AS pct_true,
    round(100.0::DOUBLE * count(*) FILTER (WHERE NOT malignant) / count(*), 2) AS pct_false, round(100.0::DOUBLE * count(*) FILTER (WHERE malignant IS NULL) / count(*), 2) AS pct_null FROM dictionary""")(ask("How many malignant clusters are there?"))
query("q10_slide_answer", "SELECT slides, hpc_id, n, proportion FROM proportion WHERE slides = '12' ORDER BY n DESC, hpc_id LIMIT 5")(ask("what are the top clusters of slide 12?"))
query("q10_slide_coverage", "SELECT slides, round(100.0::DOUBLE * sum(CASE WHEN malignant THEN n ELSE 0 END) / nullif(sum(n), 0), 2) AS pct_malignant, round(100.0::DOUBLE * sum(CASE WHEN NOT malignant THEN n ELSE 0 END) / nullif(sum(n), 0), 2) AS pct_other FROM proportion LEFT JOIN dictionary USING (hpc_id) WHERE slides = '12' GROUP BY slides")(ask("tumour coverage of wsi twelve, slide 12"))
query("q12_hpc_answer", "SELECT d.*, t.n_tiles, t.n_slides FROM dictionary d LEFT JOIN (SELECT hpc_id, count(*) AS n_tiles, count(DISTINCT slides) AS n_slides FROM tiles GROUP BY hpc_id) t ON d.hpc_id = t.hpc_id WHERE d.hpc_id IN (32, 40)")(ask("Hi, describe cluster thirty two and 40"))
query("q13_survival_answer", "SELECT hpc_id, coef, p, round(-log2(greatest(p, 1e-300)), 4) AS log2_p FROM survival WHERE hpc_id = 7")(ask("What is the survival risk of HPC seven?"))
query("q13_survival_top", "SELECT hpc_id, coef, p, round(-log2(greatest(p, 1e-300)), 4) AS log2_p FROM survival WHERE p IS NOT NULL ORDER BY p, hpc_id LIMIT 10")(ask("which clusters matter for survival"))
query("q14_adjacency_answer", """WITH g AS (SELECT t.hpc_id AS a, u.hpc_id AS b FROM first_tiles t, (SELECT unnest([1, 0, 1, 1]) AS dx, unnest([0, 1, 1, -1]) AS dy) o, first_tiles u WHERE u.slides = t.slides AND u.grid_col = t.grid_col + o.dx AND u.grid_row = t.grid_row + o.dy AND t.slides = '9' AND (t.hpc_id = 5 OR u.hpc_id = 5))
    SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS edges FROM g GROUP BY ALL""")(ask("which clusters are adjacent to HPC 5 on slide 9"))


@query("q4_plans", None)
def _(s, d):
    asked = ["Hello!", "Which slides have HPC 40?", "how many tiles", "highlight tumour of slide 7", "risk of cluster forty-one"]
    return s.createDataFrame([(q, nlq.plan(q).to_json()) for q in asked], "question string, plan string")


# 'cluster 1' is in the first text as wholly as 'cluster 12' is: of equal scores the smallest id is taken, as in the reference
@query("q3_title_match", "SELECT q, (SELECT min(hpc_id) FROM dictionary WHERE contains(q, hpc_title)) AS hpc_id FROM (VALUES ('about cluster 12 please'), ('cluster 70'), ('zzz')) v(q)")
def _(s, d):
    q = s.createDataFrame([("about cluster 12 please",), ("cluster 70",), ("zzz",)], "q string")
    return nlq.title_matches(q, B.dictionary(s))


@query("q18_tile_at_point", "SELECT slide_tile FROM tiles WHERE slides = '4' AND grid_col = CAST(floor(35000 / 1600.0) AS INTEGER) AND grid_row = CAST(floor(21000 / 1600.0) AS INTEGER)")
def _(s, d):
    from tessera.operators.keys import grid_xy

    x, y = grid_xy(F.lit(35000), F.lit(21000), F.lit(1600.0))
    return B.tiles(s, d).where((F.col("slides") == "4") & (F.col("grid_col") == x) & (F.col("grid_row") == y)).select("slide_tile")


@query("q16_dataset_listing", "SELECT state, count(*) AS n FROM (SELECT dataset, CASE WHEN bool_or(state = 'running') THEN 'running' WHEN bool_or(state = 'pending') THEN 'pending' ELSE 'complete' END AS state FROM runs GROUP BY dataset) GROUP BY state")
def _(s, d):
    from tessera.operators.rollup import datasets

    return datasets(B.runs(s, d)).groupBy("state").agg(F.count("*").alias("n"))


@query("j12_ranking_preview", "SELECT p.slides, p.n, s.total FROM proportion p JOIN (SELECT slides, CAST(sum(n) AS BIGINT) AS total FROM proportion GROUP BY slides) s USING (slides) WHERE p.hpc_id = 40 ORDER BY p.n DESC, p.slides LIMIT 10")
def _(s, d):
    t = B.tiles(s, d)
    n = t.where("hpc_id = 40").groupBy("slides").agg(F.count("*").alias("n"))
    return n.join(t.groupBy("slides").agg(F.count("*").alias("total")), "slides").orderBy(F.desc("n"), "slides").limit(10)


@query("j14_embedding_label_keys", "SELECT count(*) FILTER (WHERE e.k IS NOT NULL AND l.k IS NOT NULL) AS both_sides, count(*) FILTER (WHERE l.k IS NULL) AS only_embedding, count(*) FILTER (WHERE e.k IS NULL) AS only_label FROM (SELECT DISTINCT vec_id AS k FROM embeddings) e FULL JOIN (SELECT DISTINCT doc_id AS k FROM labels) l ON e.k = l.k")
def _(s, d):
    e = table(s, d, "embeddings").select(F.col("vec_id").alias("k"), F.lit(1).alias("e")).dropDuplicates(["k"])
    j = e.join(table(s, d, "labels").select(F.col("doc_id").alias("k"), F.lit(1).alias("l")).dropDuplicates(["k"]), "k", "full_outer")
    return j.agg(F.count_if(F.col("e").isNotNull() & F.col("l").isNotNull()).alias("both_sides"), F.count_if(F.col("l").isNull()).alias("only_embedding"), F.count_if(F.col("e").isNull()).alias("only_label"))


@query("j28_tables_of_a_cluster", "SELECT * FROM (SELECT 'proportion' AS source, slides AS k FROM proportion WHERE hpc_id = 40 ORDER BY k LIMIT 5) UNION ALL SELECT * FROM (SELECT 'survival', CAST(hpc_id AS VARCHAR) FROM survival WHERE hpc_id = 40 LIMIT 5)")
def _(s, d):
    views = {"proportion": (B.tiles(s, d).select("slides", "hpc_id").distinct(), "slides"), "survival": (B.survival(s), "hpc_id")}
    out = None
    for name, (df, key) in views.items():
        one = df.where("hpc_id = 40").select(F.lit(name).alias("source"), F.col(key).cast("string").alias("k")).orderBy("k").limit(5)
        out = one if out is None else out.unionAll(one)
    return out


@query("j31_column_pairs", "SELECT a, b FROM (SELECT unnest(['x', 'y', 'z']) AS a), (SELECT unnest(['x', 'y', 'z']) AS b)")
def _(s, d):
    names = s.createDataFrame([("x",), ("y",), ("z",)], "a string")
    return names.crossJoin(names.withColumnRenamed("a", "b"))  # names of columns


@query("r2_interaction_rows", "SELECT a.flag AS a, b.flag AS b, a.n + b.n AS n FROM (SELECT flag, count(*) AS n FROM tiles GROUP BY flag) a JOIN (SELECT flag, count(*) AS n FROM tiles GROUP BY flag) b ON a.flag < b.flag")
def _(s, d):
    n = B.tiles(s, d).groupBy("flag").agg(F.count("*").alias("n"))
    pairs = n.select(F.col("flag").alias("a"), F.col("n").alias("na")).join(n.select(F.col("flag").alias("b"), F.col("n").alias("nb")), F.col("a") < F.col("b"))
    return pairs.select("a", "b", (F.col("na") + F.col("nb")).alias("n"))


@query("r4_sample_representation", "SELECT slides, count(*) AS n, arg_min(flag, slide_tile) AS label FROM tiles GROUP BY slides HAVING count(*) >= 550")
def _(s, d):
    return B.tiles(s, d).groupBy("slides").agg(F.count("*").alias("n"), F.min_by("flag", "slide_tile").alias("label")).where("n >= 550")


@query("r18_cell_pivot", "SELECT core, count(*) FILTER (WHERE phenotype = 'click') AS click, count(*) FILTER (WHERE phenotype = 'view') AS view, count(*) AS total FROM cells GROUP BY core")
def _(s, d):
    c = B.cells(s, d)
    return c.groupBy("core").agg(F.count_if(F.col("phenotype") == "click").alias("click"), F.count_if(F.col("phenotype") == "view").alias("view"), F.count("*").alias("total"))


@query("r24_unwritable_ids", "SELECT count(*) AS n, min(CAST(p_retailprice AS DOUBLE)) AS example FROM part WHERE p_retailprice <> round(p_retailprice)")
def _(s, d):
    from tessera.operators.guards import not_integral

    return not_integral(table(s, d, "part"), "p_retailprice").agg(F.count("*").alias("n"), F.min("p_retailprice").alias("example"))


def next_ids(s, d, customers):
    from tessera.sources.text import with_index

    top = table(s, d, "orders").agg(F.max("o_orderkey").alias("top"))
    new = with_index(customers.select("c_custkey"), "c_custkey")
    return new.crossJoin(top).select("c_custkey", (F.col("top") + F.col("image_index") + 1).alias("id"))  # one row


@query("r25_next_ids", "SELECT c_custkey, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS id FROM customer")
def _(s, d):
    return next_ids(s, d, table(s, d, "customer"))


@query("r27_diagnose_join", "SELECT count(*) AS n, count(*) FILTER (WHERE slide_tile IS NULL) AS null_keys, count(DISTINCT samples) AS samples, count(*) FILTER (WHERE run % 4 <> 0) AS matched FROM (SELECT * FROM tiles ORDER BY slide_tile LIMIT 1000)")
def _(s, d):
    t = B.tiles(s, d)
    first = t.orderBy("slide_tile").limit(1000)
    there = t.where("run % 4 <> 0").select("slide_tile", F.lit(1).alias("hit")).distinct()
    return first.join(there, "slide_tile", "left").agg(F.count("*").alias("n"), F.count_if(F.col("slide_tile").isNull()).alias("null_keys"), F.countDistinct("samples").alias("samples"), F.count("hit").alias("matched"))


@query("a39_supercluster_accuracy", "WITH t AS (SELECT hpc_id, (hpc_id * 7 + run) % 71 AS pred FROM tiles) SELECT hpc_id // 10 AS grp, count(*) AS n, count(*) FILTER (WHERE pred = hpc_id) AS right_hpc, count(*) FILTER (WHERE pred // 10 = hpc_id // 10) AS right_group, count(*) FILTER (WHERE pred // 10 = hpc_id // 10 AND pred <> hpc_id) AS inside FROM t GROUP BY 1")
def _(s, d):
    t = B.tiles(s, d).select(F.col("hpc_id").cast("long").alias("truth"), ((F.col("hpc_id") * 7 + F.col("run")) % 71).alias("pred"))
    g = lambda c: F.floor(F.col(c) / 10)
    same, hit = g("truth") == g("pred"), F.col("truth") == F.col("pred")
    return t.groupBy(g("truth").alias("grp")).agg(F.count("*").alias("n"), F.count_if(hit).alias("right_hpc"), F.count_if(same).alias("right_group"), F.count_if(same & ~hit).alias("inside"))


@query("a37_confusion", "SELECT hpc_id % 5 AS truth, (hpc_id + run) % 5 AS pred, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY hpc_id % 5)::DOUBLE, 6) AS recall_share FROM tiles GROUP BY 1, 2")
def _(s, d):
    from pyspark.sql import Window

    t = B.tiles(s, d).groupBy((F.col("hpc_id") % 5).alias("truth"), ((F.col("hpc_id") + F.col("run")) % 5).alias("pred")).agg(F.count("*").alias("n"))
    return t.withColumn("recall_share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("truth")), 6))


@query("v15_slide_holdout", "SELECT count(*) AS n_slides, count(*) FILTER (WHERE CAST(slides AS INTEGER) % 5 = 2) AS held FROM (SELECT DISTINCT slides FROM tiles)")
def _(s, d):
    slides = B.tiles(s, d).select("slides").distinct()
    held = slides.where(F.col("slides").cast("int") % 5 == 2).withColumn("held", F.lit(1))
    return slides.join(held, "slides", "left").agg(F.count("*").alias("n_slides"), F.count("held").alias("held"))


@query("x_windowed_events", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def _(s, d):
    return windowed_events(table(s, d, "events"))


def stacked(customers, parts):
    c = customers.select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    p = parts.select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return c.unionByName(p, allowMissingColumns=True)


@query("u3_union_by_name", "SELECT 'c' AS kind, c_custkey AS id, c_acctbal AS balance, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'p', p_partkey, NULL, p_brand FROM part")
def _(s, d):
    return stacked(table(s, d, "customer"), table(s, d, "part"))


