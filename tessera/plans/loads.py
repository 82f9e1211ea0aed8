"""Queries of files, loads, names, joins and guards: each writes or checks what its SQL says of the same tables."""

from pyspark.sql import functions as F

from tessera.operators import cohort, grading, guards, profiles, rollup
from tessera.operators import keys as K
from tessera.operators import spatial as X
from tessera.plans import bindings as B
from tessera.plans.registry import query
from tessera.plans.store import PAIRS, PX, grid, pixels
from tessera.sources import sinks, table, text
from tessera.sources.scratch import new_path, written


def as_csv(df, name):
    path = new_path(df.sparkSession, name)
    df.write.csv(path, header=True)
    return path


#: Folders that a task writes, about.
FOLDERS_A_TASK = 100


def dealt(df, key):
    """A writer of rows by folder of a key, in as many tasks as there are folders for: by their bytes alone they would be merged
    into one. Tasks put their files in place themselves, which else the driver does for one folder after the other."""
    tasks = 1 + df.select(key).distinct().count() // FOLDERS_A_TASK
    return df.repartition(tasks, key).write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", "2")


@query("s2_text_csv", "SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS code, CASE c_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null' ELSE c_name END AS name FROM customer")
def _(s, d):
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, "NA").when(k % 5 == 1, "").when(k % 5 == 2, "null").otherwise(F.col("c_name"))
    df = table(s, d, "customer").select(F.lpad(k.cast("string"), 7, "0").alias("code"), name.alias("name"))
    return text.read_text_csv(s, as_csv(df, "text-csv"))


@query("s3_slide_list", "SELECT DISTINCT slides AS slide_id, samples FROM tiles WHERE CAST(slides AS INTEGER) % 3 = 0")
def _(s, d):
    t = B.tiles(s, d).select(F.col("slides").alias("slide_id"), "samples", F.when(F.col("slides").cast("int") % 3 == 0, "True").otherwise("no").alias("is_tumour")).distinct()
    said = text.read_text_csv(s, as_csv(t, "slide-list"))
    return said.join(guards.slide_list_problems(said), said.columns, "left_anti").select("slide_id", "samples")


@query("s5_resolve_columns", "SELECT vec_id AS tiles, label AS samples, vec_id % 7 AS slides, len(embedding) AS width FROM embeddings")
def _(s, d):
    e = table(s, d, "embeddings").select(F.col("vec_id").alias("train_tiles"), F.col("label").alias("train_samples"), (F.col("vec_id") % 7).alias("train_slides"), F.col("embedding").alias("train_img_z_latent"))
    at = cohort.resolve_columns(e, "z_latent")
    return e.select(*(F.col(at[c]).alias(c) for c in ("tiles", "samples", "slides")), F.size(at["z_latent"]).alias("width"))


@query("s9_slide_coordinates", "SELECT slides, CASE WHEN CAST(slides AS INTEGER) % 7 = 0 THEN 'never' ELSE 'complete' END AS state, CASE WHEN CAST(slides AS INTEGER) % 7 <> 0 THEN count(*) END AS n, CASE WHEN CAST(slides AS INTEGER) % 7 <> 0 THEN CAST(sum(grid_col * 100 + grid_row) AS BIGINT) END AS places FROM tiles GROUP BY slides")
def _(s, d):
    t = B.tiles(s, d).select("slides", "grid_col", "grid_row")
    path = new_path(s, "coordinates")
    dealt(t.where(F.col("slides").cast("int") % 7 != 0), "slides").csv(path, header=True)
    there = text.read_slide_tables(s, path, "grid_col int, grid_row int").groupBy("slides").agg(F.count("*").alias("n"), F.sum(F.col("grid_col") * 100 + F.col("grid_row")).alias("places"))
    return rollup.missing(t.select("slides").distinct(), there, "slides", "n").join(there, "slides", "left")


@query("s10_metadata_states", "SELECT c_custkey, CASE WHEN o.k IS NULL THEN 'never' WHEN c_custkey % 13 = 0 THEN 'corrupt' WHEN c_custkey % 11 = 0 THEN 'zero' ELSE 'complete' END AS state FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON c_custkey = o.k")
def _(s, d):
    k = F.col("c_custkey")
    n = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    n = n.withColumn("n", F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, 0).otherwise(F.col("n")))
    return rollup.missing(table(s, d, "customer").select("c_custkey"), n, "c_custkey", "n")


@query("s12_probability_columns", "SELECT slides, round(sum(proportion), 6) AS p FROM proportion WHERE hpc_id IN (2, 10, 33) GROUP BY slides")
def _(s, d):
    long = profiles.proportion(B.tiles(s, d)).select("slides", "hpc_id", F.col("proportion").alias("p")).where("hpc_id in (2, 10, 33)")
    wide = cohort.to_wide(long, "slides", [10, 2, 33])
    return wide.select("slides", F.round(sum((F.coalesce(c, F.lit(0.0)) for c in cohort.probability_columns(wide)), F.lit(0.0)), 6).alias("p"))


@query("s15_manifest", "SELECT 'raw/' || o_orderkey || '.svs' AS value FROM orders WHERE o_orderkey % 3 <> 0")
def _(s, d):
    k, path = F.col("o_orderkey"), new_path(s, "manifest")
    line = F.when(k % 6 == 0, "").when(k % 3 == 0, "   ").otherwise(F.concat(F.lit("raw/"), k.cast("string"), F.lit(".svs")))
    table(s, d, "orders").select(line).write.text(path)
    return text.read_lines(s, path)


@query("r22_file_registry", "SELECT slides AS slide_id, true AS has_bytes FROM tiles GROUP BY slides")
def _(s, d):
    path = new_path(s, "registry")
    lines = B.tiles(s, d).select("slides").distinct().select(F.concat(F.lit("id "), "slides").alias("line"), F.concat("slides", F.lit(".txt")).alias("file"))
    dealt(lines, "file").text(path)
    files = text.file_registry(s, path).where(F.contains("path", F.lit("/file=")))
    return files.select(F.regexp_extract("path", r"/file=([^/]+)\.txt/", 1).alias("slide_id"), (F.col("length") > 0).alias("has_bytes"))


@query("k2_correlated_update", "SELECT c_custkey, c_name, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 2 = 0) THEN (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 2 = 0) ELSE c_acctbal END AS c_acctbal FROM customer")
def _(s, d):
    stage = table(s, d, "orders").where("o_orderkey % 2 = 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return sinks.update_from(table(s, d, "customer").select("c_custkey", "c_name", "c_acctbal"), stage, "c_custkey", ["c_acctbal"])


LOADED = "SELECT slides, CASE WHEN run % 3 = 0 THEN (hpc_id + 7) % 71 ELSE hpc_id END AS hpc_id, count(*) AS n FROM tiles GROUP BY ALL"


def load(s, d):
    registry = B.tiles(s, d).select("slide_tile", "slides", "hpc_id")
    stage = B.tiles(s, d).where("run % 3 = 0").select("slide_tile", ((F.col("hpc_id") + 7) % 71).cast("int").alias("hpc_id"), "vote_margin")
    # the tables repeat a few keys, whose rows agree in their cluster: one row of each, the same in every run
    once = lambda df, *cols: df.groupBy("slide_tile").agg(*(F.min(c).alias(c) for c in cols))
    stage, known = once(stage, "hpc_id", "vote_margin"), once(registry, "hpc_id")
    report = guards.inspect(stage, known, B.dictionary(s))
    planned = sinks.update_from(registry, stage, "slide_tile", ["hpc_id"])
    return cohort.Load(planned, report, [lambda: guards.require_match(report)])


@query("k3_load", LOADED)
def _(s, d):
    path = new_path(s, "loaded")
    load(s, d).commit(path)
    return profiles.counts_by(s.read.parquet(path), "slides", "hpc_id")


STAGED = "st AS (SELECT slide_tile, any_value((hpc_id + 7) % 71) AS hpc_id, any_value(hpc_id) AS old, min(vote_margin) AS m FROM tiles WHERE run % 3 = 0 GROUP BY slide_tile)"
REPORT = f"WITH {STAGED} SELECT count(*) AS n_rows, count(*) AS matched, count(*) FILTER (WHERE old <> hpc_id) AS overwriting, 0 AS unknown_clusters FROM st"


@query("g5_preview", REPORT)
def _(s, d):
    return load(s, d).preview().drop("low_margin")


@query("q17_load_preview", REPORT.replace("0 AS unknown_clusters", "0 AS unknown_clusters, 'ok' AS verdict"))
def _(s, d):
    return guards.match_verdict(load(s, d).preview().drop("low_margin"))


@query("g4_match_verdict", "WITH st AS (SELECT DISTINCT slide_tile, run FROM tiles), r AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE run % 9 <> 0) AS matched FROM st) SELECT n_rows, matched, CASE WHEN matched < 0.95 * n_rows THEN 'too few rows match' ELSE 'ok' END AS verdict FROM r")
def _(s, d):
    t = B.tiles(s, d).dropDuplicates(["slide_tile"])
    report = guards.inspect(t.select("slide_tile", "hpc_id", "vote_margin"), t.where("run % 9 <> 0").select("slide_tile", "hpc_id"), B.dictionary(s))
    return guards.match_verdict(report).select("n_rows", "matched", "verdict")


@query("k5_slide_membership", "SELECT DISTINCT slides, hpc_id FROM tiles WHERE CAST(slides AS INTEGER) % 10 <> 3 UNION ALL SELECT DISTINCT slides, (hpc_id + 1) % 71 FROM tiles WHERE CAST(slides AS INTEGER) % 10 = 3 AND hpc_id <> 5")
def _(s, d):
    t = B.tiles(s, d)
    new = t.where(F.col("slides").cast("int") % 10 == 3).select("slides", F.when(F.col("hpc_id") != 5, (F.col("hpc_id") + 1) % 71).cast("int").alias("hpc_id")).na.drop().distinct()
    return sinks.replace_group(t.select("slides", "hpc_id").distinct(), new, ["slides"])


@query("k7_staged_parts", "SELECT flag, count(*) AS n FROM tiles GROUP BY flag")
def _(s, d):
    t, path = B.tiles(s, d).select("slide_tile", "flag"), new_path(s, "staged")
    sinks.commit(t.repartition(8), path, expected=t.count())
    return profiles.counts_by(s.read.parquet(path), "flag")


@query("k11_projection_shards", "WITH r AS (SELECT user_id AS dataset, event_id AS lo, event_id + CASE WHEN event_id % 4 = 0 THEN 30 ELSE 60 END AS hi FROM events), b AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY dataset ORDER BY lo, hi), 0) AS before FROM r) SELECT dataset, CASE WHEN lo > before THEN 'gap' ELSE 'overlap' END AS kind, count(*) AS n FROM b WHERE lo <> before GROUP BY ALL")
def _(s, d):
    e = F.col("event_id")
    shards = table(s, d, "events").select(F.col("user_id").alias("dataset"), e.alias("lo"), (e + F.when(e % 4 == 0, 30).otherwise(60)).alias("hi"))
    return rollup.shard_breaks(shards).groupBy("dataset", "kind").agg(F.count("*").alias("n"))


@query("w8_shard_cursor", "SELECT CAST(c_custkey AS BIGINT) AS dataset, 0 AS lo, 5 AS before, 'overlap' AS kind FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 9, 5, 'gap' FROM customer WHERE c_custkey % 3 = 1")
def _(s, d):
    k = F.col("c_custkey")
    parts = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.lit(5).alias("hi")), F.struct(F.when(k % 3 == 0, 0).when(k % 3 == 1, 9).otherwise(5).alias("lo"), F.lit(12).alias("hi")))).alias("r")
    shards = table(s, d, "customer").select(k.alias("dataset"), parts).select("dataset", "r.lo", "r.hi")
    return rollup.shard_breaks(shards).select("dataset", "lo", "before", "kind")


@query("k15_slide_list_file", "SELECT DISTINCT slides AS value FROM tiles WHERE hpc_id = 3")
def _(s, d):
    path = new_path(s, "list")
    cohort.write_list(B.tiles(s, d).where("hpc_id = 3").select("slides").distinct(), "slides", path)
    return text.read_lines(s, path)


@query("k16_run_record", "SELECT submission_id, state FROM runs")
def _(s, d):
    values = B.runs(s, d).select("submission_id", "state", F.lit("x").alias("no_such_column"))
    return cohort.run_record(values, B.runs(s, d))


@query("p3_sample_from_slide", "SELECT s_suppkey, split_part(s_name || ' ' || s_suppkey || ' x', ' ', 1) AS sample FROM supplier")
def _(s, d):
    name = F.concat("s_name", F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(" x"))
    return table(s, d, "supplier").select("s_suppkey", K.sample_from_slide(name).alias("sample"))


@query("p5_tile_xy", "SELECT slide_tile, grid_col AS x, grid_row AS y FROM tiles")
def _(s, d):
    t = B.tiles(s, d)
    x, y = K.tile_xy(F.concat(F.concat_ws("_", "grid_col", "grid_row"), F.lit(".jpeg")))
    return t.select("slide_tile", x.alias("x"), y.alias("y"))


@query("p10_purity_numbers", "SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'high') THEN 0.85::DOUBLE WHEN contains(lower(o_orderpriority), 'medium') THEN 0.65 WHEN contains(lower(o_orderpriority), 'low') THEN 0.35 END AS purity FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", K.purity_number(F.col("o_orderpriority")).alias("purity"))


@query("p11_clean_columns", "SELECT c_custkey AS slide_id, c_nationkey AS slide_id__dup1, c_name AS tiles FROM customer")
def _(s, d):
    return K.clean_columns(table(s, d, "customer").select("c_custkey", "c_nationkey", "c_name").toDF(" Slide ID", "slide-id", "Tiles "))


@query("p12_margin_bands", "SELECT CASE WHEN vote_margin < 0.1 THEN 'low' WHEN vote_margin >= 0.5 THEN 'kept' ELSE 'between' END AS band, count(*) AS n FROM tiles GROUP BY 1")
def _(s, d):
    m = F.col("vote_margin")
    return B.tiles(s, d).groupBy(F.when(m < 0.1, "low").when(m >= 0.5, "kept").otherwise("between").alias("band")).agg(F.count("*").alias("n"))


NAMED = "[" + ", ".join(f"'{p}'" for p in K.PATTERNS) + "]"


@query("p20_grade", f"WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, {NAMED}[1 + l_partkey % 6] AS p, (l_orderkey % 10) / 20.0::DOUBLE AS h FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN h >= 0.2 THEN 3 WHEN p = 'lepidic' THEN 1 WHEN p IN ('acinar', 'papillary') THEN 2 ELSE 3 END AS grade FROM g")
def _(s, d):
    p = F.get(F.array(*map(F.lit, K.PATTERNS)), (F.col("l_partkey") % 6).cast("int"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", K.grade_of(p, (F.col("l_orderkey") % 10) / 20.0).alias("grade"))


@query("p26_utc_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') || ' UTC' AS at FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", K.utc_text(F.col("o_orderdate")).alias("at"))


@query("p30_native_nulls", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events")
def _(s, d):
    v = F.when(F.col("event_id") % 7 == 0, float("nan")).otherwise(F.col("value"))
    return table(s, d, "events").select("event_id", K.native_null(v).alias("value"))


@query("j3_adjacency_input", "SELECT hpc_title, count(*) AS n FROM (SELECT CASE WHEN run % 10 <> 0 THEN hpc_id END AS h FROM tiles) t LEFT JOIN dictionary ON h = hpc_id GROUP BY hpc_title")
def _(s, d):
    t = B.tiles(s, d).select("slide_tile", F.when(F.col("run") % 10 != 0, F.col("hpc_id")).alias("hpc_id"))
    return profiles.counts_by(cohort.titled(t, B.dictionary(s), strict=True), "hpc_title")


@query("j13_titles", "SELECT slides, hpc_id, n, hpc_title FROM proportion LEFT JOIN dictionary USING (hpc_id)")
def _(s, d):
    return cohort.titled(profiles.counts_by(B.tiles(s, d), "slides", "hpc_id"), B.dictionary(s)).select("slides", "hpc_id", "n", "hpc_title")


VOTED = "f AS (SELECT hpc_id, flag, count(*) AS n FROM tiles GROUP BY ALL), c AS (SELECT hpc_id, first(flag ORDER BY n DESC, flag) AS label, round(max(n) / sum(n)::DOUBLE, 2) AS agreement FROM f GROUP BY hpc_id)"


@query("j15_tiles_consensus", f"WITH {VOTED} SELECT slides, label, count(*) AS n FROM tiles LEFT JOIN c USING (hpc_id) GROUP BY ALL")
def _(s, d):
    t = B.tiles(s, d)
    return profiles.counts_by(t.join(profiles.majority(t, "hpc_id", "flag"), "hpc_id", "left"), "slides", "label")


@query("a21_agreement", f"WITH {VOTED} SELECT hpc_id, agreement FROM c")
def _(s, d):
    return profiles.majority(B.tiles(s, d), "hpc_id", "flag").select("hpc_id", "agreement")


@query("j18_side_by_side", "SELECT c_custkey AS row_id, c_name, c_mktsegment FROM customer")
def _(s, d):
    c = table(s, d, "customer")
    return cohort.side_by_side(c.select(F.col("c_custkey").alias("row_id"), "c_name"), c.select(F.col("c_custkey").alias("row_id"), "c_mktsegment"))


@query("j19_grid_pairs", f"WITH {PAIRS} SELECT slide, a, b, ta AS tile_a, tb AS tile_b FROM grid")
def _(s, d):
    return grid(s, d, "slide_tile")


@query("a36_label_matrix", f"WITH {PAIRS}, n AS (SELECT slide, a, b, count(*) AS n FROM (SELECT slide, a, b FROM grid UNION ALL SELECT slide, b, a FROM grid) GROUP BY ALL) SELECT slide, a, b, n, round(n / sum(n) OVER (PARTITION BY slide)::DOUBLE, 6) AS share FROM n")
def _(s, d):
    return X.interactions(grid(s, d), "slide").withColumn("share", F.round("share", 6))


@query("j26_annotation_merge", "SELECT d.hpc_id, malignant, coef FROM dictionary d JOIN survival s ON d.hpc_id = s.hpc_id WHERE p IS NOT NULL")
def _(s, d):
    return B.dictionary(s).join(B.survival(s).where("p is not null"), "hpc_id").select("hpc_id", "malignant", "coef")


@query("g3_disagreeing_keys", "SELECT slides, count(*) AS n FROM tiles WHERE run % 50 = 0 GROUP BY slides")
def _(s, d):
    t = B.tiles(s, d)
    supplied = t.withColumn("supplied", F.when(F.col("run") % 50 == 0, F.lower("slide_tile")).otherwise(F.col("slide_tile"))).withColumn("rebuilt", K.make_slide_tile(F.col("slides"), F.col("tiles")))
    return profiles.counts_by(guards.disagreeing(supplied, "supplied", "rebuilt"), "slides")


@query("g8_dictionary_state", "SELECT count(*) AS n, count(*) FILTER (WHERE malignant) AS malignant, count(*) FILTER (WHERE malignant) > 0 AS usable FROM dictionary")
def _(s, d):
    return cohort.dictionary_state(B.dictionary(s))


@query("g9_foreign_keys", "SELECT DISTINCT slides, samples AS dataset FROM tiles WHERE CAST(slides AS INTEGER) % 4 = 1")
def _(s, d):
    own = B.tiles(s, d).select("slides", F.col("samples").alias("dataset")).distinct()
    return sinks.collisions(own, own.where(F.col("slides").cast("int") % 4 == 1), "slides", "dataset", "new").select("slides", "dataset")


@query("g10_row_counts", "SELECT slides, count(*) AS n_source, count(*) FILTER (WHERE run % 100 <> 0) AS n_output FROM tiles GROUP BY slides HAVING n_source <> n_output")
def _(s, d):
    t = B.tiles(s, d).select("slides", "run")
    output, _ = written(t.where("run % 100 <> 0"), "output")
    return guards.row_counts(t, output, "slides")


@query("g11_incomplete", "SELECT * FROM (VALUES ('label', 'bigint', 'int'), ('tiles', 'string', NULL)) v(name, expected, found)")
def _(s, d):
    return guards.incomplete(table(s, d, "embeddings"), {"vec_id": "bigint", "embedding": "array<float>", "label": "bigint", "tiles": "string"})


@query("g12_grading_covers_list", "SELECT CAST(s_suppkey AS VARCHAR) AS slide_id, CASE WHEN s_suppkey % 9 = 0 THEN 'missing' ELSE 'relabelled' END AS state FROM supplier WHERE s_suppkey % 9 = 0 OR s_suppkey % 8 = 0 UNION ALL SELECT 'extra' || r_regionkey, 'unexpected' FROM region")
def _(s, d):
    k = F.col("s_suppkey")
    listed = table(s, d, "supplier").select(k.cast("string").alias("slide_id"), F.col("s_nationkey").cast("string").alias("sample"))
    graded = table(s, d, "supplier").where(k % 9 != 0).select(k.cast("string").alias("slide_id"), F.when(k % 8 == 0, "other").otherwise(F.col("s_nationkey").cast("string")).alias("sample"))
    extra = table(s, d, "region").select(F.concat(F.lit("extra"), F.col("r_regionkey").cast("string")).alias("slide_id"), F.lit("x").alias("sample"))
    return guards.reconcile(listed, graded.unionAll(extra), "slide_id", "sample").where("state <> 'ok'")


@query("g14_not_one_to_one", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(s, d):
    return guards.duplicate_keys(table(s, d, "orders"), "o_custkey")


RANGES = "SELECT o_orderkey * 10 AS lo, o_orderkey * 10 + 10 AS hi FROM orders"


@query("g15_other_identity", "SELECT o_orderkey * 10 AS lo, o_orderkey * 10 + 10 AS hi, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS identity FROM orders WHERE o_orderstatus <> 'F'")
def _(s, d):
    k, state = F.col("o_orderkey"), F.col("o_orderstatus")
    done = table(s, d, "orders").select((k * 10).alias("lo"), (k * 10 + 10).alias("hi"), F.when(state != "P", state).alias("identity"))
    return sinks.other_identity(done, "F")


@query("k9_pending_orders", f"{RANGES} WHERE o_orderstatus <> 'F'")
def _(s, d):
    k = F.col("o_orderkey")
    ranges = table(s, d, "orders").select((k * 10).alias("lo"), (k * 10 + 10).alias("hi"), "o_orderstatus")
    return sinks.pending_ranges(ranges.drop("o_orderstatus"), ranges.where("o_orderstatus = 'F'").withColumn("identity", F.lit("a")), "a").select("lo", "hi")


@query("g17_pixel_sums", f"SELECT slide_id FROM ({PX}) WHERE CAST(slide_id AS INTEGER) % 6 = 1")
def _(s, d):
    px = pixels(s, d).withColumn("pattern_pixels", F.col("pattern_pixels") + F.when(F.col("slide_id").cast("int") % 6 == 1, 1).otherwise(0))
    return grading.slide_proportions(px).where("not adds_up").select("slide_id")


@query("g18_foreign_keys", "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY l_partkey")
def _(s, d):
    parts = table(s, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return profiles.counts_by(guards.orphans(table(s, d, "lineitem"), parts, "l_partkey"), "l_partkey")


@query("r26_present_keys", "SELECT slide_tile FROM tiles WHERE run % 4 = 0")
def _(s, d):
    t = B.tiles(s, d)
    return t.select("slide_tile").join(t.where("run % 4 = 0").select("slide_tile").distinct(), "slide_tile", "left_semi")


@query("r29_normalised_tiles", "SELECT tiles FROM tiles")
def _(s, d):
    t = B.tiles(s, d)
    short = F.when(F.col("run") % 2 == 0, F.regexp_replace("tiles", r"\.jpeg$", "")).otherwise(F.col("tiles"))
    return t.select(K.normalize_tile(short).alias("tiles"))


@query("r35_pixel_counts", "SELECT slide_id, 'blank sample' AS problem FROM (" + PX + ") WHERE CAST(slide_id AS INTEGER) % 5 = 0 UNION ALL SELECT slide_id, 'no whole number' FROM (" + PX + ") WHERE CAST(slide_id AS INTEGER) % 7 = 0")
def _(s, d):
    k = F.col("slide_id").cast("int")
    px = pixels(s, d).select("slide_id", F.when(k % 5 == 0, " ").otherwise(F.col("sample")).alias("sample"), F.concat(F.col("solid_px").cast("string"), F.when(k % 7 == 0, F.lit(".5")).otherwise("")).alias("solid_px"))
    one = lambda df, name: df.select("slide_id", F.lit(name).alias("problem"))
    return one(guards.blank_keys(px, "sample"), "blank sample").unionAll(one(guards.whole_pixels(px, "solid_px"), "no whole number"))


@query("r34_shard_plan", "SELECT i * 1000 AS lo, least(i * 1000 + 1000, (SELECT count(*) FROM orders)) AS hi FROM range(0, 100000) r(i) WHERE i * 1000 < (SELECT count(*) FROM orders)")
def _(s, d):
    return s.createDataFrame(rollup.shard_plan(table(s, d, "orders").count(), 1000), "lo long, hi long")
