"""The queries of this subpackage over the tables of a folder, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, kmeans, langid, linededup, mixing, resample, secretscan, simhash, substring, tokens, topk, toxicity, urlfilter
from tessera.sources import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_token_output(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """tokenizer: path of the definition, by default the public one that the query is about."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return tokens.token_output(table(spark, sf_dir, "documents"), tokenizer)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlfilter.RULES, "verdict string, host string, path string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secretscan.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    of_base = F.filter("spans", lambda s: s.kind.isin(base))
    return found.select("doc_id", *(count(k) for k in base), F.sha2(secretscan.joined(of_base), 256).alias("base_sha256"), secretscan.joined(F.col("spans")).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.search(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("hits").alias("hit"))
    return hits.select("doc_id", "hit.item_id", "hit.overlap", F.round("hit.score", 6).alias("score"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.cluster(table(spark, sf_dir, "embeddings"))[0]


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_token_output": op2_token_output,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_clustering": op11_clustering,
    "op12_resampling": op12_resampling,
    "op13_toxicity": op13_toxicity,
}


#: The kinds of secrets of the query, spelt out for SQL: kind, pattern, group, least length of the group.
_SECRETS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("live", r"sk_live_[A-Za-z0-9]{20,}", 0, 28),
)


def _matches(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """SQL for the matches of a pattern with the piece of text before each."""
    regex = "'" + pattern.replace("'", "''") + "'"
    found = f"regexp_extract_all(t, {regex})"
    return f"""SELECT * FROM (SELECT {rank} AS rank, '{kind}' AS kind, {least} AS least, doc_id,
        unnest(list_slice(string_split_regex(t, {regex}), 1, len({found}))) AS piece, unnest({found}) AS whole,
        unnest(regexp_extract_all(t, {regex}, {group})) AS part, generate_subscripts({found}, 1) AS i FROM t)"""


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

def _lloyd(rounds: int) -> str:
    """SQL for the rounds: nearest centroid of each row, then the floor of each component's mean."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
            SELECT i, q, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
                SELECT v.i, v.q, c.c, list_sum(list_transform(list_zip(v.q, c.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} c
            ) GROUP BY i, q)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (
                SELECT o.c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN (
                    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS m FROM (
                        SELECT c, p, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM a{r}) GROUP BY c, p
                    ) GROUP BY c
                ) n ON o.c = n.c)""")
    return ", ".join(out)


#: CRC-32 of each text of a column w, by a table of 256 values made from the polynomial.
_CRC = """crc AS MATERIALIZED (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i::BIGINT, list_transform(range(8), lambda k: k::BIGINT)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i)
            )
        )"""


def _crc32(w: str) -> str:
    bytes_of = f"list_transform(range(0, length(hex(encode({w}))) // 2), lambda i: (instr('0123456789ABCDEF', substr(hex(encode({w})), 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex(encode({w})), 2 * i + 2, 1)) - 1)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


_RUNS = r"""SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM"""

ORACLE: dict[str, str] = {
    "op1_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS t FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.t, c.t), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op3_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, {_BLANKS}), {_FOLD}) AS key FROM lines
        ), shared AS (
            SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), judged AS (
            SELECT k.doc_id, k.pos, k.line, s.first IS NOT NULL AND s.first <> k.doc_id AS lost
            FROM keyed k LEFT JOIN shared s ON k.key = s.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op4_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i,
                   unnest(list_transform(range(1, len(words) + 1), lambda i: CASE WHEN i + 34 <= len(words) THEN array_to_string(words[i:i + 34], ' ') END)) AS win
            FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents WHERE text IS NOT NULL)
        ), seen AS (
            SELECT win FROM w WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1
        ), judged AS (
            SELECT doc_id, word, i, max(CASE WHEN s.win IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
            FROM w LEFT JOIN seen s ON w.win = s.win
        )
        SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (WHERE gone = 1) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS kept_sha256
        FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id""",
    "op5_url_filter": f"""
        WITH rules(verdict, host, path) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), urls AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), {_FOLD}) AS host,
                   coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ), fits AS (
            SELECT u.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
            FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
            GROUP BY u.page_id
        )
        SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id""",
    "op6_secret_scan": f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({" UNION ALL ".join(_matches(i, *x) for i, x in enumerate(_SECRETS))}),
        placed AS (
            SELECT *, sum(length(piece)) OVER w + coalesce(sum(length(whole)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
            FROM m WINDOW w AS (PARTITION BY rank, doc_id ORDER BY i)
        ), spans AS (
            SELECT doc_id, rank, kind, s, s || ':' || (s + length(whole)) AS span FROM placed WHERE length(part) >= least
        )
        SELECT t.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
               count(*) FILTER (WHERE kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(kind || ':' || span, ',' ORDER BY s, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
               coalesce(string_agg(kind || ':' || span, ',' ORDER BY s, rank), '') AS spans
        FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id""",
    "op11_clustering": f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS i, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS c, q AS m FROM v QUALIFY c < 40
        ), {_lloyd(5)}
        SELECT v.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
               (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.m, ',')) AS centroid_sha256
        FROM v JOIN a5 a ON v.i = a.i JOIN c5 m ON m.c = a.c""",
    "op12_resampling": rf"""
        WITH {_CRC}, w AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS id, coalesce(regexp_extract_all(translate(text, {_FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
        ), b AS (
            SELECT 0 AS id, coalesce(regexp_extract_all(translate(text, {_FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
        ), df AS MATERIALIZED ({_RUNS} w), bf AS MATERIALIZED ({_RUNS} b), h AS MATERIALIZED (
            SELECT f, {_crc32("f")} % 10000 AS k FROM (SELECT f FROM df UNION SELECT f FROM bf), crc
        ), s AS (SELECT k, count(*) AS s FROM df JOIN h USING (f) GROUP BY k), t AS (SELECT k, count(*) AS t FROM bf JOIN h USING (f) GROUP BY k), n AS (
            SELECT (SELECT count(*) FROM df)::DOUBLE AS of_docs, (SELECT count(*) FROM bf)::DOUBLE AS of_goal
        ), g AS MATERIALIZED (
            SELECT s.k, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (n.of_docs + 10000) / ((s.s + 1)::DOUBLE * (n.of_goal + 10000))))::BIGINT AS g FROM s LEFT JOIN t USING (k), n
        ), x AS (
            SELECT id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN h USING (f) JOIN g USING (k) GROUP BY id
        ), d AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
            FROM w LEFT JOIN x USING (id)
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS i, count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM d
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND i <= able * 25 // 100 THEN i END AS rank FROM r""",
}
