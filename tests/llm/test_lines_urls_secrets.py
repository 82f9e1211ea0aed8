import hashlib
import random
import re

from pyspark.sql import functions as F

from corpus import SCHEMA, documents
from tessera.llm import linededup, secretscan, urlfilter


def test_lines_match_brute_force(spark):
    rows = documents()
    of = {r[0]: (r[1] or "").split("\n") for r in rows}
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders: dict[str, set[int]] = {}
    for i, lines in of.items():
        for x in lines:
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(i)
    want = {}
    for i, lines in of.items():
        stay = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        want[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in linededup.dedup_lines(df).collect()}
    assert got == want
    assert any(x[1] for x in want.values())


def test_lines_other_threshold_repeats_and_empty(spark):
    rows = [(1, "the same line\nx"), (2, "the same line"), (2, "the same line"), (None, "the same line"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_dropped, r.kept) for r in linededup.dedup_lines(df, min_docs=4).collect())
    assert all(d == 0 for _, d, _ in got) and len(got) == 5
    got = sorted((r.doc_id or -1, r.n_dropped, r.kept) for r in linededup.dedup_lines(df).collect())
    assert got == [(-1, 1, ""), (1, 0, "the same line\nx"), (2, 1, ""), (2, 1, ""), (3, 0, "")]
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_urls_match_brute_force(spark):
    urls = [None, "", "x", "http://", "http://com", "http://com/", "http://A.Example.COM/en/1?x://y", "http://example.com/en", "http://www.example.com/en/?q", "ftp://b.www.example.com/en/z#f", "http://net/es/", "http://a.net/fr/x", "http://anet/fr/x", "http://xcom/a", "http://example.com.evil.org/en/", "http://a..net/es/", "http://.com/", "//com/", "http://a.b.net?/es/"] * 2
    rows = [(i, u, "k") for i, u in enumerate(urls)] + [(None, "http://com/x", "k"), (0, None, "k")]
    rules = spark.createDataFrame(urlfilter.RULES, "verdict string, host string, path string")
    got = [tuple(r) for r in urlfilter.judge(spark.createDataFrame(rows, "page_id int, url string, key string"), rules).collect()]
    want = []
    for i, u, _ in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        want.append((i, host, path, rule, verdict))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert urlfilter.judge(spark.createDataFrame([], "page_id int, url string"), rules).count() == 0


def test_nested_paths_and_a_hot_host(spark):
    rng = random.Random(8)
    hosts = ["hot.org", "a.hot.org", "b.a.hot.org", "org", "x\x00org", "hot\x00.org", "other.net"]
    paths = ["/", "/a", "/a/", "/a/b", "/a/b/c/", "/ab", "", "/é/"]
    said = [(rng.choice(["allow", "block"]), h, p) for h in hosts[:4] for p in paths if rng.random() < 0.7] + [("block", "hot.org", f"/p{i}/") for i in range(300)]
    rows = [(i % 400, f"http://{rng.choice(hosts[:2] * 3 + hosts)}{rng.choice([*paths, '/p7/x', '/p299/', '/a/b/c/d?q', '/é/z'])}") for i in range(900)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id int, url string"), spark.createDataFrame(said, "verdict string, host string, path string"), sweeps=3).collect()
    want = []
    for i, u in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", u)
        fits = [(len(h + p), len(h), h, p, v) for v, h, p in said if (m[1] == h or m[1].endswith("." + h)) and m[2].startswith(p)]
        *_, h, p, v = max(fits, default=(None, None, "allow"))
        want.append((i, m[1], m[2], h + p if p is not None else None, v))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    plan = urlfilter.openings(spark.createDataFrame(said, "verdict string, host string, path string")).collect()
    assert max(len(r.stack) for r in plan) <= 8


def test_secrets_match_brute_force(spark):
    rows = documents()
    want = {}
    full = {"assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    for i, t, *_ in rows:
        spans = []
        for rank, (kind, p) in enumerate(full.items()):
            for m in re.finditer(p, t or "", re.ASCII):
                if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                    spans.append((m.start(), rank, kind, m.end()))
        want[i] = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    df = secretscan.scan(spark.createDataFrame(rows, SCHEMA))
    base = F.filter("spans", lambda s: s.rank < 3)
    got = {r[0]: r[1] for r in df.select("doc_id", secretscan.joined(base)).collect()}
    assert got == want and sum(bool(x) for x in want.values()) > 5
    assert any("pem" in r[0] for r in df.select(secretscan.joined(F.col("spans"))).collect())
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_trigrams():
    query = secretscan.trigram_query(secretscan.Rule("x", "(pass|to)word.*[a-z]+", 0))
    assert query == [frozenset({"pas", "ass", "ssw", "swo", "wor", "ord"}), frozenset({"tow", "owo", "wor", "ord"})]
    assert secretscan.trigram_query(secretscan.Rule("x", "a?bc*d")) is None


def test_other_rules_repeats_and_very_long_texts(spark):
    own = (secretscan.Rule("pin", r"pin-[0-9]{4}"), secretscan.Rule("any", r"Q[0-9]"))  # the second has no trigram
    long = "word " * 700_000 + "pin-1234 " + "x" * 1000 + " Q7"
    rows = [(None, "pin-0000 Q1"), (None, "pin-0000 Q1"), (1, long), (2, None), (3, "pin-12")]
    got = sorted((str(r[0]), r[1]) for r in secretscan.scan(spark.createDataFrame(rows, "doc_id long, text string"), own).select("doc_id", secretscan.joined(F.col("spans"))).collect())
    at = long.index("pin-1234")
    assert got == [("1", f"pin:{at}:{at + 8},any:{len(long) - 2}:{len(long)}"), ("2", ""), ("3", ""), ("None", "pin:0:8,any:9:11"), ("None", "pin:0:8,any:9:11")]


def test_very_long_texts_keep_their_lines(spark):
    line = "a line that both hold"
    long = "\n".join([line, *(f"line {i} of the first" for i in range(200_000))])
    rows = [(2, long), (1, line), (3, "z" * (3 << 20))]
    got = {r.doc_id: (r.n_lines, r.n_dropped, len(r.kept)) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 0, len(line)), 2: (200_001, 1, len(long) - len(line) - 1), 3: (1, 0, 3 << 20)}
