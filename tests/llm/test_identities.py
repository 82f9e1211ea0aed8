"""Texts that are built to agree in XXH64 are still told apart, and very long hosts are judged in time."""

from tessera.llm import linededup, substring, urlfilter

LINES = ('1,b{!m!}4>4}l")5&a$]wlqms2i-%2z<\\>px]%{w\\rap{lgo>f$^5d.<]_0)xx,g', '1lv(~ga04>4}l")5&a$]wlqms2i-%2z<\\>\'y}~?_\\rap{lgo>f$^5d.<]_0)xx,g')
WORDS = ('hu)~8^x{wm4>4}l")5&a$]wlqms2i-%2)"w\\}(9>z<\\rap{lgo>f$^5d.<]_0)xx', '(a|!>|\\ewm4>4}l")5&a$]wlqms2i-%2)"w\\]?9bz<\\rap{lgo>f$^5d.<]_0)xx')


def test_unlike_lines_with_one_hash_stay(spark):
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)] + [(7, LINES[0].upper())], "doc_id long, text string")
    got = {r.doc_id: (r.n_dropped, r.kept) for r in linededup.dedup_lines(docs).collect()}
    assert got == {0: (0, LINES[0]), 1: (0, LINES[1]), 7: (1, "")}


def test_rows_of_one_id_with_one_hash_keep_their_places_apart(spark):
    tail = " ".join(f"w{i:03d}" for i in range(40))
    a, b = (f"{w} {tail}" for w in WORDS)
    docs = spark.createDataFrame([(7, a), (7, b), (9, a), (9, a + " end")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup_substrings(docs).collect())
    assert got == sorted([(7, 41, 41, ""), (7, 41, 40, WORDS[1]), (9, 41, 41, ""), (9, 42, 41, "end")])


def test_a_host_of_very_many_labels(spark):
    host = ".".join(["a"] * 50_000) + ".example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/en/x"), (2, f"http://{host}/"), (3, "http://com/"), (4, "x://" + "p" * 200_000), (5, None)], "page_id long, url string")
    rules = spark.createDataFrame([("block", "example.com", "/en/"), ("allow", "a.example.com", "/en/"), ("block", "www.b.example.com", "/")], "verdict string, host string, path string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    assert got == {1: ("a.example.com/en/", "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow")}
