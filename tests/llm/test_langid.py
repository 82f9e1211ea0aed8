import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from corpus import SCHEMA, documents
from tessera.llm import langid

WORDS = {"en": "the and with that this have from they would there".split(), "fr": "les dans pour être avec cette mais nous vous tout".split(), "ru": "это что как его она они мы был для все".split()}


def texts(n: int = 300) -> list[tuple]:
    rng = random.Random(1)
    out = [(i, " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ","]) for _ in range(rng.randint(3, 40))), lang) for i in range(n) for lang in [rng.choice(list(WORDS))]]
    return [*out, (n, None, "en"), (n + 1, "", None), (n + 2, "123 !!", "fr"), (None, "the and with", None), (3, out[3][1], out[3][2])]


def test_held_out_accuracy_and_spans(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [r[0] for r in df.select(langid.held_out(F.col("doc_id"))).collect()] == [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows]
    model = langid.fit(df)
    assert model.langs == ["en", "fr", "ru"]
    got = langid.identify(df, model, ("doc_id", "lang")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (300, 301, 302):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
        elif r.lang:
            assert r.lang_pred == r.lang and 0 < r.score <= 1
    mixed = " ".join(WORDS["en"] * 3 + WORDS["fr"] * 2 + WORDS["ru"])
    r = langid.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert r.lang_pred == "en" and [s.lang for s in r.spans] == ["en", "fr", "ru"] and abs(r.spans[0].end - 30) <= 1


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], {}, np.zeros((1, 3)), {}, 1.5, 0)
    for _ in range(150):
        s = rng.normal(0, rng.choice([0.3, 1, 3]), (rng.integers(1, 7), 3))
        value = lambda path, s=s: sum(s[i, x] for i, x in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))
        assert abs(value(model.label(s)) - max(value(p) for p in itertools.product(range(3), repeat=len(s)))) < 1e-9


def test_awkward_rows(spark):
    df = spark.createDataFrame(documents(), SCHEMA)
    assert langid.identify(df, langid.fit(df)).count() == df.count()
    none = df.limit(0)
    assert langid.identify(none, langid.fit(none)).count() == 0
    assert {r.lang_pred for r in langid.identify(df, langid.fit(none)).collect()} == {"und"}


def test_rare_language_short_and_long_texts(spark):
    rng = random.Random(4)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    rows = [(i, say("en", 20), "en") for i in range(2000)] + [(5000 + i, say("fr", 20), "fr") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, max_docs=50)
    assert model.langs == ["en", "fr"]
    asks = [(i, say(lang, n), lang) for i, (lang, n) in enumerate([(x, n) for x in ("en", "fr") for n in (1, 2, 3, 400_000) for _ in range(20 if n < 9 else 1)])]
    got = langid.identify(spark.createDataFrame(asks, "doc_id long, text string, lang string"), model, ("doc_id", "lang")).collect()
    right = {n: [r.lang_pred == r.lang for r in got if len(asks[r.doc_id][1].split()) == n] for n in (1, 2, 3, 400_000)}
    assert all(right[400_000]) and sum(right[3]) >= 36 and sum(right[1]) >= 30
