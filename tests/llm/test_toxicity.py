import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import queries, toxicity

DOCS, LABELS = "doc_id long, text string, lang string, source string, score double, key string", "doc_id long, quality int, toxic int"
BAD = ("vilesk", "grosk", "Dremp")


def corpus(n=1200, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 7))) for _ in range(600)]
    rows, truth = [], {}
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.choice([5, 40, 200]))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.choice([1, 2, 4])):
                t.insert(rng.randrange(len(t)), rng.choice(BAD).upper() + rng.choice(["", "en", "ish", "!!"]))
        rows.append((i, " ".join(t), "xx", "s", 1.0, "k"))
        truth[i] = int(toxic)
    labels = [(i, 1, t) for i, t in truth.items() if rng.random() < 0.5]
    return rows, labels, truth


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels, truth = corpus()
    copies = [(10_000 + i, rows[0][1], "xx", "s", 1.0, "k") for i in range(400)]  # a third of the rows are one text
    odd = [(20_000, None, None, None, None, None), (20_001, "", "xx", "s", 1.0, "k"), (None, "vilesk", "xx", "s", 1.0, "k"), (20_002, " \n", "xx", "s", 1.0, "k"), (20_003, "calm " * 60_000 + "groskish", "xx", "s", 1.0, "k"), rows[3]]
    docs = spark.createDataFrame([*rows, *copies, *odd], DOCS).repartition(4)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (77_777, 1, 1), (20_001, 1, None), labels[0]], LABELS)
    return docs, marks, truth


def test_held_out_documents(spark, tables):
    docs, marks, truth = tables
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [got[i].predicted == truth[i] for i in out]
    assert len(out) > 200 and sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[20_000].score == got[20_001].score == got[20_002].score < 0.5 and got[20_003].predicted == 1


def test_query_keeps_every_row(spark, tables, tmp_path):
    docs, marks, _ = tables
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op13_toxicity(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.collect())


def test_labels_of_held_out_rows_are_not_read(spark, tables):
    docs, marks, _ = tables
    seen = marks.where(~toxicity.held_out(marks.doc_id))
    a, b = toxicity.fit(docs, marks), toxicity.fit(docs, seen)
    assert a.numbers == b.numbers and np.allclose(a.weights, b.weights) and a.start == pytest.approx(b.start)


def test_without_labels_or_documents(spark, tables):
    docs, marks, _ = tables
    none = toxicity.fit(docs, marks.limit(0))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.limit(0), none).count() == 0
    assert toxicity.fit(docs.limit(0), marks).scores(pa.array(["x"])).tolist()[0] < 0.5


def test_stems_and_levels():
    number = {s: i for i, s in enumerate(["abcd", "abcde", "abcd$"])}
    found = toxicity.occurrences(pa.array(["abcde ABCD, abcd x", None, "abcdef"]), lambda w: [number[s] for s in toxicity.stems(w) if s in number])
    assert sorted(zip(*(x.tolist() for x in found[:3]), strict=True)) == [(0, 0, 3), (0, 1, 1), (0, 2, 2), (2, 0, 1), (2, 1, 1)]
    assert found[3].tolist() == [4, 0, 1]
    text, term = toxicity.levels(*found)
    assert (0, 0 * toxicity.LEVELS + 1) in set(zip(text.tolist(), term.tolist(), strict=True)) and (2, 0 * toxicity.LEVELS + 1) not in set(zip(text.tolist(), term.tolist(), strict=True))


def test_risk_of_clean_text_does_not_go_below_zero():
    """With a prior far above the true share the unbiased risk has no least value; the weights stay bounded all the same."""
    weights, start = toxicity.train([[0]] * 50, [[0]] * 20 + [[]] * 180, 1, 0.4, epochs=400)
    assert np.isfinite(weights).all() and abs(weights[0]) < 25 and weights[0] > 0


def test_cut_is_where_errors_are_fewest():
    rng = np.random.default_rng(0)
    toxic, clean = rng.normal(4, 1, 2000), rng.normal(-4, 1, 8000)
    at = toxicity.cut(toxic[:1000], np.concatenate([toxic[1000:], clean[:4000]]), 0.2)
    assert (clean < at).mean() > 0.999 and (toxic >= at).mean() > 0.999
