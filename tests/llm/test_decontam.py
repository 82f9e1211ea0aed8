import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus import SCHEMA, documents
from tessera.llm import decontam


def corpus() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(300)] + ["the", "of", "a"] * 60
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 9, 20, 40, 130])))) for i in range(60)]
    docs = []
    for d in range(250):
        t = [rng.choice(vocab) for _ in range(rng.choice([0, 10, 100, 700]))]
        if rng.random() < 0.7:
            w = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = "zzz"
            w = w[rng.choice([0, 0, 0, 2]) :]
            at = rng.randrange(len(t) + 1)
            t[at:at] = w
        docs.append((d, " ".join(x.upper() if rng.random() < 0.1 else x + rng.choice(["", ".", ",\n"]) for x in t)))
    return docs, items


def brute(docs, items, size=5, overlap=0.8):
    out = set()
    for d, t in docs:
        w = decontam.words(t)
        for i, q in items:
            x = decontam.words(q)
            if not x:
                continue
            span, own = max(16, 1 << (len(x) - 1).bit_length()), decontam.shingles(x, size)
            for a in range(0, max(1, len(w) - span), span):
                p = w[a : a + 2 * span]
                there = {tuple(p[k : k + len(own[0])]) for k in range(len(p) - len(own[0]) + 1)}
                if sum(s in there for s in own) >= overlap * len(own) - 1e-9:
                    out.add((d, i))
    return out


def test_matches_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([*docs, (900, None), (901, "")], "doc_id long, text string")
    it = spark.createDataFrame([*items, (990, None), (991, ""), (992, "?!")], "item_id long, text string")
    want = brute(docs, items)
    got = {(r.doc_id, h.item_id) for r in decontam.search(df, it).collect() for h in r.hits}
    assert got == want and len(want) > 100
    kept, decontam.INDEX_CHARS = decontam.INDEX_CHARS, 2000
    try:
        several = {(r.doc_id, h.item_id) for r in decontam.search(df, it).collect() for h in r.hits}
    finally:
        decontam.INDEX_CHARS = kept
    assert several == want


def test_retrieval_is_exact():
    docs, items = corpus()
    index = decontam.build([(i, t, None) for i, t in items])
    rng = random.Random(2)
    for part in index.parts:
        for _ in range(60):
            terms = rng.sample(range(len(index.terms)), rng.choice([5, 40, 150]))
            score: dict[int, float] = {}
            for t in terms:
                if p := part.postings.get(t):
                    for i, x in zip(p.items.tolist(), p.impacts.tolist(), strict=True):
                        score[i] = score.get(i, 0) + x
            for least in (0.2037, 0.6041, 0.9973):
                got = part.retrieve(terms, least)
                assert {i for i, _ in got} == {i for i, s in score.items() if s >= least}
                assert all(abs(s - score[i]) < 1e-9 for i, s in got)


def test_answers_and_awkward_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five six", "forty two"), (2, "one two three four five six", None)], "item_id long, text string, answer string")
    docs = spark.createDataFrame([(1, "so one two three four five six then", "h"), (2, "one two three four five six is forty two", "h"), (2, "one two three four five six is forty two", "h"), (None, "one two three four five six", "h")], "doc_id long, text string, hits string")
    got = sorted((str(r.doc_id), sorted(h.item_id for h in r.hits)) for r in decontam.search(docs, items, answer_col="answer").collect())
    assert got == [("1", [2]), ("2", [1, 2]), ("2", [1, 2]), ("None", [2])]
    df = spark.createDataFrame(documents(), SCHEMA)
    assert decontam.search(df, items.limit(0)).count() == df.count()
    assert decontam.search(df.limit(0), items).count() == 0


@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB_9éÉßẞİΣſK×ªµ´́'.,-[]^`{~\\ \x1c\x85\xa0\r\n\t"))), max_size=5))
@settings(max_examples=300, deadline=None)
def test_terms_are_those_of_whole_texts(texts):
    terms = {w: i for i, w in enumerate(sorted({w for t in texts for w in decontam.words(t)})[::2])}
    ids, sizes, before = decontam.Reader(terms).read(pa.array([*texts, None], pa.string()))
    want = [[terms.get(w, -1) for w in decontam.words(t)] for t in texts] + [[]]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    at = 0
    for x in want:
        for i, t in enumerate(x):
            assert before[at + i] == (at + max((j for j in range(i) if x[j] == t), default=-at - 1) if t >= 0 else -1)
        at += len(x)


def test_item_at_the_end_of_a_very_long_text(spark):
    item = " ".join(f"item{i}" for i in range(30))
    long = " ".join(f"w{i}" for i in range(500_000))
    docs = spark.createDataFrame([(1, f"{long} {item}"), (2, long), (3, "x" * (3 << 20)), (4, item)], "doc_id long, text string")
    got = {r.doc_id: [(h.item_id, h.overlap) for h in r.hits] for r in decontam.search(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert got == {1: [(7, 1.0)], 2: [], 3: [], 4: [(7, 1.0)]}
