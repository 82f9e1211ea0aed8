import hashlib
import random
import re
from collections import Counter

import pytest

from corpus import SCHEMA, documents
from tessera.llm import substring


def brute(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("window", "modulus"), [(35, 21), (10, 7), (35, 13)])
def test_matches_brute_force(spark, window, modulus):
    rng = random.Random(window)
    rows = documents()
    passage = [str(rng.random()) for _ in range(80)]
    for i in range(40):  # windows at all offsets, some a word too short, some twice in one text, some overlapping
        a, n = rng.randrange(40), rng.choice([window - 1, window, window + 1, 40])
        t = [str(rng.random()) for _ in range(rng.randrange(30))] + passage[a : a + n] * rng.choice([1, 1, 2])
        rows.append((10_000 + i, " ".join(t), None, None, None, "x", "y", 1))
    rows += [(20_000, "a " * 200, None, None, None, "x", "y", 1), (20_001, "a b " * 30, None, None, None, "x", "y", 1)]
    want = {r[0]: x for r, x in zip(rows, brute([r[1] for r in rows], window), strict=True)}
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_substrings(df, window, modulus).collect()}
    assert got == want
    assert sum(x[1] > 0 for x in want.values()) > 30


def test_repeats_nulls_and_empty(spark):
    t = " ".join(map(str, range(40)))
    df = spark.createDataFrame([(1, t), (1, t), (None, t + " x"), (2, None), (3, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring.dedup_substrings(df).collect())
    assert got == [("1", 40, 40, ""), ("1", 40, 40, ""), ("2", 0, 0, ""), ("3", 0, 0, ""), ("None", 41, 40, "x")]
    assert substring.dedup_substrings(df.limit(0)).count() == 0


def test_covers():
    for m, cover in substring.COVERS.items():
        assert {(a - b) % m for a in cover for b in cover} == set(range(m))


def test_words_that_agree_in_a_rolling_hash_stay(spark):
    # sums of terms times powers of an odd number modulo 2 ** 64 agree on these two words, whatever the number
    thue = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = thue.translate(str.maketrans("ab", "ba"))
    head, tail = [f"h{i}" for i in range(17)], [f"t{i}" for i in range(17)]
    df = spark.createDataFrame([(i, " ".join([*head, w, *tail])) for i, w in enumerate((thue, other))], "doc_id long, text string")
    assert [r.n_removed for r in substring.dedup_substrings(df).collect()] == [0, 0]
    same = df.unionAll(spark.createDataFrame([(2, " \t".join([*head, other, *tail]))], df.schema))
    assert {r.doc_id: r.n_removed for r in substring.dedup_substrings(same).collect()} == {0: 0, 1: 35, 2: 35}


def test_very_long_texts(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    long = " ".join(f"w{i}" for i in range(400_000))
    texts = [f"{long} {passage}", f"{passage} x", long[: 3 << 20], "y" * (3 << 20)]
    want = brute(texts, 35)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_substrings(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert [got[i] for i in range(4)] == want
