import random

import xxhash

from corpus import SCHEMA, documents
from tessera.llm import simhash
from tessera.llm.components import connected


def brute_fingerprint(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps: dict[int, int]) -> dict[int, int]:
    ids = sorted(fps)
    comp = {i: i for i in ids}
    for _ in ids:
        moved = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and comp[a] > comp[b]:
                    comp[a], moved = comp[b], True
        if not moved:
            return comp
    return comp


def test_matches_brute_force(spark):
    rows = documents()
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows}
    want = {i: (fps[i], c) for i, c in components(fps).items()}
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_all_links_found(spark):
    rng = random.Random(3)
    fps = {}
    for i in range(60):
        fp = rng.getrandbits(64)
        for _ in range(12):  # chains in which each member is 4 bits off some earlier one
            fps[len(fps)] = fp
            for b in rng.sample(range(64), 4):
                fp ^= 1 << b
    signed = [(x - 2**64 if x >> 63 else x,) for x in fps.values()]
    labels = connected(simhash.links(spark.createDataFrame(signed, "fp long")))
    of = {r.node: r.root for r in labels.collect()}
    want = components(fps)
    groups, found = {}, {}
    for i, (x,) in enumerate(signed):
        groups.setdefault(want[i], set()).add(x)
        found.setdefault(of.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (9, None), (8, ""), (None, "q r s t u v")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == [(5, 5), (5, 5), (8, 8), (9, 8), (None, 5), (None, None)]


def test_very_long_texts(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    text = " ".join(rng.choice(words) for _ in range(600_000))
    rows = [(4, text), (2, text + " one more"), (9, "y" * (3 << 20))]
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9] == (brute_fingerprint("y" * (3 << 20)), 9)
    assert got[4][1] == got[2][1] == 2 and (got[4][0] ^ got[2][0]).bit_count() <= 4


def test_pairs_that_keys_bring_together_are_few():
    import numpy as np

    def pairs(n):
        key, _ = simhash.keys(np.random.default_rng(1).integers(0, 2**64, n, dtype=np.uint64, endpoint=False))
        _, count = np.unique(key, return_counts=True)
        return int((count * (count - 1) // 2).sum())

    assert pairs(20_000) < 400 and pairs(40_000) < 1600
