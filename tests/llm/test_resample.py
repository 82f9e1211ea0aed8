import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from corpus import SCHEMA, documents
from tessera.llm import resample


def features(text, longest=2):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def bucket(f, k=10_000):
    return zlib.crc32(f.encode()) % k


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    all_s, all_t = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000) / ((s[b] + 1.0) * (all_t + 10_000)))) for b in s}
    out = []
    for i, text, *_ in rows:
        w, f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(w), len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20 and r[4] is not None), key=lambda r: (-r[4], r[0], r[3], r[2]))
    for place, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=repr)


def awkward():
    long = "Straße über日本 a\x00b_c" * 30 + " " + "x" * 90_000 + " tail end"
    return [*documents(), (900_001, long, "en", "s", None, "x", "y", 1), (900_002, long, "en", "s", None, "x", "y", 1), (None, "word " * 30, "en", "s", None, "x", "y", 1), (900_003, "٣ words WORDS " * 10, "en", "s", None, "x", "y", 1), (0, "word " * 30, "en", "s", None, "x", "y", 1)]


def test_matches_brute_force(spark):
    rows, target = awkward(), ["aeious words of the target", None, "", "words words über", "words words über"]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resample.resample(docs, goal)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, target)


def test_empty_tables(spark):
    docs, goal = spark.createDataFrame(documents()[:40], SCHEMA), spark.createDataFrame([], "text string")
    assert sorted((tuple(r) for r in resample.resample(docs, goal).collect()), key=repr) == brute(documents()[:40], [])
    assert resample.resample(docs.limit(0), goal).count() == 0


def test_checksums_of_runs():
    texts = ["a bb ccc", "", None, "x" * 63 + " " + "y" * 64 + " " + "z" * 200 + " é", "one"]
    codes, size, distinct = resample.words(pa.array(texts, pa.string()))
    crc, text = resample.checksums(codes, size, distinct, 3)
    got = Counter(zip(text.tolist(), crc.tolist(), strict=True))
    want = Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in features(t, 3)[1])
    assert got == want


def test_copies_weigh_as_often_as_they_occur():
    g = resample.gains(np.array([3, 0]), np.array([0, 9]))
    assert g.tolist() == [math.floor(1000 * math.log(1 * 5 / (4 * 11))), math.floor(1000 * math.log(10 * 5 / (1 * 11)))]
