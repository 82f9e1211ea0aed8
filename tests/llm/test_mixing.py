import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from corpus import SCHEMA, documents
from tessera.llm import mixing


def walked(plan: mixing.Plan):
    for k in range(plan.periods):
        first, sources, units, rows = plan.slots(k)
        yield from zip(range(first, first + len(sources)), sources, units, rows, strict=True)


def shares(plan: mixing.Plan, weights: list[float]) -> list[Fraction]:
    return [Fraction(w) / sum(map(Fraction, weights)) for w in weights]


@pytest.mark.parametrize("seed", range(8))
def test_lag_is_below_one_block(seed):
    """Against the given weights, over many periods, until the first source ends."""
    rng = random.Random(seed)
    weights = [rng.choice([1, 2, 5, 0.1, 30]) * rng.random() + 1e-3 for _ in range(rng.randint(1, 30))]
    share = [float(x) for x in shares(None, weights)]
    plan = mixing.Plan([str(i) for i in range(len(weights))], [int(400_000 * w) + 20_000 for w in share], weights, 8)
    seen = [0] * len(weights)
    for slot, s, unit, _ in walked(plan):
        assert unit == seen[s]
        seen[s] += 1
        if seen[s] == plan.units[s]:
            break
        assert all(abs(n - w * (slot + 1)) < 2 - 1e-9 for n, w in zip(seen, share, strict=True))
    assert slot > 20_000


def test_unequal_sources_keep_to_their_weights():
    rows = [600_000, 250_000, 120_000, 30_000]
    weights = [float(n) ** 0.5 for n in rows]
    plan = mixing.Plan(list("abcd"), rows, weights, 1)
    share, seen, worst, later = [float(x) for x in shares(plan, weights)], [0] * 4, 0.0, 0.0
    for slot, s, _, _ in walked(plan):
        seen[s] += 1
        if slot < plan.ends[0]:
            worst = max(worst, *(abs(n - w * (slot + 1)) for n, w in zip(seen, share, strict=True)))
        elif slot % 37 == 0:  # the others go on with weights scaled up
            later = max(later, *(abs(n - float(plan.fluid(slot + 1, i))) for i, n in enumerate(seen)))
    assert plan.ends[0] > 50_000 and slot == sum(rows) - 1 and worst < 2 and later < 2


def fluid(rows: list[float], weights: list[float]):
    """The target of each source after each slot, by plain steps from end to end: what is left is shared by weight."""
    left, at, have = dict(enumerate(weights)), 0.0, [0.0] * len(rows)
    corners = [(0.0, list(have))]
    while left:
        whole = sum(left.values())
        step = min((rows[s] - have[s]) / (w / whole) for s, w in left.items())
        done = [s for s, w in left.items() if (rows[s] - have[s]) / (w / whole) <= step * (1 + 1e-12)]
        for s, w in left.items():
            have[s] += step * w / whole
        at += step
        for s in done:
            have[s] = float(rows[s])
            del left[s]
        corners.append((at, list(have)))
    times, counts = np.array([t for t, _ in corners]), np.array([c for _, c in corners])
    return lambda slots: np.stack([np.interp(slots, times, counts[:, s]) for s in range(len(rows))], 1)


CASES = {
    "four": ([6000, 2500, 1200, 300], None),
    "thirty": ([50 + int(5950 * i / 29) for i in range(30)], None),
    "sixty": ([8 + (i * 1777) % 1993 for i in range(60)], [random.Random(5).random() + i % 3 for i in range(60)]),
    "one large": ([40_000, *[16] * 300], None),
    "all end together": ([800] * 20, None),
}


@pytest.mark.parametrize("case", CASES)
def test_less_than_a_block_at_every_slot(case):
    """Also after sources end, against targets worked out here."""
    rows, weights = CASES[case]
    weights = weights or [float(n) ** 0.5 for n in rows]
    plan = mixing.Plan([str(i) for i in range(len(rows))], rows, weights, 8)
    want = fluid([-(-n // 8) for n in rows], weights)(np.arange(plan.total + 1))
    seen = np.zeros((plan.total + 1, len(rows)))
    for slot, s, _, _ in walked(plan):
        seen[slot + 1, s] = 1
    assert np.abs(np.cumsum(seen, 0) - want).max() < 2


def test_many_sources_have_a_plan():
    n = 100_001
    plan = mixing.Plan([str(i) for i in range(n)], [8 + i % 40 for i in range(n)], [1.0 + i % 7 for i in range(n)], 8)
    assert (np.diff(plan.before, axis=0) >= 0).all() and plan.before[-1].tolist() == plan.units
    assert plan.before.sum(1).tolist() == plan.cuts and plan.cuts[-1] == plan.total


def test_every_unit_has_one_slot_and_its_rows():
    rng = random.Random(4)
    for _ in range(30):
        unit = rng.choice([1, 3, 8])
        rows = [rng.choice([1, 7, 300, 2500]) for _ in range(rng.randint(1, 12))]
        plan = mixing.Plan([str(i) for i in range(len(rows))], rows, [rng.random() * rng.choice([1, 1e-9]) + 1e-12 for _ in rows], unit)
        seen, row = [0] * len(rows), 0
        for i, (slot, s, n, at) in enumerate(walked(plan)):
            assert (slot, n, at) == (i, seen[s], row)
            seen[s] += 1
            row += min(unit, rows[s] - n * unit)
        assert seen == plan.units and row == sum(rows)


def test_thousands_of_sources(spark):
    rng = random.Random(2)
    rows = [(i, f"host{rng.randrange(1500)}" if i % 3 else "hot") for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(5)
    got = mixing.mix(df).orderBy("mix_pos").collect()
    assert [r.mix_pos for r in got] == list(range(len(rows))) and sorted((r.doc_id, r.source) for r in got) == sorted(rows)
    assert len({r.source for r in got}) > 1001


def test_mix(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["big"] * 6 + ["mid"] * 3 + ["small", None]), "t") for i in range(3000)] + [(5, "mid", "t")] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_pos string").repartition(7)
    got = mixing.mix(df, {"big": 1, "mid": 1, "small": 1, "absent": 4}, block=4).orderBy("mix_pos").collect()
    assert [r.mix_pos for r in got] == list(range(len(rows)))
    assert sorted(str((r.doc_id, r.source)) for r in got) == sorted(str(r[:2]) for r in rows)
    size = Counter((r.source, r.mix_block) for r in got)
    assert max(size.values()) == 4 and sum(v < 4 for v in size.values()) <= 4
    seen: Counter = Counter()
    for t, r in enumerate(got[:600], 1):
        seen[r.source] += 1
        assert all(abs(seen[s] - t / 3) < 2 * 4 for s in ("big", "mid", "small"))
    again = mixing.mix(df.repartition(3), {"big": 1, "mid": 1, "small": 1}, block=4).orderBy("mix_pos").collect()
    assert [r.doc_id for r in again] == [r.doc_id for r in got]
    kept, mixing.BROADCAST = mixing.BROADCAST, 0
    try:
        joined = mixing.mix(df, {"big": 1, "mid": 1, "small": 1}, block=4).orderBy("mix_pos").collect()
    finally:
        mixing.BROADCAST = kept
    assert [r.doc_id for r in joined] == [r.doc_id for r in got]
    assert mixing.mix(df.limit(0)).count() == 0
    docs = spark.createDataFrame(documents(), SCHEMA)
    assert mixing.mix(docs).count() == docs.count()
