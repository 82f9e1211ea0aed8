"""Running totals, ranks and order statistics by ranges, against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import scan


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    v = [*rng.normal(0, 5, 3000).round(2).tolist(), *[1.25] * 1500, *[-7.0] * 40, 1e300, -1e300]
    rng.shuffle(v)
    rows = [(i, float(x), int(i % 7)) for i, x in enumerate(v)] + [(90_000, None, 1), (90_001, None, 2)]
    return spark.createDataFrame(rows, "id long, v double, w long").repartition(5), rows


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(values, descending):
    df, rows = values
    got = {r.id: (r.total, r.n) for r in scan.running(df, "v", {"total": F.col("w"), "n": F.lit(1)}, ("id",), descending, 6).collect()}
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1] if descending else r[1], r[0])) + [r for r in rows if r[1] is None]
    total = np.cumsum([r[2] for r in order])
    assert got == {r[0]: (int(t), k) for k, (r, t) in enumerate(zip(order, total, strict=True), 1)}


def test_ranks(values):
    df, rows = values
    got = {r.id: r["rank"] for r in scan.ranked(df.where("v is not null"), "v", ("id",)).collect()}
    assert got == {r[0]: k for k, r in enumerate(sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0])), 1)}


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert scan.running(df, "v", {"n": F.lit(1)}).count() == 0
    one = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    assert sorted(r.n for r in scan.running(one, "v", {"n": F.lit(1)}).collect()) == [1, 2, 3]


@pytest.mark.parametrize("few", [1, 50, 10_000])
def test_order_statistics(values, monkeypatch, few):
    df, rows = values
    monkeypatch.setattr(scan, "FEW", few)
    v = sorted(r[1] for r in rows if r[1] is not None)
    ranks = [0, 1, 17, 1500, 2270, 2271, len(v) - 2, len(v) - 1]
    assert scan.order_statistics(df, "v", ranks, 4) == [v[i] for i in ranks]
    with pytest.raises(ValueError, match="beyond"):
        scan.order_statistics(df, "v", [len(v)])


def test_quantiles_are_those_of_percentile(values):
    df, _ = values
    qs = [0.0, 0.01, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    want = df.agg(F.percentile("v", F.array(*map(F.lit, qs))).alias("q")).first().q
    assert scan.quantiles(df, "v", qs) == pytest.approx(want, rel=1e-12)
    assert scan.quantiles(df.where("v > 1e301"), "v", [0.5]) == [None]
    assert scan.quantiles(df.sparkSession.createDataFrame([(math.nan,), (3.0,)], "v double"), "v", [0.5]) == [3.0]
