"""Queries over whole tables: as many rows as the table has; their SQL is compared in test_oracle."""

import os

import numpy as np
import pytest

from tessera import plans
from tessera.operators import guards
from tessera.operators import stats as M
from tessera.plans import bindings as B
from tessera.plans import nlq
from tessera.sources import table

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = plans.queries()


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("p1_names", lambda s: B.tiles(s, DATA).count()),
        ("p23_trim_events", lambda s: table(s, DATA, "lineitem").count()),
        ("p25_scanner_dates", lambda s: table(s, DATA, "orders").count()),
        ("s7_decode_categories", lambda s: B.tiles(s, DATA).count()),
        ("a41_coarse_state", lambda s: B.runs(s, DATA).select("dataset").distinct().count()),
        ("s8_image_index", lambda s: B.tiles(s, DATA).count()),
        ("p18_heatmap_scale", lambda s: B.tiles(s, DATA).select("slides", "hpc_id").distinct().count()),
        ("j20_letter_neighbours", lambda s: B.tiles(s, DATA).select("slides", "grid_col", "grid_row").distinct().count()),
        ("r20_participants", lambda s: B.tiles(s, DATA).count()),
        ("u3_union_by_name", lambda s: table(s, DATA, "customer").count() + table(s, DATA, "part").count()),
        ("r25_next_ids", lambda s: table(s, DATA, "customer").count()),
    ],
)
def test_query_covers_its_table(spark, name, rows):
    assert QUERIES[name](spark, DATA).count() == rows(spark)


def brute_c_index(rows):
    right = [None if a[2] is None or b[2] is None else (a[2] > b[2]) + (a[2] == b[2]) / 2 for a in rows if a[1] == 1 for b in rows if a[0] < b[0]]
    return round(sum(x or 0 for x in right) / len(right), 6), len(right)


def test_c_index_of_all_customers(spark):
    rows = [((r.c_custkey * 37) % 120 + 1, int(r.c_custkey % 3 != 0), (r.c_custkey * 13) % 29) for r in table(spark, DATA, "customer").select("c_custkey").collect()]
    assert QUERIES["m18_c_index"](spark, DATA).collect() == [brute_c_index(rows)]


def test_c_index_by_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(float(rng.normal()), int(rng.integers(0, 2)), None if i % 17 == 0 else float(rng.normal())) for i in range(300)]
    rows += [(float(rng.integers(0, 5)), int(rng.integers(0, 2)), float(rng.integers(0, 4))) for _ in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, time double, event int, score double")
    assert M.c_index(df, "time", "event", "score", "id").collect() == [brute_c_index(rows)]
    alone = M.c_index(df.limit(1), "time", "event", "score", "id").collect()
    assert alone == M.c_index(df.limit(0), "time", "event", "score", "id").collect() == [(None, 0)]


def test_slide_list_rules(spark):
    rows = [("a", "s", "TRUE "), ("\t", "s", "no"), ("b", "", "no"), ("c", " ", "y"), ("d", "s", "unverified"), ("e", "s", None), (None, None, None), ("f", None, "1")]
    df = spark.createDataFrame(rows, "slide_id string, samples string, is_tumour string")
    got = {r.slide_id: r.problem for r in guards.slide_list_problems(df).collect()}
    assert got == {"\t": "blank slide", "b": "not tumour", "c": "blank sample", "d": "not tumour", "e": "not tumour", None: "blank slide", "f": "blank sample"}
    assert "d" not in {r.slide_id for r in guards.slide_list_problems(df, verified=False).collect()}


def test_too_many_titles_are_refused(spark):
    asked = spark.createDataFrame([("cluster 10000",)], "q string")
    titles = spark.range(10_001).selectExpr("'cluster ' || id AS hpc_title", "CAST(id AS INT) AS hpc_id")
    with pytest.raises(ValueError, match="more than 10000 titles"):
        nlq.title_matches(asked, titles)
