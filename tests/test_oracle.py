"""Every query of the reference's operators against DuckDB on the same files."""

import glob
import math
import os

import pytest

from tessera import plans

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        where = f"{p}/*" if os.path.isdir(p) else p
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{where}')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    r = con.execute(ORACLE[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    assert got == sorted(repr(tuple(plain(dict(zip(names, row, strict=True))[c]) for c in cols)) for row in r.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
