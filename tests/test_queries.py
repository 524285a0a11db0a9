"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import glob
import math
import os

import pytest

from stemforge.plans import registry

DATA = os.environ.get("STEMFORGE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, (bool, int)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return str(v)


def compare(spark, queries, sql, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = queries[name](spark, DATA)
    r = con.execute(sql[name])
    names = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(names)
    a = sorted((tuple(plain(x[c]) for c in sorted(names)) for x in df.collect()), key=repr)
    b = sorted((tuple(plain(x[names.index(c)]) for c in sorted(names)) for x in r.fetchall()), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, name):
    compare(spark, registry.QUERIES, registry.SQL, name)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).columns


def test_sql_has_queries():
    assert set(registry.SQL) <= set(registry.QUERIES)
