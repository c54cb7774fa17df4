"""Every query against its SQL twin on the given tables, and the driver contract."""

import os

import pytest

import __spark_entry__ as entry
from millrace.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v != v:
        return "NULL"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_twin(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    twin = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in twin.fetchall())
    assert got == want and got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0
