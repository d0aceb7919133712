"""Driver contract: entry() runs; every registered query with an oracle
matches DuckDB at sf0.001 (row count, columns, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(tuple(v.asDict().values()))
    return v


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["SNID", "ZCMB", "GENTYPE", "ndetect"]
    df.count()


def test_every_query_has_a_callable_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    a = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=str)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=str)
    assert a == b
