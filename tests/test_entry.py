"""End-to-end: the driver contract, and every SQL-checked plan against DuckDB."""

import math
import os

import pytest

import __spark_entry__ as E

SF = os.environ.get("PERIODFACT_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "\0null" if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["period", "winner"]


def test_every_query_has_a_callable():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(sql) >= 37


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_parity(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, got) == canon(ocols, res.fetchall())
