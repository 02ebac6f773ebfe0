import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_points
from weekgrid import plans

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = plans.all_queries(), plans.all_sql()  # the others are checked in tests/llm
TABLES = ["nation", "customer", "orders", "lineitem", "events"]
FEW = {"boosting": {"maxIter": 4}, "leafwise": {"rounds": 4}, "ordered": {"rounds": 4}}  # rounds of the fits in tests


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return v + 0.0 or 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def normal(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SMALL)
    cursor = oracle.execute(SQL[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    assert got == want
    assert got[1], "a check on no rows proves nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name, monkeypatch):
    from weekgrid.plans import models

    monkeypatch.setattr(models, "PARAMS", models.PARAMS | FEW)
    assert QUERIES[name](spark, SMALL).limit(1).count() == 1


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "sales_last_year" in df.columns and df.limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
