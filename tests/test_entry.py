"""The driver contract and the oracle gate (Spark vs DuckDB) on sf0.001."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as ent
from starledger.plans.oracle import oracle_sql as base_oracle
from starledger.plans.queries import queries as base_queries
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events labels".split()
_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["action_date_key", "number_of_transactions"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(base_queries()) == set(base_oracle())
    assert set(base_queries()) <= set(ent.queries()) and set(base_oracle()) <= set(ent.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(base_oracle()))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    rel = duck.sql(ent.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {c: _DUCK.get(t, t.upper()) for c, t in df.dtypes}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _multiset(df.columns, [tuple(r) for r in df.collect()]) == _multiset(rel.columns, rel.fetchall())
