"""The queries that SQL can express, against DuckDB on the same files."""
import duckdb
import pytest

from starledger.llm import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(q.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.fetchall()))
