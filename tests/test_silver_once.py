"""Queries that put silver on storage compute it once; the officers' join by order."""
import datetime as dt

import pytest

from starledger.plans import io_queries, job_queries, roles, star
from tests.conftest import rows


@pytest.fixture()
def tables(spark, tmp_path):
    """Driver-shaped tables with null keys, repeated rows and keys that only nulls make equal."""
    d = dt.date(1996, 1, 1)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string, l_returnflag string, " \
           "l_extendedprice double, l_shipdate date"
    def one(order, part, supp, number, price, status="F"):
        return order, part, supp, number, status, "A", price, dt.date(1995 + (number or 0) % 4, 3, 1)
    made = {
        "lineitem": ([one(1, 2, 1, 1, 1.0), one(1, 2, 1, 1, 1.0), one(1, 2, 2, 2, 2.0), one(1, 2, None, 1, 3.0),
                      one(1, 2, 1, None, 4.0), one(2, None, 2, 1, 5.0, "O"), one(2, 2, None, 1, 6.0, "O"), one(None, 1, 1, 1, 7.0),
                      one(3, 1, None, 1, 8.0), one(9, 1, 1, 1, 9.0), one(4, 3, 3, 5, 10.0, "O")], line),
        "orders": ([(1, 1, d, 1.0, "5-LOW"), (2, 2, d, 2.0, "1-URGENT"), (2, 2, d, 2.0, "1-URGENT"), (3, 1, d, 3.0, None),
                    (4, 1, None, 4.0, "5-LOW"), (None, 1, d, 5.0, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double, o_orderpriority string"),
        "customer": ([(1, "C1", 0), (2, "C2", 1), (2, "C2", 1), (None, "C3", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "supplier": ([(1, "S1", 0), (2, "S2", 1), (2, "S2b", 1), (3, None, 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(0, "NATION_0"), (1, "NATION_1")], "n_nationkey int, n_name string"),
        "part": ([(1, "B1", "T1"), (2, "B2", "ECONOMY"), (3, "B3", "T3")], "p_partkey long, p_brand string, p_type string"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_officers_by_order_equal_the_join_by_transaction_key(spark, tables):
    txn = roles.transactions(spark, tables, customer=True, supplier=True)
    want = txn.join(roles.officer_slots(spark, tables), "transaction_unique_key")
    got = roles.transactions(spark, tables, customer=True, supplier=True, officers=True)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert got.count() > txn.count()    # shared keys meet each other


def test_gold_reads_the_driver_tables_once(spark, tables):
    gold = job_queries.gold_e8(spark, tables)
    for name, df in gold.items():
        assert not any("lineitem.parquet" in f for f in df.inputFiles()), name


def test_publish_reads_the_driver_tables_once(spark, tables, monkeypatch):
    seen = []
    agency, contracts = star.agency_dim, io_queries.gold_contracts
    monkeypatch.setattr(star, "agency_dim", lambda df: seen.append(df.inputFiles()) or agency(df))
    monkeypatch.setattr(io_queries, "gold_contracts", lambda df, **kw: seen.append(df.inputFiles()) or contracts(df, **kw))
    io_queries.publish_versioned(spark, tables)
    assert len(seen) == 3 and not any("lineitem.parquet" in f for files in seen for f in files)


def _scans(df, column):
    """File scans in the plan that read ``column``."""
    plan = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(any(plan.apply(i).output().apply(k).name() == column for k in range(plan.apply(i).output().size()))
               for i in range(plan.size()))


@pytest.mark.parametrize("limit", [roles.BROADCAST_MAX_BYTES, 0])
def test_officers_take_lines_once_with_suppliers_broadcast_or_not(spark, tables, monkeypatch, limit):
    monkeypatch.setattr(roles, "BROADCAST_MAX_BYTES", limit)
    want = roles.transactions(spark, tables, customer=True, supplier=True).join(
        roles.officer_slots(spark, tables), "transaction_unique_key")
    got = roles.transactions(spark, tables, customer=True, supplier=True, officers=True)
    assert rows(got) == rows(want)
    assert _scans(got, "l_orderkey") == 1
    hints = got._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")
    assert hints == (2 if limit else 0)


def test_silver_stores_no_texts_made_of_other_columns(spark, tables):
    silver = job_queries.silver_transactions(spark, tables)
    stored = spark.read.parquet(*silver.inputFiles()).columns
    assert "recipient_state_name" in silver.columns and "recipient_state_name" not in stored
