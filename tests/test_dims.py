from decimal import Decimal
from functools import reduce

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starledger.operators.dims import (
    build_dim, build_role_dim, code_dim, conform_union, extract_dim, fiscal_bounds,
)
from tests.conftest import rows

names = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(names, names, names, names), min_size=0, max_size=12))
def test_role_dim_single_scan_equals_union_distinct(spark, data):
    df = spark.createDataFrame(data, "c1 string, n1 string, c2 string, n2 string")
    single = build_role_dim(df, [["c1", "n1"], ["c2", "n2"]], ["code", "name"])
    union = df.select(F.col("c1").alias("code"), F.col("n1").alias("name")).union(
        df.select("c2", "n2")).distinct().dropna()
    assert rows(single) == rows(union)


def test_build_dim_unique_code(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", None), ("2", "z")], "c string, n string")
    assert rows(build_dim(df, ["c", "n"])) == [("1", "x"), ("1", "y"), ("2", "z")]
    assert rows(build_dim(df, ["c", "n"], unique_code=True)) == [("1", "x"), ("2", "z")]


def test_extract_dim_inner_and_left(spark):
    fact = spark.createDataFrame([("t1", "11", "Farm"), ("t2", "12", None), ("t3", "11", "Farm"),
                                  ("t4", None, "X")], "k string, code string, descr string")
    dim, inner = extract_dim(fact, ["code", "descr"], "key", null_rule=["code"], how="inner")
    assert rows(dim) == [(1, "11", "Farm"), (2, "12", None)]
    assert rows(inner) == [("t1", 1), ("t3", 1)]          # null description never matches (Q11)
    _, left = extract_dim(fact, ["code", "descr"], "key", null_rule=["code"], how="left")
    assert left.count() == fact.count()


def test_code_dim(spark):
    fact = spark.createDataFrame([("S", "small"), ("O", "other"), ("X", "?"), ("S", "small")], "c string, n string")
    dim, keyed = code_dim(fact, "c", "n", {"S": 1, "O": 2}, "k")
    assert rows(dim) == [(1, "S", "small"), (2, "O", "other")]
    assert keyed.where("k is null").count() == 1


def test_conform_union_aligns_types(spark):
    a = spark.createDataFrame([("k1", Decimal("1.50"))], "k string, m decimal(18,2)")
    b = spark.createDataFrame([("x", "k2", "2.25"), ("y", "k3", "bad")], "z string, k string, m string")
    out = conform_union(a, b)
    assert out.columns == ["k", "m"] and dict(out.dtypes)["m"] == "decimal(18,2)"
    assert [r.m is None for r in out.orderBy("k").collect()] == [False, False, True]


def test_fiscal_bounds_cover_whole_fiscal_years(spark):
    df = spark.createDataFrame([("2019-09-30", "2020-10-01")], "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    b = fiscal_bounds(df, ["a", "b"]).first()
    assert str(b.begin) == "2018-10-01" and str(b.end) == "2021-09-30"


def test_rekey_then_join_back_restores_natural_keys(spark):
    fact = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("code"),
                                   F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("n")).alias("name"))
    dim, rekeyed = extract_dim(fact, ["code", "name"], "key", null_rule=["code"], how="left")
    back = rekeyed.join(dim, "key", "left").select("k", "code", "name")
    # rows whose natural key has a null part cannot match and keep a null key
    expected = fact.where("name is not null").union(
        fact.where("name is null").select("k", F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert rows(back) == rows(expected)
    assert rekeyed.count() == fact.count()


def test_calendar_of_one_column_and_of_a_stray_date(spark):
    from starledger.operators.dims import calendar_for
    df = spark.sql("select date '2019-03-01' as d union all select null")
    cal = calendar_for(df, ["d"])
    assert cal.count() == 365 and cal.agg({"date_key": "min"}).first()[0] == 20181001
    stray = spark.sql("select date '2019-03-01' as d, date '9999-09-12' as e")
    long = calendar_for(stray, ["d", "e"])
    assert long.count() == (__import__("datetime").date(9999, 9, 30) - __import__("datetime").date(2018, 10, 1)).days + 1
    assert "Exchange" in long._jdf.queryExecution().executedPlan().toString()  # years are dealt out
