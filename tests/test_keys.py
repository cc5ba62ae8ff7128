from pyspark.sql import Window
from pyspark.sql import functions as F

from starledger.operators.keys import dense_key


def _frame(spark, n=500):
    return spark.range(n).select((F.col("id") * 7919 % 1000).cast("string").alias("code"),
                                 (F.col("id") % 3).cast("string").alias("name")).distinct()


def test_dense_key_equals_global_row_number(spark):
    df = _frame(spark)
    got = {(r.code, r.name): r.k for r in dense_key(df, ["code", "name"], "k").collect()}
    ref = {(r.code, r.name): r.k for r in df.withColumn("k", F.row_number().over(
        Window.orderBy("code", "name"))).collect()}
    assert got == ref
    assert sorted(got.values()) == list(range(1, len(got) + 1))


def test_dense_key_is_invariant_under_repartition(spark):
    df = _frame(spark)
    a = {tuple(r[:2]): r[2] for r in dense_key(df.repartition(1), ["code", "name"], "k", ranges=3).collect()}
    b = {tuple(r[:2]): r[2] for r in dense_key(df.repartition(17), ["code", "name"], "k", ranges=11).collect()}
    assert a == b


def test_dense_key_descending_and_tie_breakers(spark):
    df = spark.createDataFrame([("1", "b"), ("2", "a"), ("10", "z"), ("1", "a")], "c string, n string")
    out = sorted((r.k, r.c, r.n) for r in dense_key(df, [("c", "desc"), "n"], "k").collect())
    assert out == [(1, "2", "a"), (2, "10", "z"), (3, "1", "a"), (4, "1", "b")]


def test_dense_key_empty(spark):
    df = spark.createDataFrame([], "c string")
    assert dense_key(df, ["c"], "k").count() == 0

