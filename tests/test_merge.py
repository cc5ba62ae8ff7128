from pyspark.sql import functions as F

from starledger.operators.merge import merge_increment, merge_increment_to
from starledger.session import scratch_path
from tests.conftest import rows


def test_merge_increment_properties(spark):
    x = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "y int, v string")
    assert rows(merge_increment(x, x)) == rows(x.distinct())
    assert merge_increment(None, x).count() == 3          # first run: just the new rows


def test_staged_merge_rewrites_only_touched_years(spark):
    path = scratch_path(spark, "silver-test")
    first = spark.createDataFrame([(2019, "a"), (2019, "a"), (2020, "b")], "fy int, v string")
    merge_increment_to(spark, path, first, partition_col="fy")
    assert spark.read.parquet(path).count() == 3          # no silver yet: written as is
    new = spark.createDataFrame([(2020, "b"), (2020, "c"), (2021, "d")], "fy int, v string")
    merge_increment_to(spark, path, new, partition_col="fy")
    merge_increment_to(spark, path, new, partition_col="fy")  # replay is idempotent
    got = rows(spark.read.parquet(path).select("fy", "v"))
    assert got == [(2019, "a"), (2019, "a"), (2020, "b"), (2020, "c"), (2021, "d")]


def test_unpartitioned_merge(spark):
    path = scratch_path(spark, "silver-flat")
    a = spark.createDataFrame([(1,), (2,)], "k int")
    merge_increment_to(spark, path, a)
    merge_increment_to(spark, path, spark.createDataFrame([(2,), (3,)], "k int"))
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,)]


def test_touched_partitions_with_null_year(spark):
    from starledger.operators.merge import touched_partitions
    current = spark.createDataFrame([(2019, "a"), (None, "b"), (2020, "c")], "fy int, v string")
    new = spark.createDataFrame([(None, "x"), (2020, "y")], "fy int, v string")
    assert rows(current.where(touched_partitions(new, "fy")).select("v")) == [("b",), ("c",)]
    only_null = spark.createDataFrame([(None, "x")], "fy int, v string")
    assert rows(current.where(touched_partitions(only_null, "fy")).select("v")) == [("b",)]


def test_merge_takes_new_columns_and_leaves_no_staging(spark):
    import os
    from starledger.session import checkpoint_dir, scratch_path
    path = scratch_path(spark, "silver-columns")
    a = spark.createDataFrame([(2019, "x")], "fy int, k string")
    b = spark.createDataFrame([(2019, "y", 1.5), (2020, "z", 2.5)], "fy int, k string, extra double")
    assert merge_increment_to(spark, path, a, partition_col="fy") == 1
    assert merge_increment_to(spark, path, b, partition_col="fy") == 3
    got = sorted((r.fy, r.k, r.extra) for r in spark.read.option("mergeSchema", True).parquet(path).collect())
    assert got == [(2019, "x", None), (2019, "y", 1.5), (2020, "z", 2.5)]
    root = checkpoint_dir(spark).replace("file:", "") + "/starledger-scratch"
    assert not [d for d in os.listdir(root) if d.startswith("merge-")]


def test_first_load_as_is_or_distinct(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "a")], "fy int, k string")
    assert merge_increment(None, twice).count() == 2 and merge_increment(None, twice, dedupe_first=True).count() == 1
