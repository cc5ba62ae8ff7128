from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starledger.operators.winners import argmax_rows, first_per_group, pivot_first, top_per_group
from tests.conftest import rows

groups = st.one_of(st.none(), st.sampled_from(["g1", "g2"]))
votes = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(groups, st.sampled_from(["x", "y", "z"]), votes), max_size=14))
def test_top_per_group_equals_rank_one(spark, data):
    df = spark.createDataFrame(data, "g string, c string, v int")
    ranked = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).where("r = 1").drop("r")
    assert rows(top_per_group(df, ["g"], "v")) == rows(ranked)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), votes, st.integers(0, 50)), max_size=14, unique_by=lambda t: t[2]))
def test_first_per_group_equals_row_number_one(spark, data):
    df = spark.createDataFrame(data, "g string, amount int, key int")
    w = Window.partitionBy("g").orderBy("amount", "key")
    expected = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("g", "amount", "key")
    assert rows(first_per_group(df, ["g"], ["amount", "key"])) == rows(expected)


def test_argmax_rows_keeps_ties(spark):
    df = spark.createDataFrame([(2020, "01001", "A", "dem", 5), (2020, "01001", "B", "rep", 5),
                                (2020, "01001", "C", "grn", 1), (2016, "01001", "A", "dem", 3)],
                               "year int, county_fips string, candidate string, party string, total int")
    out = argmax_rows(df, ["year", "county_fips"], "total")
    assert sorted(r.party for r in out.collect()) == ["dem", "dem", "rep"]


def test_pivot_first_min_on_tie(spark):
    df = spark.createDataFrame([("01001", 2016, "Republican"), ("01001", 2020, "Democrat"),
                                ("01001", 2020, "Green"), ("01003", 2016, "Democrat")],
                               "county_fips string, year int, party string")
    out = pivot_first(df, "county_fips", "year", [2016, 2020], "party",
                      names={2016: "party_2016", 2020: "party_2020"}, ties="candidates")
    got = {r.county_fips: tuple(r)[1:] for r in out.collect()}
    assert got["01001"] == ("Republican", 1, "Democrat", 2)
    assert got["01003"] == ("Democrat", 1, None, 0)
