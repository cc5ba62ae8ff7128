import datetime as dt

from pyspark.sql import functions as F

from starledger.operators.dims import calendar_dim
from starledger.operators.joins import (
    date_key_roles, enrich, lookup_key, lookup_roles, lookup_roles_unpivot, outer_merge, resolve_code_by_name,
)
from tests.conftest import rows


def _fact(spark):
    return spark.createDataFrame([("t1", "a", "b", None, "c", "a", None), ("t2", "b", None, "b", "z", None, None),
                                  ("t3", None, None, None, None, None, None)],
                                 "k string, n1 string, n2 string, n3 string, n4 string, n5 string, extra string")


def _dim(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, code long")


def test_lookup_key_left_keeps_rows(spark):
    fact = _fact(spark)
    out = lookup_key(fact, _dim(spark), {"n1": "name"}, key="code", out="n1_code")
    assert out.count() == fact.count() and "n1" not in out.columns
    assert rows(out.select("k", "n1_code")) == [("t1", 1), ("t2", 2), ("t3", None)]


def test_role_lookup_strategies_agree(spark):
    fact, dim = _fact(spark), _dim(spark)
    roles = {f"n{i}": f"c{i}" for i in range(1, 6)}
    cols = ["k"] + [f"c{i}" for i in range(1, 6)] + ["extra"]
    per_role = lookup_roles(fact, dim, roles, "name", "code").select(*cols)
    broadcast = lookup_roles(fact, dim, roles, "name", "code", dim_bytes=100).select(*cols)
    unpivot = lookup_roles_unpivot(fact, dim, roles, "k", "name", "code").select(*cols)
    expected = [("t1", 1, 2, None, 3, 1, None), ("t2", 2, None, 2, None, None, None),
                ("t3", None, None, None, None, None, None)]
    assert rows(per_role) == rows(broadcast) == rows(unpivot) == expected


def test_repeating_dimension_gives_the_same_rows_in_every_form(spark):
    fact = spark.createDataFrame([("t1", "x", "y"), ("t2", "y", None)], "k string, a string, b string")
    dim = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "name string, code int")
    forms = [lookup_roles(fact, dim, {"a": "ca", "b": "cb"}, "name", "code", dim_bytes=n, max_bytes=10) for n in (None, 1, 11)]
    forms.append(lookup_roles_unpivot(fact, dim, {"a": "ca", "b": "cb"}, "k", "name", "code"))
    for form in forms:
        assert rows(form.select("k", "ca", "cb")) == [("t1", 2, 3), ("t2", 3, None)]


def test_date_key_without_join_equals_calendar_lookup(spark):
    cal = calendar_dim(spark, "2019-01-01", "2019-12-31")
    fact = spark.createDataFrame([("a", dt.date(2019, 3, 1)), ("b", dt.date(2020, 1, 1)), ("c", None)],
                                 "k string, d date")
    joined = lookup_roles(fact, cal, {"d": "dk"}, "calendar_date", "date_key", unique=True)
    computed = date_key_roles(fact, {"d": "dk"}, begin="2019-01-01", end="2019-12-31")
    assert rows(joined) == rows(computed) == [("a", 20190301), ("b", None), ("c", None)]


def test_enrich_inner_drops_missing(spark):
    county = spark.createDataFrame([("01001",), ("01003",)], "county_fips string")
    gdp = spark.createDataFrame([("01001", 5)], "fips_code string, gdp long")
    assert rows(enrich(county, [(gdp, "county_fips", "fips_code")])) == [("01001", 5)]


def test_outer_merge_multiplies_ties(spark):
    a = spark.createDataFrame([("AL", "01", "D"), ("AL", "01", "R")], "s string, d string, p18 string")
    b = spark.createDataFrame([("AL", "01", "R"), ("AK", "00", "R")], "s string, d string, p20 string")
    out = outer_merge([a, b], ["s", "d"])
    assert rows(out) == [("AK", "00", None, "R"), ("AL", "01", "D", "R"), ("AL", "01", "R", "R")]


def test_resolve_code_by_name(spark):
    gdp = spark.createDataFrame([("Autauga", "Alabama", "1,000")], "county string, state string, g string")
    ref = spark.createDataFrame([("01001", "Alabama", "Autauga"), ("01003", "Alabama", "Baldwin")],
                                "fips_code string, stname string, ctyname string")
    out = resolve_code_by_name(gdp, ref, {"state": "stname", "county": "ctyname"})
    assert [r.fips_code for r in out.collect()] == ["01001"]


def test_unpivot_lookup_is_exact_with_repeated_row_keys(spark):
    fact = spark.createDataFrame([("t1", "a", "b"), ("t1", "c", None), ("t2", None, None)],
                                 "k string, n1 string, n2 string")
    out = lookup_roles_unpivot(fact, _dim(spark), {"n1": "c1", "n2": "c2"}, "k", "name", "code")
    assert rows(out.select("k", "c1", "c2")) == [("t1", 1, 2), ("t1", 3, None), ("t2", None, None)]


def test_unpivot_lookup_computes_the_fact_once_and_shuffles_row_numbers(spark, tmp_path):
    spark.createDataFrame([("t1", "a", "b"), ("t1", "a", "b"), (None, "c", None), (None, None, None)],
                          "k string, n1 string, n2 string").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    out = lookup_roles_unpivot(fact, _dim(spark), {"n1": "c1", "n2": "c2"}, "k", "name", "code")
    assert not any(str(tmp_path) in f for f in out.inputFiles())
    assert "hashpartitioning(k" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out.select("k", "c1", "c2")) == [("t1", 1, 2), ("t1", 1, 2), (None, 3, None), (None, None, None)]
