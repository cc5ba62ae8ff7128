"""Several loads: drifting headers, stable keys, keyed upserts."""
import os

import pytest
from pyspark.sql import functions as F

from starledger.operators.registry import load_fact, register_keys, rekey
from starledger.operators.upsert import latest_versions, read_index, upsert_to
from starledger.plans.jobs.bronze import job_b2s
from starledger.session import scratch_path
from starledger.sources.files import read_year
from starledger.sources.reconcile import header_report, read_csv_reconciled, read_headers
from starledger.streaming import ingest_new_files
from tests.conftest import rows
from tests.fixtures import write_landing


def land(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_columns_in_another_order_missing_and_extra(spark, tmp_path):
    path = land(tmp_path / "in [x] 100%", a="key,amount,agency\n1,10,A\n2,20,B\n", b="key,agency,amount\n3,C,30\n",
                c="﻿AMOUNT , key,note\n40,4,\"x, y\"\n", d="", e="key,amount,agency\n", f="key,amount,agency\n5,50,E\n")
    got = read_csv_reconciled(spark, path.replace("[", "\\[").replace("]", "\\]"))
    assert got.columns == ["key", "amount", "agency", "note"]
    assert rows(got) == [("1", "10", "A", None), ("2", "20", "B", None), ("3", "30", "C", None), ("4", "40", None, "x, y"),
                         ("5", "50", "E", None)]
    groups = read_headers(spark, path.replace("[", "\\[").replace("]", "\\]"))
    report = {(r.header, r.column): r.state for r in header_report(spark, groups).collect()}
    assert [len(g.files) for g in groups] == [3, 1, 1]
    assert report[2, "agency"] == "moved" and report[3, "agency"] == "missing" and report[3, "note"] == "extra"
    assert report[2, "key"] == "same" and (1, "note") not in report


def test_headers_are_read_without_the_rest_of_the_files(spark, tmp_path):
    path = land(tmp_path / "big", a="k,v\n" + "1,2\n" * 300_000, b="v,k\n" + "2,1\n" * 300_000)
    groups = read_headers(spark, path)
    assert [g.columns for g in groups] == [("k", "v"), ("v", "k")]
    got = read_csv_reconciled(spark, path, groups)
    assert got.where("k = '1' and v = '2'").count() == 600_000


def test_one_header_is_the_plain_scan_and_empty_folders(spark, tmp_path):
    path = land(tmp_path / "one", a="k,v\n1,2\n", b="k,v\n3,4\n")
    assert rows(read_csv_reconciled(spark, path)) == [("1", "2"), ("3", "4")]
    assert read_csv_reconciled(spark, land(tmp_path / "none", a="")).columns == []
    with pytest.raises(ValueError, match="twice"):
        read_csv_reconciled(spark, land(tmp_path / "twice", a="k,K\n1,2\n"))


def swap_columns(folder):
    """Rewrite every second file of a landing folder with its columns reversed."""
    import csv
    files = sorted(f for f in folder.iterdir() if f.suffix == ".csv")
    for f in files[::2]:
        with f.open(newline="") as source:
            lines = list(csv.reader(source))
        with f.open("w", newline="") as target:
            csv.writer(target).writerows(line[::-1] for line in lines)


@pytest.mark.parametrize("family", ["assistance", "contract"])
def test_bronze_job_year_and_stream_with_permuted_files(spark, tmp_path, family):
    plain, mixed = (write_landing(str(tmp_path / n), years=(2019, 2020)) for n in ("plain", "mixed"))
    swap_columns(tmp_path / "mixed" / family)
    want = spark.read.parquet(job_b2s(spark, plain, scratch_path(spark, "plain"), family))
    got = spark.read.parquet(job_b2s(spark, mixed, scratch_path(spark, "mixed"), family)).select(want.columns)
    assert rows(got) == rows(want) and want.count() > 0
    silver = scratch_path(spark, "mixed-stream")
    ingest_new_files(spark, mixed, silver, family, max_files_per_trigger=1)
    assert rows(spark.read.parquet(f"{silver}/{family}").select(want.columns)) == rows(want.distinct())
    for year in (2019, 2020):
        a, b = (read_year(spark, f"{p}/{family}", year) for p in (plain, mixed))
        assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(a.columns)))


def test_keys_stay_over_loads(spark):
    path = scratch_path(spark, "registry")
    first = register_keys(spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 5), (None, None)], "n string, m int"), path, ["n", "m"], "k")
    one = {(r.n, r.m): r.k for r in first.collect()}
    assert one == {(None, 5): 1, ("a", 2): 2, ("b", 1): 3}
    again = register_keys(spark.createDataFrame([("b", 1), ("0", 9), ("zz", 0)], "n string, m int"), path, ["n", "m"], "k")
    two = {(r.n, r.m): (r.k, r.load) for r in again.collect()}
    assert {x: k for x, (k, load) in two.items() if load == 1} == one
    assert two["0", 9] == (4, 2) and two["zz", 0] == (5, 2)
    files = {f for f in os.listdir(path.removeprefix("file:"))}
    assert register_keys(spark.createDataFrame([("zz", 0)], "n string, m int"), path, ["n", "m"], "k").count() == 5
    assert files == {f for f in os.listdir(path.removeprefix("file:"))}      # nothing new: nothing written
    fact = spark.createDataFrame([("a", 2, "x"), ("q", 0, "y"), (None, 5, "z")], "n string, m int, v string")
    assert rows(rekey(fact, again, ["n", "m"], "k")) == [("x", 2), ("z", 1)]
    assert rekey(fact, again, ["n", "m"], "k", how="left").count() == 3


def test_first_load_without_keys(spark):
    path = scratch_path(spark, "registry-empty")
    none = spark.createDataFrame([(None,)], "n string")
    assert register_keys(none, path, "n", "k").collect() == []
    register_keys(spark.createDataFrame([("a",)], "n string"), path, "n", "k")
    assert rows(register_keys(none, path, "n", "k").select("n", "k")) == [("a", 1)]


def test_only_touched_fact_partitions_are_rewritten(spark):
    base = scratch_path(spark, "fact-loads")
    keys = {"k": (f"{base}/keys", "n")}
    load_fact(spark.createDataFrame([("a", 2019), ("b", 2020)], "n string, fy int"), f"{base}/fact", keys, "fy")
    local = f"{base}/fact".removeprefix("file:")
    before = sorted(os.listdir(f"{local}/fy=2019"))
    load_fact(spark.createDataFrame([("0", 2020), ("a", 2021)], "n string, fy int"), f"{base}/fact", keys, "fy")
    assert sorted(os.listdir(f"{local}/fy=2019")) == before
    assert rows(spark.read.parquet(f"{base}/fact").select("fy", "k")) == [(2019, 1), (2020, 3), (2021, 1)]


def test_gold_keys_stay_when_a_year_is_added(spark):
    from starledger.plans.jobs.gold import gold_contracts
    cols = ["transaction_unique_key", "award_unique_key", "naics_code", "naics_description", "country_of_product_or_service_origin_code",
            "country_of_product_or_service_origin", "contracting_officers_determination_of_business_size_code",
            "contracting_officers_determination_of_business_size"]
    first = [("t1", "a1", "200", "b", "US", "usa", "S", "small"), ("t2", "a2", "300", "c", "CA", "canada", "S", "small")]
    more = [("t3", "a3", "100", "a", "ZZ", "z", "O", "other")]
    where = scratch_path(spark, "gold-keys")
    dims = []
    for load in (first, first + more):
        gold = gold_contracts(spark.createDataFrame(load, ", ".join(f"{c} string" for c in cols)), size_keys={"S": 1, "O": 2}, registry=where)
        dims.append({r.naics_code: r.naics_key for r in gold["DimNAICS"].collect()})
        facts = {r.transaction_unique_key: r.naics_key for r in gold["FactContract"].collect()}
    assert dims[0] == {"200": 1, "300": 2} and dims[1] == {"200": 1, "300": 2, "100": 3}
    assert facts == {"t1": 1, "t2": 2, "t3": 3}


SCHEMA = "k string, amount int, modified int, fy int, flag string"


def apply(spark, path, load):
    return upsert_to(spark, path, spark.createDataFrame(load, SCHEMA), "k", "modified", "fy", deleted=F.col("flag") == "D")


def test_corrections_deletions_moves_and_stale_versions(spark):
    path = scratch_path(spark, "upsert-test")
    first = [("a", 1, 1, 2019, None), ("b", 2, 1, 2019, None), ("c", 3, 1, 2020, None), ("c", 33, 2, 2020, None), ("d", 4, 5, 2021, None),
             (None, 9, 9, 2019, None), ("e", 5, None, 2019, None), ("g", 1, 1, None, None)]
    assert apply(spark, path, first) == {"inserted": 6, "updated": 0, "deleted": 0, "stale": 0}
    second = [("a", 10, 2, 2019, None), ("b", 2, 3, 2022, None), ("c", 33, 4, 2020, "D"), ("d", 40, 4, 2021, None), ("e", 50, 1, 2019, None),
              ("f", 6, 1, 2021, None), ("x", 0, 3, 2019, "D")]
    assert apply(spark, path, second) == {"inserted": 1, "updated": 3, "deleted": 1, "stale": 1}
    want = [("a", 10, 2019), ("b", 2, 2022), ("d", 4, 2021), ("e", 50, 2019), ("f", 6, 2021), ("g", 1, None)]
    table = lambda: rows(spark.read.parquet(path).select("k", "amount", "fy"))
    assert table() == sorted(want, key=str)
    assert not os.path.exists(f"{path.removeprefix('file:')}/fy=2020")          # its last row was deleted
    # a replay, an old version of the deleted row and one before a first deletion change nothing
    assert apply(spark, path, [*second, ("c", 3, 1, 2020, None), ("x", 7, 2, 2019, None)]) == {"inserted": 0, "updated": 0, "deleted": 0, "stale": 7}
    assert table() == sorted(want, key=str)
    assert apply(spark, path, [("c", 99, 9, 2019, None)]) == {"inserted": 1, "updated": 0, "deleted": 0, "stale": 0}
    entry = {r.k: (r.partition, r.version, r.deleted) for r in read_index(spark, path, "k").collect()}
    assert entry["b"] == (2022, 3, False) and entry["x"] == (None, 3, True) and entry["c"] == (2019, 9, False)


def test_other_partitions_keep_their_files(spark):
    path = scratch_path(spark, "upsert-files")
    apply(spark, path, [("a", 1, 1, 2019, None), ("b", 2, 1, 2020, None)])
    local = path.removeprefix("file:")
    before = sorted(os.listdir(f"{local}/fy=2019"))
    apply(spark, path, [("b", 3, 2, 2020, None), ("c", 1, 1, 2021, None)])
    assert sorted(os.listdir(f"{local}/fy=2019")) == before


def test_latest_version_of_a_hot_key_is_summed_before_the_shuffle(spark):
    hot = spark.range(20_000).select(F.lit("k").alias("k"), F.col("id").cast("int").alias("modified"), F.lit("x").alias("flag"))
    last = latest_versions(hot, "k", "modified", F.lit(False))
    assert [tuple(r) for r in last.collect()] == [("k", 19_999, "x")]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("max_by") >= 2 and "Window" not in plan


def test_equal_versions_prefer_the_deletion(spark):
    df = spark.createDataFrame([("a", 5, 1, 1, "D"), ("a", 9, 1, 1, None)], SCHEMA)
    assert latest_versions(df, "k", "modified", F.col("flag") == "D").first().flag == "D"


def _star(spark, rows_):
    txn = spark.createDataFrame(rows_, "transaction_unique_key string, award_unique_key string, action_date_key int, "
                                       "total_obligated_amount decimal(18,2), funding_agency_code string, recipient_uei string")
    loans = txn.select("transaction_unique_key", (F.length("transaction_unique_key") * 10).cast("decimal(18,2)").alias("total_face_value_of_loan"))
    return txn, loans


def test_refreshed_states_equal_a_rebuild(spark):
    from decimal import Decimal as D

    from starledger.operators import rollup as ro
    from starledger.operators import summaries as sm
    codes = {"agency": "funding_agency_code", "recipient": "recipient_uei"}
    first = [("t1", "a1", 20180930, D(5), "A", "r1"), ("t2", "a1", 20181001, D(5), "B", "r1"), ("t22", "a1", 20181001, D(5), "B", None),
             ("t3", "a2", 20200105, D(1), None, "r2"), ("t4", "a2", None, None, "A", "r2")]
    # fiscal 2019 corrected, 2020 emptied, 2021 new
    then = [first[0], ("t2", "a1", 20181002, D(7), "A", "r1"), first[4], ("t5", "a3", 20210301, D(2), "A", "r3")]
    base = scratch_path(spark, "states-test")
    for load, years in ((first, None), (then, [2019, 2020, 2021])):
        txn, loans = _star(spark, load)
        ro.store_states(ro.period_states(txn, codes, years), f"{base}/p", years)
        ro.store_states(ro.award_states(txn, loans, years), f"{base}/a", years)
        p, a = ro.read_states(spark, f"{base}/p"), ro.read_states(spark, f"{base}/a")
        agency = spark.createDataFrame([("A", "aa"), ("B", "bb"), ("A", "ab")], "agency_code string, agency_name string")
        assert rows(ro.totals_by_day(p)) == rows(sm.summary_totals_by_day(txn))
        for grain in ("day", "month", "month_year"):
            assert rows(ro.rows_by_name(p, "agency", agency, "agency_code", "agency_name", "n", grain)) == rows(sm.summary_agencies(txn, agency, grain))
        assert rows(ro.by_award(a)) == rows(sm.summary_by_award(txn, loans))
        assert rows(ro.award_dates(a)) == rows(sm.award_by_date(txn, loans))
        assert rows(ro.award_first_rows(a)) == rows(sm.award_sums_dedup(txn, loans))
    assert not os.path.exists(f"{base}/p/fiscal_year=2020".removeprefix("file:"))


def test_all_period_grains_come_from_one_scan(spark):
    from starledger.operators import rollup as ro
    path = scratch_path(spark, "one-scan")
    _star(spark, [("t1", "a1", 20180930, None, "A", "r1")])[0].write.parquet(path)
    plan = ro.period_states(spark.read.parquet(path), {"agency": "funding_agency_code", "recipient": "recipient_uei"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "Expand" in text and text.count("Exchange") == 1


def test_latest_versions_are_shuffled_once_and_stay_dealt_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "y", 5), ("a", 2, "y", 7), ("b", None, None, 1), (None, 1, "z", 1)],
                               "k string, v int, t string, n int")
    last = latest_versions(df, "k", "v", F.lit(False))
    plan = last.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert last.columns == df.columns and rows(last) == [("a", 2, "y", 7), ("b", None, None, 1)]


def test_stale_versions_are_counted_and_their_rows_not_staged(spark, monkeypatch):
    from starledger.operators import upsert
    path, seen = scratch_path(spark, "upsert"), []
    load = lambda r: upsert_to(spark, path, spark.createDataFrame(r, "k string, v int, fy int, t string"), "k", "v", "fy")
    load([("a", 2, 2020, "new"), ("b", 2, 2020, "new")])
    monkeypatch.setattr(upsert, "drop_path", lambda spark, p: seen.append(p))
    assert load([("a", 1, 2020, "old"), ("b", 2, 2020, "old"), ("c", 1, 2021, "new")]) == {
        "inserted": 1, "updated": 0, "deleted": 0, "stale": 2}
    staged = spark.read.parquet(f"{seen[-1]}/changes")
    assert rows(staged.select("k", "t", "_applies")) == [("c", "new", True), (None, None, False), (None, None, False)]
    assert rows(spark.read.parquet(path).select("k", "v", "fy", "t")) == [
        ("a", 2, 2020, "new"), ("b", 2, 2020, "new"), ("c", 1, 2021, "new")]
