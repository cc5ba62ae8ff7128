from decimal import Decimal

from pyspark.sql import functions as F

from starledger.operators import clean as C
from starledger.plans.jobs.bronze import bronze_to_silver
from starledger.sources.schemas import ASSISTANCE, CONTRACT
from tests.conftest import rows

RAW_CONTRACT = [
    # key, award, obligation, total dollars, covid, size code, naics code, description
    ("A_B_C_D_E_F", "aw1", "10.00", "5", "1.5", "S", "11", "Farming"),          # clean
    ("A_B_C_D_E_G", "aw1", None, None, None, "O", "11", "Farming"),              # all money null -> dropped
    ("A_B_C_D_E_H", "aw2", "junk", "7.125", None, "X", "12", None),              # junk -> null, kept
    ("A_B_C_D_E_I", "aw2", "junk", "n/a", "bad", "S", "12", None),               # all junk -> dropped
    (None, "aw3", "1", "1", None, "S", "13", "Mining"),                          # null key -> dropped
    ("A_B_C", "aw3", "1", "1", None, "S", "13", "Mining"),                       # too few parts -> dropped
    ("A_B__D_E_F", "aw4", "-4.50", "1", None, "S", "13", "Mining"),              # empty part -> dropped
    ("A_B_C_D_E_F", "aw1", "10.00", "5", "1.5", "S", "11", "Farming"),          # exact duplicate, kept in silver
]
COLS = ("contract_transaction_unique_key contract_award_unique_key federal_action_obligation "
        "total_dollars_obligated obligated_amount_from_COVID-19_supplementals_for_overall_award "
        "contracting_officers_determination_of_business_size_code naics_code naics_description").split()


def test_bronze_to_silver_contract_rules(spark):
    raw = spark.createDataFrame(RAW_CONTRACT, COLS).withColumn("ignored_column", F.lit("x"))
    out = bronze_to_silver(raw, CONTRACT)
    assert "ignored_column" not in out.columns
    assert out.columns[0] == "transaction_unique_key" and "award_type" in out.columns
    got = rows(out.select("transaction_unique_key", "federal_action_obligation", "total_obligated_amount"))
    assert got == [("A_B_C_D_E_F", Decimal("10.00"), Decimal("5.00")),
                   ("A_B_C_D_E_F", Decimal("10.00"), Decimal("5.00")),
                   ("A_B_C_D_E_H", None, Decimal("7.13"))]
    assert dict(out.dtypes)["obligated_amount_from_COVID-19_supplementals_for_overall_award"] == "decimal(18,2)"


def test_assistance_key_needs_five_parts(spark):
    df = spark.createDataFrame([("a_b_c_d_e",), ("a_b_c_d",), ("a_b_c_d_",), ("x_a_b_c_d_e",)], "k string")
    kept = [r[0] for r in C.filter_key_shape(df, "k", ASSISTANCE.key_pattern).collect()]
    assert sorted(kept) == ["a_b_c_d_e", "x_a_b_c_d_e"]


def test_select_present_rename_tag(spark):
    df = spark.createDataFrame([(1, "n", 2.0)], "b int, a string, c double")
    out = C.tag(C.rename(C.select_present(df, ["a", "missing", "b"]), {"a": "name", "zz": "q"}), "t", "v")
    assert out.columns == ["name", "b", "t"] and out.first() == ("n", 1, "v")


def test_shared_columns_keeps_first_order(spark):
    a = spark.createDataFrame([], "z int, y int, x int")
    b = spark.createDataFrame([], "x int, y int, w int")
    assert C.shared_columns(a, b) == ["y", "x"]


def test_drop_rules(spark):
    df = spark.createDataFrame([(None, None, "k"), (1, None, None), (None, 2, "k2")], "a int, b int, k string")
    assert C.drop_all_null(df, ["a", "b"]).count() == 2
    assert C.require_key(df, ["k"]).count() == 2
    assert C.drop_all_null(df, ["not_here"]).count() == 3


def test_split_by_value(spark):
    df = spark.createDataFrame([(2018, "a"), (2020, "b"), (2020, "c")], "year int, v string")
    parts = C.split_by_value(df, "year", [2018, 2020, 2022])
    assert {k: v.count() for k, v in parts.items()} == {2018: 1, 2020: 2, 2022: 0}


def test_rejected_money_values_are_counted_during_the_write(spark):
    from pyspark.sql import Observation
    obs = Observation("rejects")
    raw = spark.createDataFrame(RAW_CONTRACT, COLS)
    bronze_to_silver(raw, CONTRACT, observation=obs).write.format("noop").mode("overwrite").save()
    m = obs.get
    assert m["rows"] == len(RAW_CONTRACT)
    assert m["rejected_federal_action_obligation"] == 2 and m["rejected_total_obligated_amount"] == 1
    assert m["rejected_obligated_amount_from_COVID-19_supplementals_for_overall_award"] == 1
