from starledger.operators.govern import Policy, filter_for_principal, mask_columns, secured
from tests.conftest import rows


def _data(spark):
    fact = spark.createDataFrame([("t1", "013", "Acme"), ("t2", "017", None), ("t3", "999", "Zed")],
                                 "k string, awarding_agency_code string, recipient_name_raw string")
    agency = spark.createDataFrame([("013", "Department of Commerce"), ("017", "Gulf Coast Ecosystem Restoration Council"),
                                    ("018", "Gulf Coast Ecosystem Restoration Council")],
                                   "agency_code string, agency_name string")
    return fact, agency


def test_mask_never_leaks_and_keeps_nulls(spark):
    fact, _ = _data(spark)
    masked = mask_columns(fact, ["recipient_name_raw"], privileged=False)
    values = [r.recipient_name_raw for r in masked.collect()]
    assert sorted(v for v in values if v) == ["xxxx", "xxxx"] and None in values
    assert rows(mask_columns(fact, "recipient_name_raw", True)) == rows(fact)


def test_row_filter_per_principal(spark):
    fact, agency = _data(spark)
    assert filter_for_principal(fact, "awarding_agency_code", agency, "data engineer").count() == 3
    assert [r.k for r in filter_for_principal(fact, "awarding_agency_code", agency, "Department of Commerce").collect()] == ["t1"]
    assert [r.k for r in filter_for_principal(fact, "awarding_agency_code", agency,
                                              "Gulf Coast Ecosystem Restoration Council").collect()] == ["t2"]
    assert filter_for_principal(fact, "awarding_agency_code", agency, "Agency1").count() == 0


def test_secured_view(spark):
    fact, agency = _data(spark)
    policy = Policy(code_col="awarding_agency_code", agency=agency, masked=("recipient_name_raw",))
    assert rows(secured(fact, policy, "Department of Commerce")) == [("t1", "013", "xxxx")]
    assert rows(secured(fact, policy, "data engineer")) == rows(fact)


def test_default_principal_is_current_user(spark):
    fact, agency = _data(spark)
    # the test session's user owns no agency and is not an administrator
    assert filter_for_principal(fact, "awarding_agency_code", agency).count() == 0
