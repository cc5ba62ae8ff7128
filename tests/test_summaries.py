from decimal import Decimal

from starledger.operators import summaries as sm
from starledger.operators.dims import calendar_dim
from tests.conftest import rows

D = Decimal


def _star(spark):
    txn = spark.createDataFrame([
        ("t1", "aw1", 20190101, "F1", D("10.00"), "u1", "01001"),
        ("t2", "aw1", 20190101, "F1", D("5.00"), "u1", "01001"),
        ("t3", "aw1", 20190102, "F2", D("7.00"), "u2", "01003"),
        ("t4", "aw2", 20190201, "F2", None, "u2", "01001"),
        ("t5", "aw3", None, "F9", D("1.00"), "u3", None),
    ], "transaction_unique_key string, award_unique_key string, action_date_key int, funding_agency_code string, "
       "total_obligated_amount decimal(18,2), recipient_uei string, "
       "prime_award_transaction_recipient_county_fips_code string")
    assistance = spark.createDataFrame([("t1", D("100.00")), ("t2", D("50.00")), ("t3", D("70.00")), ("t4", None)],
                                       "transaction_unique_key string, total_face_value_of_loan decimal(18,2)")
    contract = spark.createDataFrame([("t3", 1, 1), ("t4", 1, 2), ("t5", 2, None)],
                                     "transaction_unique_key string, naics_key int, business_size_key int")
    agency = spark.createDataFrame([("F1", "Commerce"), ("F2", "Energy"), ("F2", "Energy Dept")],
                                   "agency_code string, agency_name string")
    naics = spark.createDataFrame([(1, "11", "Farming"), (2, "21", "Mining")],
                                  "naics_key int, naics_code string, naics_description string")
    return txn, assistance, contract, agency, naics


def test_day_summaries(spark):
    txn, assistance, contract, agency, naics = _star(spark)
    assert rows(sm.summary_totals_by_day(txn)) == [(20190101, 2), (20190102, 1), (20190201, 1), (None, 1)]
    assert rows(sm.summary_by_award(txn, assistance)) == [
        ("aw1", D("10.00"), D("100.00"), 20190101), ("aw2", None, None, 20190201)]
    # a code with two names is counted under both (Q22 parity)
    assert rows(sm.summary_agencies(txn, agency, "day")) == [
        (20190101, "Commerce", 2), (20190102, "Energy", 1), (20190102, "Energy Dept", 1),
        (20190201, "Energy", 1), (20190201, "Energy Dept", 1)]
    assert rows(sm.summary_industries(txn, contract, naics, "day")) == [
        (20190102, "11", "Farming", 1), (20190201, "11", "Farming", 1), (None, "21", "Mining", 1)]
    assert rows(sm.summary_small_business(txn, contract, "day")) == [
        (20190102, 1, 1), (20190201, 0, 1), (None, 0, 0)]


def test_month_grain_join_equals_decoded_month(spark):
    txn, assistance, contract, agency, naics = _star(spark)
    cal = calendar_dim(spark, "2018-10-01", "2019-09-30")
    joined = sm.summary_agencies(txn, agency, "month", cal)
    decoded = sm.summary_agencies(txn, agency, "month")
    assert rows(joined) == rows(decoded) == [
        ("February", "Energy", 1), ("February", "Energy Dept", 1), ("January", "Commerce", 2),
        ("January", "Energy", 1), ("January", "Energy Dept", 1)]
    assert rows(sm.summary_small_business(txn, contract, "month", cal)) == [("February", 0, 1), ("January", 1, 1)]


def test_county_and_award_tables(spark):
    txn, assistance, *_ = _star(spark)
    county = spark.createDataFrame([("01001", "Autauga", "Alabama", 10, 1, 2, 3, 4)],
                                   "county_fips string, ctyname string, stname string, gdp_2022 long, "
                                   "popestimate2019 int, popestimate2020 int, popestimate2021 int, popestimate2022 int")
    got = rows(sm.summary_by_county(txn, county))
    assert got == [("01001", "Autauga", "Alabama", 10, 1, 2, 3, 4, 2, D("15.00"))]   # count and sum (Q7)
    abd = sm.award_by_date(txn, assistance)
    assert abd.count() == 4
    assert rows(sm.award_sums_by_day(abd)) == [
        (20190101, D("15.00"), D("150.00")), (20190102, D("7.00"), D("70.00")), (20190201, None, None)]
    # first row per (award, day) by smallest amount then key
    assert rows(sm.award_sums_dedup(txn, assistance)) == [
        (20190101, "aw1", D("5.00"), D("50.00")), (20190102, "aw1", D("7.00"), D("70.00")),
        (20190201, "aw2", None, None)]


def test_month_year_grain_keeps_years_apart(spark):
    txn = spark.createDataFrame([("t1", 20190115, "F1"), ("t2", 20200110, "F1"), ("t3", 20190120, "F1")],
                                "transaction_unique_key string, action_date_key int, funding_agency_code string")
    agency = spark.createDataFrame([("F1", "Commerce")], "agency_code string, agency_name string")
    by_name = sm.summary_agencies(txn, agency, "month")
    by_year = sm.summary_agencies(txn, agency, "month_year")
    assert rows(by_name) == [("January", "Commerce", 3)]                          # years merged (Q19 parity)
    assert rows(by_year) == [("January 2019", "Commerce", 2), ("January 2020", "Commerce", 1)]
    cal = calendar_dim(spark, "2018-10-01", "2020-09-30")
    assert rows(sm.summary_agencies(txn, agency, "month_year", cal)) == rows(by_year)
