import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starledger.functions import scalars as S
from starledger.operators.dims import calendar_dim


def test_pad_and_codes(spark):
    df = spark.createDataFrame([("1", "7", "3"), ("12345678", None, "12"), (None, "001", "0")], "a string, b string, d string")
    out = df.select(S.pad_code("a", 5).alias("p"), S.pad_one_zero("a", 5).alias("o"),
                    S.fips("a", "b").alias("f"), S.district_code("b", "d").alias("cd")).collect()
    assert out[0] == ("00001", "01", "17", "7-03")
    assert out[1] == ("12345678", "12345678", None, "12")   # longer codes stay; concat is null; concat_ws skips null
    assert out[2] == (None, None, None, "001-00")


def test_money_and_grouped_ints(spark):
    df = spark.createDataFrame([("12.345",), ("abc",), ("-3",), ("1,234,567",), ("3,000,000,000",), (None,)], "t string")
    out = df.select(S.to_money("t").alias("m"), S.grouped_int("t").alias("i"),
                    S.grouped_int("t", "bigint").alias("b")).collect()
    assert out[0].m == Decimal("12.35") and out[1].m is None and out[2].m == Decimal("-3.00")
    assert out[3].i == 1234567 and out[4].i is None and out[4].b == 3_000_000_000
    assert out[5] == (None, None, None)


def test_fiscal_calendar_golden_rows(spark):
    cal = calendar_dim(spark, "2018-10-01", "2025-09-30")
    assert cal.count() == 2557
    first = cal.where(F.col("calendar_date") == dt.date(2018, 10, 1)).first()
    assert first.date_key == 20181001 and first.calendar_day == "Monday" and first.day_of_week == 2
    assert first.is_weekday == "Y" and first.week_of_year_iso == 40
    assert first.fiscal_year == 2019 and first.fiscal_month == 1 and first.calendar_month == "October"
    leap = cal.where(F.col("calendar_date") == dt.date(2020, 2, 29)).first()
    assert leap.last_day_of_month == "Y" and leap.fiscal_year == 2020 and leap.fiscal_month == 5
    sunday = cal.where(F.col("calendar_date") == dt.date(2018, 10, 7)).first()
    assert sunday.is_weekday == "N" and sunday.day_of_week == 1
    assert cal.where(F.col("month_of_year") == 9).select(F.max("fiscal_month")).first()[0] == 12


def test_code_to_key_expr(spark):
    df = spark.createDataFrame([("S",), ("O",), ("X",), (None,)], "c string")
    out = [r[0] for r in df.select(S.code_to_key_expr("c", {"S": 1, "O": 2})).collect()]
    assert out == [1, 2, None, None]
