"""Summary tables over the star schema.

Inputs are the published facts and dimensions.  Where a dimension only
labels a grouping key, the fact is aggregated first on the key and the
much smaller result is joined: the same numbers, with the join and the
final shuffle sized by the number of groups instead of fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.winners import first_per_group

_TXN = "transaction_unique_key"


def _grain(df: DataFrame, grain: str, dates: DataFrame | None) -> tuple[DataFrame, str]:
    """Attach the grouping period: the day key, or the month *name* (which
    merges years, Q19; ``month_year`` keeps them apart).

    With ``dates`` the month comes from an inner join with the calendar
    (AQE broadcasts it by its measured size), which also drops keys outside
    the calendar.  Without it the month is decoded
    from the ``yyyymmdd`` key, which is the same whenever the calendar
    covers the data (true by construction for a calendar derived from
    the fact's own dates)."""
    if grain == "day":
        return df, "action_date_key"
    if dates is None:
        key = F.col("action_date_key")
        joined = df.where(key.isNotNull()).withColumns({
            "calendar_month": F.date_format(F.make_date(F.lit(2000), (F.floor(key / 100) % 100).cast("int"),
                                                        F.lit(1)), "MMMM"),
            "calendar_year": F.floor(key / 10000).cast("int")})
    else:
        cal = dates.select(F.col("date_key").alias("action_date_key"), "calendar_month", "calendar_year")
        joined = df.join(cal, "action_date_key")
    if grain == "month":
        return joined, "calendar_month"
    if grain == "month_year":
        return joined.withColumn("calendar_year_month",
                                 F.concat_ws(" ", "calendar_month", F.col("calendar_year").cast("string"))), \
            "calendar_year_month"
    raise ValueError(grain)


def summary_by_award(txn: DataFrame, assistance: DataFrame) -> DataFrame:
    """Per award: max obligated, max loan face value, first action day."""
    j = txn.select(_TXN, "award_unique_key", "total_obligated_amount", "action_date_key").join(
        assistance.select(_TXN, "total_face_value_of_loan"), _TXN)
    return j.groupBy("award_unique_key").agg(
        F.max("total_obligated_amount").alias("total_obligated_amount"),
        F.max("total_face_value_of_loan").alias("total_face_value_of_loan"),
        F.min("action_date_key").alias("initial_action_date_key"))


def summary_totals_by_day(txn: DataFrame) -> DataFrame:
    """Transactions per action day."""
    return txn.groupBy("action_date_key").agg(F.count(_TXN).alias("number_of_transactions"))


def summary_agencies(txn: DataFrame, agency: DataFrame, grain: str = "day",
                     dates: DataFrame | None = None) -> DataFrame:
    """Funding agency rows per period and agency name."""
    pre = txn.groupBy("action_date_key", "funding_agency_code").agg(F.count(F.lit(1)).alias("_n"))
    j = pre.join(agency.select("agency_code", "agency_name"),
                 pre["funding_agency_code"] == agency["agency_code"])
    j, period = _grain(j, grain, dates)
    return j.groupBy(period, "agency_name").agg(F.sum("_n").alias("agency_count"))


def summary_recipients(txn: DataFrame, recipient: DataFrame, grain: str = "day",
                       dates: DataFrame | None = None) -> DataFrame:
    """Recipient rows per period and recipient name."""
    pre = txn.groupBy("action_date_key", "recipient_uei").agg(F.count(F.lit(1)).alias("_n"))
    j = pre.join(recipient.select("recipient_uei", "recipient_name_raw"), "recipient_uei")
    j, period = _grain(j, grain, dates)
    return j.groupBy(period, "recipient_name_raw").agg(F.sum("_n").alias("recipient_count"))


def summary_industries(txn: DataFrame, contract: DataFrame, naics: DataFrame, grain: str = "day",
                       dates: DataFrame | None = None) -> DataFrame:
    """Contract transactions per period and industry."""
    fact = txn.select(_TXN, "action_date_key").join(contract.select(_TXN, "naics_key"), _TXN)
    pre = fact.groupBy("action_date_key", "naics_key").agg(F.count(F.lit(1)).alias("_n"))
    j = pre.join(naics.select("naics_key", "naics_code", "naics_description"), "naics_key")
    j, period = _grain(j, grain, dates)
    return j.groupBy(period, "naics_code", "naics_description").agg(F.sum("_n").alias("industry_count"))


def summary_small_business(txn: DataFrame, contract: DataFrame, grain: str = "day",
                           dates: DataFrame | None = None) -> DataFrame:
    """Small-business and sized transactions per period."""
    fact = txn.select(_TXN, "action_date_key").join(contract.select(_TXN, "business_size_key"), _TXN)
    pre = fact.groupBy("action_date_key").agg(
        F.count(F.when(F.col("business_size_key") == 1, F.lit(1))).alias("_s"),
        F.count("business_size_key").alias("_t"))
    j, period = _grain(pre, grain, dates)
    return j.groupBy(period).agg(F.sum("_s").cast("long").alias("small_business_transactions"),
                                 F.sum("_t").cast("long").alias("total_transactions"))


COUNTY_ATTRIBUTES = ["ctyname", "stname", "gdp_2022", "popestimate2019", "popestimate2020",
                     "popestimate2021", "popestimate2022"]


def summary_by_county(txn: DataFrame, county: DataFrame,
                      fips_col: str = "prime_award_transaction_recipient_county_fips_code",
                      attributes=COUNTY_ATTRIBUTES) -> DataFrame:
    """Obligations by recipient county with county attributes.

    Both the count of obligated amounts and their sum are returned (Q7)."""
    attributes = list(attributes)
    pre = txn.groupBy(fips_col).agg(F.count("total_obligated_amount").alias("_c"),
                                    F.sum("total_obligated_amount").alias("_s"))
    j = pre.join(county.select("county_fips", *attributes), pre[fips_col] == county["county_fips"])
    return j.groupBy(fips_col, *attributes).agg(
        F.sum("_c").alias("obligation_count"), F.sum("_s").alias("obligation_sum")) \
        .withColumnRenamed("ctyname", "county_name").withColumnRenamed("stname", "state_name")


def award_by_date(txn: DataFrame, assistance: DataFrame) -> DataFrame:
    """Distinct (award, day, obligated, loan value) rows."""
    j = txn.select(_TXN, "award_unique_key", "action_date_key", "total_obligated_amount").join(
        assistance.select(_TXN, "total_face_value_of_loan"), _TXN)
    return j.select("award_unique_key", "action_date_key", "total_obligated_amount",
                    "total_face_value_of_loan").distinct()


def award_sums_by_day(award_dates: DataFrame) -> DataFrame:
    """Sums per day over :func:`award_by_date`."""
    return award_dates.groupBy("action_date_key").agg(
        F.sum("total_obligated_amount").alias("total_obligated_amount"),
        F.sum("total_face_value_of_loan").alias("total_face_value_of_loan"))


def award_sums_dedup(txn: DataFrame, assistance: DataFrame) -> DataFrame:
    """First transaction (smallest obligated amount, then transaction key,
    then loan value, so the choice is total) per award and day, summed per
    (day, award) (A18, W3)."""
    j = txn.where(F.col("action_date_key").isNotNull()).select(
        _TXN, "award_unique_key", "action_date_key", "total_obligated_amount").join(
        assistance.select(_TXN, "total_face_value_of_loan"), _TXN)
    first = first_per_group(j, ["award_unique_key", "action_date_key"],
                            ["total_obligated_amount", _TXN, "total_face_value_of_loan"],
                            columns=["total_obligated_amount", "total_face_value_of_loan"])
    # one row per (day, award): its values are the sums
    return first.select("action_date_key", "award_unique_key", "total_obligated_amount", "total_face_value_of_loan")
