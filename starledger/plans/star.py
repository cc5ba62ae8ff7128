"""The gold star schema built from the role views (used by the summary
queries and the gold job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.scalars import code_to_key_expr
from starledger.operators.dims import build_role_dim, calendar_for, code_dim, extract_dim
from starledger.operators.joins import date_key_roles, enrich, lookup_roles
from starledger.plans import roles

# Business size codes of the role view (l_returnflag) -> key.
ROLE_SIZE_KEYS = {"A": 1, "R": 2}


DATE_ROLES = {"action_date": "action_date_key", "last_modified_date": "last_modified_key"}


def transaction_fact(spark: SparkSession, sf: str, customer: bool = False,
                     supplier: bool = False, orders: bool = True) -> DataFrame:
    """Fact with role-playing date keys.

    The calendar is derived from these same dates, so it covers every
    non-null date by construction and the left lookup always matches:
    the key is computed in place (no join, no second pass for bounds)."""
    txn = roles.transactions(spark, sf, customer=customer, supplier=supplier, orders=orders)
    date_roles = DATE_ROLES if orders or customer else {"action_date": "action_date_key"}
    return date_key_roles(txn, date_roles, drop_natural=False)


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """DimDate over the fiscal years of the facts' dates."""
    return calendar_for(roles.transactions(spark, sf), list(DATE_ROLES))


def calendar_lookup_fact(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(fact with keys from a calendar *join*, calendar) - the J3 form."""
    txn = roles.transactions(spark, sf)
    cal = calendar_for(txn, ["action_date", "last_modified_date"])
    fact = lookup_roles(txn, cal, DATE_ROLES, dim_on="calendar_date", dim_key="date_key", unique=True)
    return fact, cal


def assistance_fact(txn: DataFrame) -> DataFrame:
    return txn.where(F.col("award_type") == "assistance").select(
        "transaction_unique_key", "award_unique_key", "total_face_value_of_loan")


def sized_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Contract keys with the business size.  The inner lookup of a
    dimension cut from the same fact only drops rows with a null part, so a
    filter gives the rows of :func:`contract_fact` without building it."""
    txn = roles.transactions(spark, sf, part=True, orders=False).where(F.col("award_type") == "contract")
    txn = txn.where(F.col("naics_code").isNotNull() & F.col("naics_description").isNotNull())
    return txn.select("transaction_unique_key", "award_unique_key",
                      code_to_key_expr("business_size_code", ROLE_SIZE_KEYS).alias("business_size_key"))


def contract_fact(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(contract fact with naics and size keys, naics dim, size dim)."""
    txn = roles.transactions(spark, sf, part=True, orders=False).where(F.col("award_type") == "contract")
    naics, fact = extract_dim(txn.select("transaction_unique_key", "award_unique_key", "naics_code",
                                         "naics_description", "business_size_code"),
                              ["naics_code", "naics_description"], "naics_key",
                              null_rule=["naics_code"], how="inner")
    size, fact = code_dim(fact.withColumn("business_size", F.concat(F.lit("size "), "business_size_code")),
                          "business_size_code", "business_size", ROLE_SIZE_KEYS, "business_size_key")
    return fact.select("transaction_unique_key", "award_unique_key", "naics_key", "business_size_key"), naics, size


def agency_dim(txn: DataFrame) -> DataFrame:
    return build_role_dim(txn, [["awarding_agency_code", "awarding_agency_name"],
                                ["funding_agency_code", "funding_agency_name"]],
                          ["agency_code", "agency_name"])


def county_dim(spark: SparkSession, sf: str, txn: DataFrame, winners: DataFrame) -> DataFrame:
    """County role dimension enriched with gdp, population and winners
    (inner joins: counties missing in any source are dropped, Q17)."""
    county = build_role_dim(txn, [["prime_award_transaction_recipient_county_fips_code", "recipient_county_name"],
                                  ["prime_award_transaction_place_of_performance_county_fips_code",
                                   "primary_place_of_performance_county_name"]],
                            ["county_fips", "county_name"])
    out = enrich(county, [(roles.county_gdp(spark, sf), "county_fips", "fips_code"),
                          (roles.county_population(spark, sf), "county_fips", "fips_code"),
                          (winners, "county_fips", "county_fips")])
    return out.drop("county_name")
