"""End-to-end jobs run on role views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.plans import roles
from starledger.operators.merge import merge_increment_to
from starledger.operators.rejects import reject_report, rejects_of, silver_of
from starledger.plans.jobs.bronze import FISCAL_YEAR, bronze_to_silver, write_routed
from starledger.plans.jobs.externals import education_frame, unemployment_frame
from starledger.plans.jobs.gold import gold_contracts, gold_transactions
from starledger.plans.queries import register, widen
from starledger.session import scratch_path, store
from starledger.sources.files import write_sized
from starledger.sources.schemas import ASSISTANCE, CONTRACT, EDUCATION_COLUMNS, OFFICER_NAMES


def raw_assistance(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, all-text assistance extract built from lineitem x orders."""
    li = roles.table(spark, sf, "lineitem")
    od = roles.table(spark, sf, "orders")
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"]).where(F.col("l_linestatus") == "F")
    return j.select(
        F.concat_ws("_", roles.s("l_orderkey"), roles.s("l_partkey"), roles.s("l_suppkey"),
                    roles.s("l_linenumber"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
        .alias("assistance_transaction_unique_key"),
        roles.s("l_orderkey").alias("assistance_award_unique_key"),
        F.when(F.col("l_linenumber") == 1, F.lit("junk"))
         .otherwise(roles.s(roles.money("l_extendedprice"))).alias("federal_action_obligation"),
        F.when(F.col("l_linenumber") <= 2, roles.s(roles.money("o_totalprice"))).alias("total_face_value_of_loan"),
        roles.s(F.col("l_shipdate").cast("date")).alias("action_date"),
        roles.s(F.year("l_shipdate")).alias("action_date_fiscal_year"),
        roles.s(roles.money("l_tax")).alias("l_tax"),
        F.col("o_orderpriority").alias("primary_place_of_performance_scope"))


@register("b2s_job")
def b2s_job(spark: SparkSession, sf: str) -> DataFrame:
    return widen(bronze_to_silver(raw_assistance(spark, sf), ASSISTANCE))


def raw_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, all-text contract extract: six key parts, own money columns."""
    li = roles.table(spark, sf, "lineitem").where(F.col("l_linestatus") == "O")
    return li.select(
        F.concat_ws("_", roles.s("l_orderkey"), roles.s("l_partkey"), roles.s("l_suppkey"), roles.s("l_linenumber"),
                    F.col("l_linestatus"), F.when(F.col("l_linenumber") != 5, F.col("l_returnflag")))
        .alias("contract_transaction_unique_key"),
        roles.s("l_orderkey").alias("contract_award_unique_key"),
        F.when(F.col("l_linenumber") % 3 != 0, roles.s(roles.money("l_extendedprice"))).alias("federal_action_obligation"),
        F.when(F.col("l_linenumber") == 2, F.lit("n/a")).when(F.col("l_linenumber") < 6, roles.s(roles.money("l_quantity")))
        .alias("total_dollars_obligated"),
        roles.s(F.col("l_shipdate").cast("date")).alias("action_date"),
        roles.s(F.year("l_shipdate")).alias("action_date_fiscal_year"))


@register("b2s_contract_job")
def b2s_contract_job(spark: SparkSession, sf: str) -> DataFrame:
    return widen(bronze_to_silver(raw_contract(spark, sf), CONTRACT))


@register("rejects_routed")
def rejects_routed(spark: SparkSession, sf: str) -> DataFrame:
    """Raw contract rows, some without key or with words for years, routed
    to silver or to rejects in one pass; both read back, with reasons,
    untyped columns and raw text (P5, P8, P9, P11, E1)."""
    key, year = "contract_transaction_unique_key", "action_date_fiscal_year"
    number = F.col("contract_award_unique_key").cast("bigint")
    raw = raw_contract(spark, sf)
    raw = raw.withColumns({key: F.when(number % 11 != 0, F.col(key)),
                           year: F.when(number % 13 == 0, F.concat(F.lit("FY"), F.col(year))).otherwise(F.col(year))})
    path = scratch_path(spark, "routed")
    write_routed(spark, raw, CONTRACT, path)
    text = lambda c: F.concat_ws(",", c)
    kept = silver_of(spark, path).select(F.lit("silver").alias("outcome"), "transaction_unique_key", "award_unique_key",
                                         "total_obligated_amount", FISCAL_YEAR, F.lit("").alias("reasons"),
                                         F.lit(None).cast("string").alias("raw_amount"))
    gone = rejects_of(spark, path).select(F.lit("reject"), "transaction_unique_key", "award_unique_key", "total_obligated_amount",
                                          FISCAL_YEAR, text("reasons"), F.col("raw")["total_obligated_amount"])
    report = reject_report(spark, path).select(F.lit("report"), "kind", "code", F.lit(None).cast("decimal(18,2)"),
                                               F.col("n").cast("int"), F.lit(""), F.lit(None).cast("string"))
    return widen(kept.union(gone).union(report))


@register("b2s_year_merge")
def b2s_year_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Silver up to 1996 on storage, the years from 1996 on merged into it
    twice (E2): each row once."""
    silver = bronze_to_silver(raw_assistance(spark, sf), ASSISTANCE)
    path = scratch_path(spark, "silver-assistance")
    write_sized(silver.where(F.col(FISCAL_YEAR) <= 1996), path, ASSISTANCE.rows_per_file, partition_by=FISCAL_YEAR)
    new = silver.where(F.col(FISCAL_YEAR) >= 1996)
    for _ in range(2):
        merge_increment_to(spark, path, new, partition_col=FISCAL_YEAR, rows_per_file=ASSISTANCE.rows_per_file)
    return widen(spark.read.parquet(path).select(silver.columns))


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Silver-shaped rows of both families with agencies, places and officers.
    They lie on storage, as in the job: every dimension and both families
    read their columns of them.  Texts made of other columns are not stored."""
    txn = store(roles.transactions(spark, sf, customer=True, supplier=True, officers=True), "silver-transactions")
    return txn.withColumns({
        "recipient_state_code": F.substring("awarding_agency_name", 1, 2),
        "recipient_state_name": F.col("awarding_agency_name"),
        "prime_award_transaction_place_of_performance_state_fips_code": F.lpad("funding_agency_code", 2, "0"),
        "primary_place_of_performance_state_name": F.col("funding_agency_name")})


def gold_e8(spark: SparkSession, sf: str) -> dict:
    silver = silver_transactions(spark, sf)
    return gold_transactions(silver.where(F.col("award_type") == "assistance"),
                             silver.where(F.col("award_type") == "contract"))


@register("gold_transactions")
def gold_transactions_query(spark: SparkSession, sf: str) -> DataFrame:
    """FactTransaction of both families with its date, district and officer
    codes (E8)."""
    fact = gold_e8(spark, sf)["FactTransaction"]
    return widen(fact.select(
        "transaction_unique_key", "award_type", "total_obligated_amount", "action_date_key", "last_modified_key",
        "recipient_cd_code", "place_of_performance_cd_code", *[n.replace("_name", "_code") for n in OFFICER_NAMES]))


@register("gold_dims")
def gold_dims(spark: SparkSession, sf: str) -> DataFrame:
    """The shared dimensions of E8, their content as (table, code, name)."""
    gold = gold_e8(spark, sf)
    shape = {"DimAgency": ("agency_code", "agency_name"), "DimRecipient": ("recipient_uei", "recipient_name_raw"),
             "DimCounty": ("county_fips", None), "DimCongressionalDistrict": ("cd_code", "cd_original"),
             "DimState": ("state_abbreviation", "state_name"), "DimStateLetters": ("state_abbreviation", "state_name"),
             "DimHighlyCompensatedOfficer": ("hco_code", "hco_name"), "DimDate": ("date_key", "calendar_month")}
    out = None
    for table, (code, name) in shape.items():
        part = gold[table].select(F.lit(table).alias("table_name"), roles.s(code).alias("code"),
                                  roles.s(name if name else F.lit(None)).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


def silver_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Silver-shaped contract rows from the transaction role."""
    txn = roles.transactions(spark, sf, supplier=True, part=True).where(F.col("award_type") == "contract")
    return txn.select(
        "transaction_unique_key", "award_unique_key", "naics_code", "naics_description",
        F.col("funding_agency_code").alias("country_of_product_or_service_origin_code"),
        F.when(F.col("funding_agency_name") != "NATION_4", F.col("funding_agency_name"))
         .alias("country_of_product_or_service_origin"),
        F.col("business_size_code").alias("contracting_officers_determination_of_business_size_code"),
        F.concat(F.lit("size "), F.col("business_size_code"))
         .alias("contracting_officers_determination_of_business_size"))


@register("gold_job")
def gold_job(spark: SparkSession, sf: str) -> DataFrame:
    gold = gold_contracts(silver_contract(spark, sf), size_keys={"A": 1, "R": 2})
    return widen(gold["FactContract"])


@register("education_job")
def education_job(spark: SparkSession, sf: str) -> DataFrame:
    """Education rows (E4), one per customer: long headers, codes without
    leading zeros, grouped counts."""
    cu = roles.table(spark, sf, "customer")
    columns = []
    for i, (header, name) in enumerate(EDUCATION_COLUMNS.items()):
        if name == "fips_code":
            value = roles.s("c_custkey")
        elif name.startswith("perc_"):
            value = F.when(F.col("c_custkey") % 7 != i % 7, roles.s(F.col("c_nationkey") * 0.5 + i))
        else:
            value = F.when(F.col("c_custkey") % 5 == i % 5, F.lit("n/a")).otherwise(
                F.format_number(F.col("c_custkey") * 1000 * (i + 1), 0))
        columns.append(value.alias(header))
    return widen(education_frame(cu.select(*columns)))


@register("unemployment_job")
def unemployment_job(spark: SparkSession, sf: str) -> DataFrame:
    """Unemployment rows (E12), one per customer; national rows go."""
    cu = roles.table(spark, sf, "customer")
    raw = cu.select(
        roles.s("c_custkey").alias("fips_code"), F.when(F.col("c_nationkey") == 3, "US").otherwise("S").alias("State"),
        *[F.when(F.col("c_custkey") % 9 == 0, F.lit("-")).otherwise(roles.s(F.col("c_nationkey") * 0.25 + i))
          .alias(f"unemployment_rate_{y}") for i, y in enumerate((2019, 2020, 2021, 2022))],
        roles.s(F.col("c_custkey") * 10).alias("median_household_income_2021"))
    return unemployment_frame(raw)
