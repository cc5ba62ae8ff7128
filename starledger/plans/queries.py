"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  Integer outputs are widened to bigint and money sums to
double so the results compare one-to-one with the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType, ByteType

from starledger.functions.scalars import district_code, fips, grouped_int, pad_code, pad_one_zero
from starledger.operators import summaries as sm
from starledger.operators.clean import (
    cast_cols, cast_money, drop_all_null, filter_key_shape, rename, require_key, select_present, tag,
)
from starledger.operators.asof import lookup_as_of, validity_dim
from starledger.operators.dims import (
    build_dim, build_role_dim, calendar_for, code_dim, conform_union, extract_dim,
)
from starledger.operators.govern import Policy, mask_columns, secured
from starledger.operators.joins import enrich, lookup_roles, lookup_roles_unpivot
from starledger.operators.keys import dense_key_sized
from starledger.operators.merge import merge_increment
from starledger.operators.outer import outer_merge_hot
from starledger.plans import roles, star
from starledger.session import scratch_path
from starledger.plans.jobs import externals as ext
from starledger.sources.schemas import ASSISTANCE_KEY_PATTERN

Q = dict()


def register(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def widen(df: DataFrame) -> DataFrame:
    """int -> bigint, decimal -> double (oracle conventions)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


# --------------------------------------------------------------------------
# Cleaning and typing (P*, F*)
# --------------------------------------------------------------------------

@register("clean_cast_money")
def clean_cast_money(spark: SparkSession, sf: str) -> DataFrame:
    li = roles.table(spark, sf, "lineitem")
    raw = li.select(
        F.when(F.col("l_linenumber") != 7, roles.txn_key()).alias("transaction_unique_key"),
        F.when(F.col("l_orderkey") % 10 == 0, F.lit("n/a"))
         .when(F.col("l_orderkey") % 10 == 1, F.lit(None))
         .otherwise(roles.s(roles.money("l_extendedprice"))).alias("federal_action_obligation"),
        F.when(F.col("l_partkey") % 3 == 0, F.concat(roles.s(roles.money("l_quantity")), F.lit("5")))
         .when(F.col("l_partkey") % 3 == 1, F.lit("abc")).alias("total_obligated_amount"),
        roles.s(F.year("l_shipdate")).alias("action_date_fiscal_year"))
    typed = cast_money(raw, ["federal_action_obligation", "total_obligated_amount"])
    typed = drop_all_null(typed, ["federal_action_obligation", "total_obligated_amount"])
    typed = require_key(typed, ["transaction_unique_key"])
    return widen(cast_cols(typed, {"action_date_fiscal_year": "int"}))


@register("clean_key_shape")
def clean_key_shape(spark: SparkSession, sf: str) -> DataFrame:
    li = roles.table(spark, sf, "lineitem")
    keyed = li.select(F.concat_ws(
        "_", roles.s("l_orderkey"), roles.s("l_partkey"),
        F.when(F.col("l_linenumber") != 2, roles.s("l_suppkey")), roles.s("l_linenumber"),
        F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).otherwise(F.lit(""))
    ).alias("transaction_unique_key"), "l_extendedprice")
    return filter_key_shape(keyed, "transaction_unique_key", ASSISTANCE_KEY_PATTERN)


@register("clean_grouped_int")
def clean_grouped_int(spark: SparkSession, sf: str) -> DataFrame:
    od = roles.table(spark, sf, "orders")
    text = od.select(pad_code("o_custkey", 5).alias("fips_code"), "o_orderkey",
                     F.format_number("o_totalprice", 0).alias("gdp_2022"))
    return text.select("fips_code", "o_orderkey", grouped_int("gdp_2022", "bigint").alias("gdp_2022"))


@register("project_present")
def project_present(spark: SparkSession, sf: str) -> DataFrame:
    cu = roles.table(spark, sf, "customer")
    kept = select_present(cu, ["c_custkey", "c_phone", "c_name", "c_comment", "c_acctbal", "c_mktsegment"])
    kept = rename(kept, {"c_custkey": "recipient_uei", "c_name": "recipient_name_raw", "c_missing": "x"})
    kept = tag(kept, "award_type", "customer")
    kept = kept.withColumn("balance_cents", F.floor(F.col("c_acctbal") * 100))
    return kept.drop("c_acctbal")


@register("code_to_key")
def code_to_key_query(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf, orders=False).where(F.col("award_type") == "contract")
    txn = txn.withColumn("business_size", F.concat(F.lit("size "), "business_size_code"))
    dim, _ = code_dim(txn, "business_size_code", "business_size", star.ROLE_SIZE_KEYS, "business_size_key")
    return widen(dim)


@register("filters_basic")
def filters_basic(spark: SparkSession, sf: str) -> DataFrame:
    cu = roles.table(spark, sf, "customer")
    named = cu.withColumn("c_name", F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")))
    kept = (named.where(F.col("c_nationkey").isin(1, 5, 7))            # value set
                 .where(F.col("c_acctbal") >= 0)                       # range
                 .where(F.col("c_mktsegment") != "BUILDING")           # column not projected
                 .where(F.col("c_name").isNotNull()))                  # null reject
    return widen(kept.select("c_custkey", "c_name", "c_nationkey"))


@register("fips_pad")
def fips_pad(spark: SparkSession, sf: str) -> DataFrame:
    cu = roles.table(spark, sf, "customer")
    na = roles.table(spark, sf, "nation")
    rg = roles.table(spark, sf, "region")
    j = cu.join(na, cu["c_nationkey"] == na["n_nationkey"]).join(rg, na["n_regionkey"] == rg["r_regionkey"])
    return widen(j.select(
        "c_custkey",
        fips(pad_code("c_nationkey", 2), pad_code(F.col("c_custkey") % 1000, 3)).alias("fips_code"),
        pad_one_zero("c_nationkey", 2).alias("one_zero_code"),
        pad_code("c_custkey", 3).alias("padded_code"),
        district_code("r_name", "c_nationkey").alias("district_code"),
        district_code(F.when(F.col("c_custkey") % 2 == 0, F.col("r_name")), F.col("c_custkey") % 100)
        .alias("district_code_nulls")))


@register("union_families")
def union_families(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf)
    assistance = txn.where(F.col("award_type") == "assistance").select(
        "transaction_unique_key", "award_unique_key", "total_face_value_of_loan",
        "total_obligated_amount", "action_date", "award_type")
    contract = txn.where(F.col("award_type") == "contract").select(
        "award_type", "business_size_code", roles.s("total_obligated_amount").alias("total_obligated_amount"),
        "transaction_unique_key", "action_date", "award_unique_key")
    return widen(conform_union(assistance, contract))


@register("merge_increment")
def merge_increment_query(spark: SparkSession, sf: str) -> DataFrame:
    li = roles.table(spark, sf, "lineitem")
    rows = li.select(roles.s("l_orderkey").alias("award_unique_key"),
                     F.year("l_shipdate").alias("action_date_fiscal_year"), "l_returnflag")
    # the existing history up to 1997 and a new load from 1997 on: every
    # row takes part and the overlapping year is deduplicated
    current = rows.where(F.col("action_date_fiscal_year") <= 1997)
    new = rows.where(F.col("action_date_fiscal_year") >= 1997)
    return widen(merge_increment(current, new))


# --------------------------------------------------------------------------
# Dimensions and keys (D*, W2, W4, J1-J5)
# --------------------------------------------------------------------------

@register("dim_natural")
def dim_natural(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf, part=True, orders=False).where(F.col("award_type") == "assistance")
    return build_dim(txn, ["naics_code", "naics_description"], names=["cfda_number", "cfda_title"])


@register("dim_two_roles")
def dim_two_roles(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf, customer=True, supplier=True)
    txn = txn.withColumn("awarding_agency_name",
                         F.when(F.col("awarding_agency_name") != "NATION_3", F.col("awarding_agency_name")))
    return star.agency_dim(txn)


OFFICER_ROLES = {f"highly_compensated_officer_{i}_name": f"highly_compensated_officer_{i}_code" for i in range(1, 6)}


def _officer_dim(spark: SparkSession, sf: str):
    # every line of an order has the same officers
    slots = roles.order_officers(spark, sf).where(F.col("l_orderkey").isNotNull())
    names = build_role_dim(slots, [[f"highly_compensated_officer_{i}_name"] for i in range(1, 6)], ["hco_name"])
    return dense_key_sized(names, ["hco_name"], "hco_code")


@register("dim_five_roles")
def dim_five_roles(spark: SparkSession, sf: str) -> DataFrame:
    return _officer_dim(spark, sf)[0]


@register("dim_dense_rekey_inner")
def dim_dense_rekey_inner(spark: SparkSession, sf: str) -> DataFrame:
    fact, naics, _ = star.contract_fact(spark, sf)
    return widen(fact.select("transaction_unique_key", "naics_key"))


@register("dim_dense_desc")
def dim_dense_desc(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf, supplier=True, orders=False).where(F.col("award_type") == "contract")
    dim, _ = extract_dim(txn, ["funding_agency_code", "funding_agency_name"], "country_of_origin_key",
                         order=[("funding_agency_code", "desc"), "funding_agency_name"],
                         names=["country_of_origin_code", "country_of_origin"])
    return widen(dim)


@register("dim_rekey_left")
def dim_rekey_left(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf).where(F.col("award_type") == "assistance")
    _, fact = extract_dim(txn.select("transaction_unique_key", "primary_place_of_performance_scope"),
                          ["primary_place_of_performance_scope"], "primary_place_of_performance_scope_code",
                          how="left", key_type="long")
    return fact


@register("calendar")
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf)
    return widen(calendar_for(txn, ["action_date", "last_modified_date"]))


@register("role_dates")
def role_dates(spark: SparkSession, sf: str) -> DataFrame:
    fact, _ = star.calendar_lookup_fact(spark, sf)
    return widen(fact.select("transaction_unique_key", "action_date_key", "last_modified_key"))


def _district_dim(txn: DataFrame, sized: bool = False):
    cds = build_role_dim(txn, [["prime_award_transaction_recipient_cd_original"],
                               ["prime_award_transaction_place_of_performance_cd_original"]], ["cd_original"])
    keyed, size = dense_key_sized(cds, ["cd_original"], "cd_code")
    return (keyed, size) if sized else keyed


@register("role_pair")
def role_pair(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf)
    cd, cd_bytes = _district_dim(txn, sized=True)
    out = lookup_roles(txn.select("transaction_unique_key", "prime_award_transaction_recipient_cd_original",
                                  "prime_award_transaction_place_of_performance_cd_original"), cd,
                       {"prime_award_transaction_recipient_cd_original": "recipient_cd_code",
                        "prime_award_transaction_place_of_performance_cd_original": "place_of_performance_cd_code"},
                       dim_on="cd_original", dim_key="cd_code", unique=True, dim_bytes=cd_bytes)
    return out


@register("role_pair_unpivot")
def role_pair_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`role_pair` in the form for a large dimension."""
    txn = roles.transactions(spark, sf)
    return lookup_roles_unpivot(
        txn.select("transaction_unique_key", "prime_award_transaction_recipient_cd_original",
                   "prime_award_transaction_place_of_performance_cd_original"), _district_dim(txn),
        {"prime_award_transaction_recipient_cd_original": "recipient_cd_code",
         "prime_award_transaction_place_of_performance_cd_original": "place_of_performance_cd_code"},
        "transaction_unique_key", "cd_original", "cd_code")


@register("role_five")
def role_five(spark: SparkSession, sf: str) -> DataFrame:
    slots = roles.officer_slots(spark, sf)
    dim, dim_bytes = _officer_dim(spark, sf)
    return lookup_roles(slots, dim, OFFICER_ROLES, "hco_name", "hco_code", unique=True, dim_bytes=dim_bytes)


@register("role_five_unpivot")
def role_five_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`role_five` in the form for a large dimension."""
    return lookup_roles_unpivot(roles.officer_slots(spark, sf), _officer_dim(spark, sf)[0], OFFICER_ROLES,
                                "transaction_unique_key", "hco_name", "hco_code")


# --------------------------------------------------------------------------
# Winners, enrichment, externals
# --------------------------------------------------------------------------

@register("winner_rank")
def winner_rank(spark: SparkSession, sf: str) -> DataFrame:
    return widen(ext.house_winners(roles.house_results(spark, sf)))


@register("winner_outer_years")
def winner_outer_years(spark: SparkSession, sf: str) -> DataFrame:
    return ext.district_parties(ext.house_winners(roles.house_results(spark, sf)))


@register("winner_pivot_years")
def winner_pivot_years(spark: SparkSession, sf: str) -> DataFrame:
    """District parties per year as one pivot (A5): one row per district,
    the smallest party on a tie."""
    return ext.district_parties(ext.house_winners(roles.house_results(spark, sf)), method="pivot")


@register("winner_sum_lines")
def winner_sum_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Winners when a candidate's party lines are added up (Q13 option)."""
    return widen(ext.house_winners(roles.house_results(spark, sf), sum_lines=True))


@register("dim_state_tagged")
def dim_state_tagged(spark: SparkSession, sf: str) -> DataFrame:
    """State role dimension mixing two code systems, kept apart by a tag (Q4)."""
    txn = roles.transactions(spark, sf, customer=True, supplier=True)
    txn = txn.withColumn("recipient_state_code", F.substring("awarding_agency_name", 1, 2)).withColumn(
        "place_state_fips", F.lpad("funding_agency_code", 2, "0"))
    return build_role_dim(txn, [["recipient_state_code", "awarding_agency_name"],
                                ["place_state_fips", "funding_agency_name"]],
                          ["state_abbreviation", "state_name"], role_tag="code_system",
                          role_names=["letters", "fips"])


@register("winner_joinback_pivot")
def winner_joinback_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return ext.presidential_frame(roles.county_results(spark, sf))


@register("enrich_county")
def enrich_county(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf, customer=True, supplier=True)
    winners = ext.presidential_frame(roles.county_results(spark, sf))
    return widen(star.county_dim(spark, sf, txn, winners))


@register("enrich_district")
def enrich_district(spark: SparkSession, sf: str) -> DataFrame:
    txn = roles.transactions(spark, sf)
    parties = ext.district_parties(ext.house_winners(roles.house_results(spark, sf)))
    return enrich(_district_dim(txn), [(parties, "cd_original", "congressional_district")])


@register("resolve_by_name")
def resolve_by_name(spark: SparkSession, sf: str) -> DataFrame:
    na = roles.table(spark, sf, "nation")
    rg = roles.table(spark, sf, "region")
    su = roles.table(spark, sf, "supplier")
    codes = na.join(rg, na["n_regionkey"] == rg["r_regionkey"]).select(
        pad_code("n_regionkey", 2).alias("state"), pad_code("n_nationkey", 3).alias("county"),
        F.col("r_name").alias("stname"), F.concat("n_name", F.lit(" County")).alias("ctyname"))
    named = su.join(na, su["s_nationkey"] == na["n_nationkey"]).join(rg, na["n_regionkey"] == rg["r_regionkey"])
    gdp = named.groupBy(F.col("r_name").alias("state"), F.col("n_name").alias("county")).agg(
        F.format_number(F.floor(F.sum(roles.money("s_acctbal"))), 0).alias("gdp_2022"))
    gdp = gdp.withColumn("gdp_2019", F.lit("1,000")).withColumn("gdp_2020", F.lit("x")) \
             .withColumn("gdp_2021", F.lit("3,000,000,000"))
    return ext.gdp_frame(gdp, codes)


@register("merge_vintages")
def merge_vintages_query(spark: SparkSession, sf: str) -> DataFrame:
    od = roles.table(spark, sf, "orders")
    cu = roles.table(spark, sf, "customer")
    j = od.join(cu, od["o_custkey"] == cu["c_custkey"])

    def vintage(odd, name):  # every order belongs to one of the two
        return j.where(F.year("o_orderdate") % 2 == odd).groupBy(
            F.col("c_nationkey").alias("state"), F.col("c_custkey").alias("county")).agg(
            F.count(F.lit(1)).cast("string").alias(name))
    return widen(ext.population_frame(vintage(0, "popestimate2019"), vintage(1, "popestimate2020"),
                                      older_cols=("popestimate2019",), newer_cols=("popestimate2020",)))


# --------------------------------------------------------------------------
# Summaries
# --------------------------------------------------------------------------

def _facts(spark: SparkSession, sf: str, customer: bool = False, supplier: bool = False, orders: bool = True):
    """Star fact and the calendar that the month summaries join."""
    return star.transaction_fact(spark, sf, customer, supplier, orders), star.calendar(spark, sf)


@register("summary_totals_by_day")
def summary_totals_by_day(spark, sf):
    txn, _ = _facts(spark, sf, orders=False)
    return widen(sm.summary_totals_by_day(txn))


@register("summary_by_award")
def summary_by_award(spark, sf):
    txn, _ = _facts(spark, sf)
    return widen(sm.summary_by_award(txn, star.assistance_fact(txn)))


@register("summary_agencies_day")
def summary_agencies_day(spark, sf):
    txn, _ = _facts(spark, sf, customer=True, supplier=True)
    return widen(sm.summary_agencies(txn, star.agency_dim(txn), "day"))


@register("summary_agencies_month")
def summary_agencies_month(spark, sf):
    txn, cal = _facts(spark, sf, customer=True, supplier=True)
    return widen(sm.summary_agencies(txn, star.agency_dim(txn), "month", cal))


@register("summary_industries_day")
def summary_industries_day(spark, sf):
    txn, _ = _facts(spark, sf, orders=False)
    contract, naics, _ = star.contract_fact(spark, sf)
    return widen(sm.summary_industries(txn, contract, naics, "day"))


@register("summary_industries_month")
def summary_industries_month(spark, sf):
    txn, cal = _facts(spark, sf, orders=False)
    contract, naics, _ = star.contract_fact(spark, sf)
    return widen(sm.summary_industries(txn, contract, naics, "month", cal))


@register("summary_small_business_day")
def summary_small_business_day(spark, sf):
    txn, _ = _facts(spark, sf, orders=False)
    contract = star.sized_contracts(spark, sf)
    return widen(sm.summary_small_business(txn, contract, "day"))


@register("summary_small_business_month")
def summary_small_business_month(spark, sf):
    txn, cal = _facts(spark, sf, orders=False)
    contract = star.sized_contracts(spark, sf)
    return widen(sm.summary_small_business(txn, contract, "month", cal))


@register("summary_by_county")
def summary_by_county(spark, sf):
    txn, _ = _facts(spark, sf, customer=True, supplier=True)
    winners = ext.presidential_frame(roles.county_results(spark, sf))
    county = star.county_dim(spark, sf, txn, winners)
    na = roles.table(spark, sf, "nation")
    rg = roles.table(spark, sf, "region")
    names = na.join(rg, na["n_regionkey"] == rg["r_regionkey"]).select(
        pad_code("n_nationkey", 5).alias("fips_code"), F.col("n_name").alias("ctyname"),
        F.col("r_name").alias("stname"))
    county = enrich(county, [(names, "county_fips", "fips_code")])
    return widen(sm.summary_by_county(txn, county, attributes=sm.COUNTY_ATTRIBUTES))


@register("summary_recipients")
def summary_recipients(spark, sf):
    txn, _ = _facts(spark, sf, customer=True)
    recipient = build_dim(txn, ["recipient_uei", "recipient_name_raw"])
    return widen(sm.summary_recipients(txn, recipient, "day"))


@register("summary_recipients_month")
def summary_recipients_month(spark, sf):
    txn, cal = _facts(spark, sf, customer=True)
    recipient = build_dim(txn, ["recipient_uei", "recipient_name_raw"])
    return widen(sm.summary_recipients(txn, recipient, "month", cal))


@register("summary_agencies_month_year")
def summary_agencies_month_year(spark, sf):
    """The grain that keeps the months of different years apart (Q19)."""
    txn, cal = _facts(spark, sf, customer=True, supplier=True)
    return widen(sm.summary_agencies(txn, star.agency_dim(txn), "month_year", cal))


@register("award_by_date")
def award_by_date(spark, sf):
    txn, _ = _facts(spark, sf)
    return widen(sm.award_by_date(txn, star.assistance_fact(txn)))


@register("award_sums_by_day")
def award_sums_by_day(spark, sf):
    txn, _ = _facts(spark, sf)
    return widen(sm.award_sums_by_day(sm.award_by_date(txn, star.assistance_fact(txn))))


@register("award_sums_dedup")
def award_sums_dedup(spark, sf):
    txn, _ = _facts(spark, sf)
    return widen(sm.award_sums_dedup(txn, star.assistance_fact(txn)))


# --------------------------------------------------------------------------
# Governance
# --------------------------------------------------------------------------

@register("mask_columns")
def mask_columns_query(spark, sf):
    cu = roles.table(spark, sf, "customer")
    recipient = cu.select(roles.s("c_custkey").alias("recipient_uei"),
                          F.when(F.col("c_custkey") % 13 != 0, F.col("c_name")).alias("recipient_name_raw"))
    clear = tag(mask_columns(recipient, ["recipient_name_raw"], True), "principal", "data engineer")
    masked = tag(mask_columns(recipient, ["recipient_name_raw"], False), "principal", "NATION_7")
    return clear.unionByName(masked)


@register("mask_officers")
def mask_officers(spark, sf):
    """Officer dimension as seen by an administrator and by an agency user."""
    dim = dim_five_roles(spark, sf)
    clear = tag(mask_columns(dim, ["hco_name"], True), "principal", "data engineer")
    masked = tag(mask_columns(dim, ["hco_name"], False), "principal", "NATION_7")
    return widen(clear.unionByName(masked))


@register("row_filter")
def row_filter(spark, sf):
    txn = roles.transactions(spark, sf, customer=True, supplier=True)
    # the published dimension: built once, read for each principal
    path = scratch_path(spark, "DimAgency")
    star.agency_dim(txn).write.parquet(path)
    agency = spark.read.parquet(path)
    fact = txn.select("transaction_unique_key", "awarding_agency_code", "recipient_uei", "recipient_name_raw")
    policy = Policy(code_col="awarding_agency_code", agency=agency, masked=("recipient_name_raw",))
    out = None
    for who in ("data engineer", "NATION_7", "Agency1"):
        part = tag(secured(fact, policy, who), "principal", who)
        out = part if out is None else out.unionByName(part)
    return out


@register("row_filter_agency")
def row_filter_agency(spark, sf):
    """The agency dimension as each principal sees it: all of it, or the
    rows of the own agency (G2 on DimAgency)."""
    agency = star.agency_dim(roles.transactions(spark, sf, customer=True, supplier=True))
    policy = Policy(code_col="agency_code", agency=agency, masked=())
    parts = [tag(secured(agency, policy, who), "principal", who) for who in ("data engineer", "NATION_7", "Agency1")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("outer_merge_hot")
def hot_outer_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers of one nation and thousand of balance: all
    pairs, and those without a partner (J11 with hot keys)."""
    def side(table: str, p: str) -> DataFrame:
        return spark.read.parquet(f"{sf}/{table}.parquet").select(
            F.col(f"{p}_nationkey").alias("nation"), F.floor(F.col(f"{p}_acctbal") / 1000).cast("int").alias("thousand"),
            F.col("c_custkey" if p == "c" else "s_suppkey"))
    return outer_merge_hot(side("customer", "c"), side("supplier", "s"), ["nation", "thousand"])


@register("names_as_of")
def names_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Recipients renamed in some years: validity intervals from the days of
    their orders, and for each transaction the name valid on its action day
    (D1, Q22)."""
    txn = roles.transactions(spark, sf, customer=True)
    seen = txn.select("recipient_uei", F.col("last_modified_date").alias("seen"), F.concat(
        "recipient_name_raw", F.when((F.year("last_modified_date") + F.col("recipient_uei").cast("bigint")) % 3 == 0, " LLC")
        .otherwise("")).alias("recipient_name"))
    dim = validity_dim(seen, "recipient_uei", "recipient_name", "seen")
    fact = txn.select("transaction_unique_key", "recipient_uei", "action_date")
    return lookup_as_of(fact, dim, "recipient_uei", "action_date",
                        out={"recipient_name": "recipient_name", "valid_from": "valid_from", "valid_to": "valid_to"})


def queries() -> dict:
    from starledger.plans import io_queries, job_queries, load_queries  # noqa: F401  (register)
    return dict(Q)
