"""Silver to gold star schema (E8 transactions + assistance, E9 contracts)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.dims import (
    build_dim, build_role_dim, calendar_for, code_dim, conform_union, extract_dim, keyed_natural,
)
from starledger.operators.joins import date_key_roles, enrich, lookup_roles
from starledger.sources.schemas import BROADCAST_MAX_BYTES, BUSINESS_SIZE_KEYS, OFFICER_NAMES

TXN = "transaction_unique_key"

ASSISTANCE_FACT_COLUMNS = [
    TXN, "award_unique_key", "cfda_number", "cfda_title", "face_value_of_loan",
    "total_face_value_of_loan", "original_loan_subsidy_cost", "total_loan_subsidy_cost",
    "primary_place_of_performance_scope",
]

RECIPIENT_CD = "prime_award_transaction_recipient_cd_original"
PLACE_CD = "prime_award_transaction_place_of_performance_cd_original"


def _present(df: DataFrame, cols):
    return [c for c in cols if c in df.columns]


def _role_dim(fact: DataFrame, roles, out, **kw) -> DataFrame:
    """Role dimension over the roles whose columns the fact has; an empty
    typed frame when none is present (a family may lack a column group)."""
    usable = [r for r in roles if all(c in fact.columns for c in r)]
    if not usable:
        schema = ", ".join(f"`{c}` string" for c in out)
        return fact.sparkSession.createDataFrame([], schema)
    names = kw.pop("role_names", None)
    if names:
        kw["role_names"] = [n for n, r in zip(names, roles) if r in usable]
    return build_role_dim(fact, usable, out, **kw)


def gold_assistance(assistance: DataFrame) -> dict:
    """FactAssistance with CFDA (D1) and performance-scope (D6) dims."""
    fact = assistance.select(*_present(assistance, ASSISTANCE_FACT_COLUMNS))
    cfda = build_dim(fact, ["cfda_number", "cfda_title"])
    scope, fact = extract_dim(fact.drop("cfda_title"), ["primary_place_of_performance_scope"],
                              "primary_place_of_performance_scope_code", how="left", key_type="long")
    return {"FactAssistance": fact, "DimCFDA": cfda,
            "DimPrimaryPlaceOfPerformanceScope": scope.select(
                "primary_place_of_performance_scope", "primary_place_of_performance_scope_code")}


def gold_transactions(assistance: DataFrame, contract: DataFrame, externals: dict | None = None,
                      calendar: DataFrame | None = None, max_bytes: int = BROADCAST_MAX_BYTES,
                      registry: str | None = None) -> dict:
    """FactTransaction and its shared dimensions (E8).  ``registry``: a
    folder of key registries, under which district and officer codes stay
    the same from load to load.

    ``externals``: optional silver frames ``education``, ``gdp``,
    ``pop_est``, ``pres`` (county) and ``house`` (district)."""
    externals = externals or {}
    txn = conform_union(assistance, contract)
    roles = {"action_date": "action_date_key", "last_modified_date": "last_modified_key"}
    if calendar is None:
        # Derived from these dates: covers all of them, keys computed in place.
        cal = calendar_for(txn, list(roles))
        fact = date_key_roles(txn, roles)
    else:
        # Given span: keys outside it are null, as with a left lookup.  The
        # bounds are scalar subqueries over the (small) calendar.
        cal = calendar
        bounds = cal.agg(F.min("calendar_date").alias("b"), F.max("calendar_date").alias("e"))
        fact = date_key_roles(txn, roles, begin=bounds.select("b").scalar(), end=bounds.select("e").scalar())
    fact = fact.drop("action_date_fiscal_year")
    out = {"DimDate": cal}

    out["DimAgency"] = _role_dim(fact, [["awarding_agency_code", "awarding_agency_name"],
                                             ["funding_agency_code", "funding_agency_name"]],
                                      ["agency_code", "agency_name"])
    out["DimOffice"] = _role_dim(fact, [["awarding_office_code", "awarding_office_name"],
                                             ["funding_office_code", "funding_office_name"]],
                                      ["office_code", "office_name"])
    out["DimRecipient"] = build_dim(fact, ["recipient_uei", "recipient_name_raw"]) \
        if "recipient_name_raw" in fact.columns else _role_dim(fact, [], ["recipient_uei", "recipient_name_raw"])
    county = _role_dim(fact, [["prime_award_transaction_recipient_county_fips_code", "recipient_county_name"],
                                   ["prime_award_transaction_place_of_performance_county_fips_code",
                                    "primary_place_of_performance_county_name"]],
                            ["county_fips", "county_name"])
    county = county.groupBy("county_fips").agg(F.min("county_name").alias("county_name"))  # one row per FIPS (Q17)
    sources = [(externals[k], "county_fips", "fips_code") for k in ("education", "gdp", "pop_est") if k in externals]
    if "pres" in externals:
        sources.append((externals["pres"], "county_fips", "county_fips"))
    county = enrich(county, sources)
    out["DimCounty"] = county.drop("county_name")

    cd, cd_bytes = keyed_natural(_role_dim(fact, [[RECIPIENT_CD], [PLACE_CD]], ["cd_original"]), ["cd_original"],
                                 "cd_code", registry=registry and f"{registry}/DimCongressionalDistrict")
    cd_roles = {c: k for c, k in ((RECIPIENT_CD, "recipient_cd_code"), (PLACE_CD, "place_of_performance_cd_code"))
                if c in fact.columns}
    fact = lookup_roles(fact, cd, cd_roles, dim_on="cd_original", dim_key="cd_code", drop_natural=False,
                        unique=True, dim_bytes=cd_bytes, max_bytes=max_bytes)
    fact = fact.drop(RECIPIENT_CD)  # the performance district text stays, as published
    if "house" in externals:
        cd = enrich(cd, [(externals["house"], "cd_original", "congressional_district")])
    out["DimCongressionalDistrict"] = cd

    out["DimState"] = _role_dim(fact, [["recipient_state_code", "recipient_state_name"],
                                            ["prime_award_transaction_place_of_performance_state_fips_code",
                                             "primary_place_of_performance_state_name"]],
                                     ["state_abbreviation", "state_name"], role_tag="code_system",
                                     role_names=["letters", "fips"])
    # Q4: the published state dimension mixes letter and numeric codes (tagged
    # by code_system); the letters-only dimension is the clean one
    state = out["DimState"]
    out["DimStateLetters"] = (state.where(F.col("code_system") == "letters").drop("code_system")
                              if "code_system" in state.columns else state)
    out["DimCountry"] = _role_dim(fact, [["recipient_country_code", "recipient_country_name"],
                                              ["primary_place_of_performance_country_code",
                                               "primary_place_of_performance_country_name"]],
                                       ["country_code", "country_name"])
    hco, hco_bytes = keyed_natural(_role_dim(fact, [[c] for c in OFFICER_NAMES], ["hco_name"]), ["hco_name"],
                                   "hco_code", registry=registry and f"{registry}/DimHighlyCompensatedOfficer")
    out["DimHighlyCompensatedOfficer"] = hco
    fact = lookup_roles(fact, hco, {n: n.replace("_name", "_code") for n in OFFICER_NAMES if n in fact.columns},
                        "hco_name", "hco_code", unique=True, dim_bytes=hco_bytes, max_bytes=max_bytes)
    names = ["awarding_agency_name", "funding_agency_name", "awarding_office_name", "funding_office_name",
             "recipient_name_raw", "recipient_county_name", "primary_place_of_performance_county_name",
             "recipient_state_name", "primary_place_of_performance_state_name", "recipient_country_name",
             "primary_place_of_performance_country_name"]
    out["FactTransaction"] = fact.drop(*[n for n in names if n in fact.columns])
    return out


@dataclass(frozen=True)
class DenseDim:
    """One dense-keyed dimension cut out of a fact (D4): the natural
    columns, the key, the key order, the null rule and published names.
    A further dimension is one more instance, not more code."""
    table: str
    natural: tuple
    key: str
    order: tuple | None = None
    null_rule: object = "any"
    names: tuple | None = None


CONTRACT_DIMS = (
    DenseDim("DimNAICS", ("naics_code", "naics_description"), "naics_key", null_rule=("naics_code",)),
    DenseDim("DimCountryOfOrigin",
             ("country_of_product_or_service_origin_code", "country_of_product_or_service_origin"),
             "country_of_origin_key",
             order=(("country_of_product_or_service_origin_code", "desc"), "country_of_product_or_service_origin"),
             names=("country_of_origin_code", "country_of_origin")),
)


def gold_contracts(contract: DataFrame, size_keys: dict = BUSINESS_SIZE_KEYS, how: str = "inner",
                   dims=CONTRACT_DIMS, registry: str | None = None) -> dict:
    """FactContract with business size (D5) and the dense-keyed dims of
    ``dims`` (D4; NAICS and country of origin, code descending) (E9).
    The dims are cut in order, each from the fact re-keyed by the ones
    before; ``how="inner"`` reproduces the dropping of rows without a
    matching pair (Q11).  ``registry``: a folder of key registries."""
    size_code = "contracting_officers_determination_of_business_size_code"
    size_name = "contracting_officers_determination_of_business_size"
    size, fact = code_dim(contract, size_code, size_name, size_keys, "business_size_key",
                          code_out="business_size_code", name_out="business_size")
    out = {"DimBusinessSize": size.select("business_size_key", "business_size_code", "business_size")}
    for spec in dims:
        null_rule = list(spec.null_rule) if isinstance(spec.null_rule, tuple) else spec.null_rule
        dim, fact = extract_dim(fact, list(spec.natural), spec.key,
                                order=list(spec.order) if spec.order else None, null_rule=null_rule,
                                how=how, names=list(spec.names) if spec.names else None,
                                registry=registry and f"{registry}/{spec.table}")
        out[spec.table] = dim
    out["FactContract"] = fact.select(TXN, "award_unique_key", *[d.key for d in dims], "business_size_key")
    return out
