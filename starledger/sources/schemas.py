"""Table contracts and the fixed values the pipeline must agree on.

Everything in the "Fixed values" block mirrors the source data's
published vocabulary (column names of the award files, the warehouse
table layouts, sizing constants).  It is stated once, here, in natural
order; the code elsewhere refers to these names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType,
)

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Wanted columns of the raw award files, in output order.
WANTED_COLUMNS = [
    "contract_transaction_unique_key", "contract_award_unique_key",
    "assistance_transaction_unique_key", "assistance_award_unique_key",
    "modification_number", "federal_action_obligation", "total_obligated_amount",
    "total_dollars_obligated", "total_outlayed_amount_for_overall_award",
    "face_value_of_loan", "original_loan_subsidy_cost", "total_face_value_of_loan",
    "total_loan_subsidy_cost",
    "outlayed_amount_from_COVID-19_supplementals_for_overall_award",
    "obligated_amount_from_COVID-19_supplementals_for_overall_award",
    "action_date", "action_date_fiscal_year",
    "awarding_agency_code", "awarding_agency_name", "awarding_office_code", "awarding_office_name",
    "funding_agency_code", "funding_agency_name", "funding_office_code", "funding_office_name",
    "program_activities_funding_this_award",
    "recipient_uei", "recipient_name_raw", "recipient_parent_uei", "recipient_parent_name_raw",
    "recipient_country_code", "recipient_country_name", "recipient_city_code", "recipient_city_name",
    "prime_award_transaction_recipient_county_fips_code", "recipient_county_name",
    "prime_award_transaction_recipient_state_fips_code", "recipient_state_code", "recipient_state_name",
    "prime_award_transaction_recipient_cd_original",
    "prime_award_transaction_recipient_cd_current",
    "primary_place_of_performance_scope", "primary_place_of_performance_country_code",
    "primary_place_of_performance_country_name",
    "prime_award_transaction_place_of_performance_county_fips_code",
    "primary_place_of_performance_county_name",
    "prime_award_transaction_place_of_performance_state_fips_code",
    "primary_place_of_performance_state_name",
    "prime_award_transaction_place_of_performance_cd_original",
    "prime_award_transaction_place_of_performance_cd_current",
    "cfda_number", "cfda_title", "naics_code", "naics_description",
    "country_of_product_or_service_origin_code", "country_of_product_or_service_origin",
    "contracting_officers_determination_of_business_size",
    "contracting_officers_determination_of_business_size_code",
    "correction_delete_indicator_code", "correction_delete_indicator_description",
    "action_type_code", "action_type_description", "record_type_code", "record_type_description",
    "foreign_funding",
    "highly_compensated_officer_1_name", "highly_compensated_officer_1_amount",
    "highly_compensated_officer_2_name", "highly_compensated_officer_2_amount",
    "highly_compensated_officer_3_name", "highly_compensated_officer_3_amount",
    "highly_compensated_officer_4_name", "highly_compensated_officer_4_amount",
    "highly_compensated_officer_5_name", "highly_compensated_officer_5_amount",
    "last_modified_date",
]

OFFICER_AMOUNTS = [f"highly_compensated_officer_{i}_amount" for i in range(1, 6)]
OFFICER_NAMES = [f"highly_compensated_officer_{i}_name" for i in range(1, 6)]
COVID_COLUMNS = [
    "outlayed_amount_from_COVID-19_supplementals_for_overall_award",
    "obligated_amount_from_COVID-19_supplementals_for_overall_award",
]

# Key shape: at least 5 (assistance) / 6 (contract) non-empty "_" parts.
# Reluctant from the start of a line: the same keys as greedy parts
# anywhere in it, without their backtracking.
ASSISTANCE_KEY_PATTERN = "(?m)^.+?_.+?_.+?_.+?_."
CONTRACT_KEY_PATTERN = "(?m)^.+?_.+?_.+?_.+?_.+?_."

# Rows per ~256 MB parquet file.
ROWS_PER_FILE = {
    "silver_assistance": 3_500_000,
    "silver_contract": 2_500_000,
    "gold_contract": 11_000_000,
    "gold_assistance": 10_000_000,
    "gold_transaction": 4_300_000,
}

# Largest dimension (measured bytes) that lookups broadcast; beyond it a
# shuffle join planned by AQE.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024

# Default calendar span and fiscal-year start month.
CALENDAR_BEGIN = "2018-10-01"
CALENDAR_END = "2025-09-30"
FISCAL_START_MONTH = 10

# Business size codes -> key.
BUSINESS_SIZE_KEYS = {"S": 1, "O": 2}

# Governance: the unmasked principal and the mask text.
ADMIN_PRINCIPALS = ("data engineer",)
MASK_TEXT = "xxxx"

# Fixed values (continued): file names of the external extracts.
EXTERNAL_FILES = {
    "house": "1976-2022-house.csv",
    "unemployment": "Unemployment.csv",
    "education": "Education.csv",
    "gdp": "county_gdp.csv",
    "population_2020": "co-est2020-alldata.csv",
    "population_2022": "co-est2022-alldata.csv",
    "presidential": "countypres_2000-2020.csv",
}

# Education extract: long header -> published column.
EDUCATION_COLUMNS = {
    "Federal Information Processing Standard (FIPS) Code": "fips_code",
    "Less than a high school diploma, 2017-21": "less_than_hs_17_21",
    "High school diploma only, 2017-21": "hs_only_17_21",
    "Some college or associate's degree, 2017-21": "some_college_17_21",
    "Bachelor's degree or higher, 2017-21": "bach_or_higher_17_21",
    "Percent of adults with less than a high school diploma, 2017-21": "perc_less_than_hs_17_21",
    "Percent of adults with a high school diploma only, 2017-21": "perc_hs_only_17_21",
    "Percent of adults completing some college or associate's degree, 2017-21": "perc_some_college_17_21",
    "Percent of adults with a bachelor's degree or higher, 2017-21": "perc_bach_or_higher_17_21",
}

# ---------------------------------------------------------------------------
# Family specifications (data, not code: a new family is a new instance)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FamilySpec:
    name: str
    renames: dict
    money: list
    key_pattern: str
    rows_per_file: int
    key: str = "transaction_unique_key"
    tag_column: str = "award_type"


_SHARED_MONEY = ["federal_action_obligation", "total_obligated_amount",
                 "total_outlayed_amount_for_overall_award"]

ASSISTANCE = FamilySpec(
    name="assistance",
    renames={"assistance_transaction_unique_key": "transaction_unique_key",
             "assistance_award_unique_key": "award_unique_key"},
    money=_SHARED_MONEY + ["face_value_of_loan", "original_loan_subsidy_cost",
                           "total_face_value_of_loan", "total_loan_subsidy_cost"] + OFFICER_AMOUNTS,
    key_pattern=ASSISTANCE_KEY_PATTERN,
    rows_per_file=ROWS_PER_FILE["silver_assistance"],
)

CONTRACT = FamilySpec(
    name="contract",
    renames={"contract_transaction_unique_key": "transaction_unique_key",
             "total_dollars_obligated": "total_obligated_amount",
             "contract_award_unique_key": "award_unique_key"},
    money=_SHARED_MONEY + COVID_COLUMNS + OFFICER_AMOUNTS,
    key_pattern=CONTRACT_KEY_PATTERN,
    rows_per_file=ROWS_PER_FILE["silver_contract"],
)

FAMILIES = {"assistance": ASSISTANCE, "contract": CONTRACT}

# ---------------------------------------------------------------------------
# Fixed values (continued): published table layouts, column names and types
# as the warehouse defines them
# ---------------------------------------------------------------------------

S, I, L, D, DT = StringType(), IntegerType(), LongType(), DoubleType(), DateType()
M = DecimalType(18, 2)


def _t(*cols) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in
                       [(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols]])


TABLES: dict[str, StructType] = {
    "DimAgency": _t(("agency_code", S), ("agency_name", S)),
    "DimCongressionalDistrict": _t(("cd_original", S), ("cd_code", L), ("party_2018", S),
                                   ("party_2020", S), ("party_2022", S)),
    "DimHighlyCompensatedOfficer": _t(("hco_name", S), ("hco_code", L)),
    "DimCountry": _t(("country_code", S), ("country_name", S)),
    "DimRecipient": _t(("recipient_uei", S), ("recipient_name_raw", S)),
    "DimState": _t(("state_abbreviation", S), ("state_name", S)),
    "DimStateLetters": _t(("state_abbreviation", S), ("state_name", S)),
    "DimCounty": _t(("county_fips", S), ("less_than_hs_17_21", I), ("hs_only_17_21", I),
                    ("some_college_17_21", I), ("bach_or_higher_17_21", I),
                    ("perc_less_than_hs_17_21", D), ("perc_hs_only_17_21", D),
                    ("perc_some_college_17_21", D), ("perc_bach_or_higher_17_21", D),
                    ("stname", S), ("ctyname", S), ("gdp_2019", L), ("gdp_2020", L),
                    ("gdp_2021", L), ("gdp_2022", L), ("popestimate2019", I),
                    ("popestimate2020", I), ("popestimate2021", I), ("popestimate2022", I),
                    ("party_2016", S), ("party_2020", S)),
    "DimDate": _t(("date_key", I), ("calendar_date", DT), ("calendar_year", I),
                  ("calendar_month", S), ("month_of_year", I), ("calendar_day", S),
                  ("day_of_week", I), ("is_weekday", S), ("day_of_month", I),
                  ("last_day_of_month", S), ("week_of_year_iso", I), ("quarter_of_year", I),
                  ("fiscal_year", I), ("fiscal_month", I)),
    "FactAssistance": _t(("transaction_unique_key", S), ("award_unique_key", S), ("cfda_number", S),
                         ("face_value_of_loan", M), ("total_face_value_of_loan", M),
                         ("original_loan_subsidy_cost", M), ("total_loan_subsidy_cost", M),
                         ("primary_place_of_performance_scope_code", L)),
    "FactTransaction": _t(
        ("transaction_unique_key", S), ("total_outlayed_amount_for_overall_award", M),
        ("prime_award_transaction_place_of_performance_county_fips_code", S),
        ("highly_compensated_officer_4_amount", M),
        ("outlayed_amount_from_COVID_19_supplementals_for_overall_award", M),
        ("modification_number", S), ("funding_office_code", S),
        ("prime_award_transaction_place_of_performance_state_fips_code", S), ("award_type", S),
        ("recipient_uei", S), ("awarding_agency_code", S),
        ("primary_place_of_performance_country_code", S), ("funding_agency_code", S),
        ("action_type_code", S), ("highly_compensated_officer_2_amount", M),
        ("recipient_parent_uei", S), ("highly_compensated_officer_1_amount", M),
        ("highly_compensated_officer_3_amount", M), ("recipient_state_code", S),
        ("program_activities_funding_this_award", S), ("award_unique_key", S),
        ("prime_award_transaction_place_of_performance_cd_original", S), ("recipient_city_name", S),
        ("prime_award_transaction_recipient_cd_current", S), ("total_obligated_amount", M),
        ("highly_compensated_officer_5_amount", M),
        ("obligated_amount_from_COVID_19_supplementals_for_overall_award", M),
        ("recipient_country_code", S), ("prime_award_transaction_recipient_county_fips_code", S),
        ("awarding_office_code", S), ("recipient_parent_name_raw", S),
        ("prime_award_transaction_recipient_state_fips_code", S), ("federal_action_obligation", M),
        ("action_date_key", I), ("last_modified_key", I), ("recipient_cd_code", L),
        ("place_of_performance_cd_code", L), ("highly_compensated_officer_1_code", L),
        ("highly_compensated_officer_2_code", L), ("highly_compensated_officer_3_code", L),
        ("highly_compensated_officer_4_code", L), ("highly_compensated_officer_5_code", L)),
    "DimBusinessSize": _t(("business_size_key", I), ("business_size_code", S, False),
                          ("business_size", S)),
    "DimNAICS": _t(("naics_key", I), ("naics_code", S), ("naics_description", S)),
    "DimCountryOfOrigin": _t(("country_of_origin_key", I), ("country_of_origin_code", S),
                             ("country_of_origin", S)),
    "FactContract": _t(("transaction_unique_key", S, False), ("award_unique_key", S),
                       ("naics_key", I), ("country_of_origin_key", I), ("business_size_key", I)),
    "DimCFDA": _t(("cfda_number", S, False), ("cfda_title", S)),
    "DimOffice": _t(("office_code", S), ("office_name", S)),
    "DimPrimaryPlaceOfPerformanceScope": _t(("primary_place_of_performance_scope", S),
                                            ("primary_place_of_performance_scope_code", L)),
}

# Contract columns a load may lack: what optional external sources and
# optional columns of the wish-list provide.
OPTIONAL_COLUMNS = {
    "DimCounty": tuple(f.name for f in TABLES["DimCounty"].fields if f.name != "county_fips"),
    "DimCongressionalDistrict": ("party_2018", "party_2020", "party_2022"),
    "FactAssistance": ("cfda_number", "face_value_of_loan", "total_face_value_of_loan",
                       "original_loan_subsidy_cost", "total_loan_subsidy_cost"),
    "FactTransaction": tuple(f.name for f in TABLES["FactTransaction"].fields
                             if f.name not in ("transaction_unique_key", "award_unique_key", "award_type")),
}

# Facts are hash-placed on the transaction key; dimensions are small.
FACT_TABLES = ("FactTransaction", "FactAssistance", "FactContract")

# Fixed values (continued): gold column names that differ from the published
# ones (gold -> published), spelled as the gold files spell them.
GOLD_TO_PUBLISHED = {
    "DateKey": "date_key",
    "last_modifed_key": "last_modified_key",
    "state_code": "state_abbreviation",
    "cd_original_code": "cd_code",
    "2016_party": "party_2016",
    "2020_party": "party_2020",
    "outlayed_amount_from_COVID-19_supplementals_for_overall_award":
        "outlayed_amount_from_COVID_19_supplementals_for_overall_award",
    "obligated_amount_from_COVID-19_supplementals_for_overall_award":
        "obligated_amount_from_COVID_19_supplementals_for_overall_award",
}
