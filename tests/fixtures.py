"""Tiny raw CSV files shaped like the award and external extracts
(edge rows as listed in FIXTURES.md)."""

from __future__ import annotations

import csv
import os

ASSISTANCE_HEADER = [
    "assistance_transaction_unique_key", "assistance_award_unique_key", "federal_action_obligation",
    "total_obligated_amount", "face_value_of_loan", "total_face_value_of_loan", "action_date",
    "action_date_fiscal_year", "last_modified_date", "awarding_agency_code", "awarding_agency_name",
    "funding_agency_code", "funding_agency_name", "awarding_office_code", "awarding_office_name",
    "funding_office_code", "funding_office_name", "recipient_uei", "recipient_name_raw",
    "recipient_country_code", "recipient_country_name", "recipient_state_code", "recipient_state_name",
    "prime_award_transaction_recipient_county_fips_code", "recipient_county_name",
    "prime_award_transaction_recipient_cd_original", "primary_place_of_performance_country_code",
    "primary_place_of_performance_country_name", "prime_award_transaction_place_of_performance_county_fips_code",
    "primary_place_of_performance_county_name", "prime_award_transaction_place_of_performance_state_fips_code",
    "primary_place_of_performance_state_name", "prime_award_transaction_place_of_performance_cd_original",
    "primary_place_of_performance_scope", "cfda_number", "cfda_title",
    "highly_compensated_officer_1_name", "highly_compensated_officer_1_amount",
    "highly_compensated_officer_2_name", "highly_compensated_officer_2_amount", "not_wanted",
]


def _row(key, award, money, date, fy, agency=("013", "Department of Commerce"), fips="01001", cd="AL-01",
         scope="Single ZIP Code", officers=("Ann", "Bob"), cfda=("10.001", "Research")):
    return [key, award, money, money, "", "", date, fy, date, agency[0], agency[1], "017",
            "Gulf Coast Ecosystem Restoration Council", "O1", "Office One", "O2", "Office Two", "U1", "Recipient One",
            "USA", "UNITED STATES", "AL", "ALABAMA", fips, "AUTAUGA", cd, "USA", "UNITED STATES", "01003", "BALDWIN",
            "01", "ALABAMA", "AL-02", scope, cfda[0], cfda[1], officers[0], "1.00", officers[1], "", "x"]


ASSISTANCE_2019 = [
    _row("A_1_2_3_4", "aw1", "10.00", "2018-10-01", "2019"),
    _row("A_1_2_3_5", "aw1", "junk", "2018-10-02", "2019", agency=("013", "Commerce Dept")),   # code with two names
    _row("A_1_2_3_6", "aw2", "", "2018-10-03", "2019", officers=("Ann", "Ann")),              # money only in officer
    _row("A_1_2", "aw3", "5.00", "2018-10-03", "2019"),                                          # bad key
    _row("A_1_2_3_4", "aw1", "10.00", "2018-10-01", "2019"),                                   # exact duplicate
]
ASSISTANCE_2020 = [
    _row("A_9_2_3_4", "aw9", "7.555", "2020-01-15", "2020", fips="", cd="", scope="", officers=("", "Cy")),
    _row("A_9_2_3_5", "aw9", "-2.00", "2030-01-15", "2020"),                                   # date outside calendar
]

SHARED = ["awarding_office_code", "awarding_office_name", "funding_office_code", "funding_office_name",
          "recipient_country_code", "recipient_country_name", "recipient_state_code", "recipient_state_name",
          "prime_award_transaction_recipient_cd_original", "primary_place_of_performance_country_code",
          "primary_place_of_performance_country_name",
          "prime_award_transaction_place_of_performance_county_fips_code", "primary_place_of_performance_county_name",
          "prime_award_transaction_place_of_performance_state_fips_code", "primary_place_of_performance_state_name",
          "prime_award_transaction_place_of_performance_cd_original",
          "highly_compensated_officer_1_name", "highly_compensated_officer_1_amount",
          "highly_compensated_officer_2_name", "highly_compensated_officer_2_amount"]
CONTRACT_HEADER = [
    "contract_transaction_unique_key", "contract_award_unique_key", "federal_action_obligation",
    "total_dollars_obligated", "action_date", "action_date_fiscal_year", "last_modified_date",
    "awarding_agency_code", "awarding_agency_name", "funding_agency_code", "funding_agency_name",
    "recipient_uei", "recipient_name_raw", "prime_award_transaction_recipient_county_fips_code",
    "recipient_county_name", "naics_code", "naics_description", "country_of_product_or_service_origin_code",
    "country_of_product_or_service_origin", "contracting_officers_determination_of_business_size_code",
    "contracting_officers_determination_of_business_size",
    "obligated_amount_from_COVID-19_supplementals_for_overall_award",
] + SHARED


def _shared(officer="Dee"):
    return ["O1", "Office One", "O3", "Office Three", "USA", "UNITED STATES", "AL", "ALABAMA", "AL-01", "USA",
            "UNITED STATES", "01001", "AUTAUGA", "01", "ALABAMA", "AL-01", officer, "2.00", "Ann", ""]


CONTRACT_2019 = [
    ["C_1_2_3_4_5", "caw1", "100.00", "100.00", "2019-01-02", "2019", "2019-01-02", "013", "Department of Commerce",
     "013", "Department of Commerce", "U2", "Recipient Two", "01001", "AUTAUGA", "111", "Farming", "USA",
     "UNITED STATES", "S", "SMALL BUSINESS", "1.5"] + _shared(),
    ["C_1_2_3_4_6", "caw1", "50.00", "150.00", "2019-01-03", "2019", "2019-01-03", "013", "Department of Commerce",
     "017", "Gulf Coast Ecosystem Restoration Council", "U2", "Recipient Two", "01001", "AUTAUGA", "112", "",
     "CAN", "CANADA", "X", "UNKNOWN", ""] + _shared(),                                  # null NAICS description
    ["C_1_2_3_4_7", "caw2", "20.00", "20.00", "2019-02-01", "2019", "2019-02-01", "017",
     "Gulf Coast Ecosystem Restoration Council", "017", "Gulf Coast Ecosystem Restoration Council", "U3",
     "Recipient Three", "01003", "BALDWIN", "111", "Farming", "CAN", "CANADA", "O", "OTHER THAN SMALL", "bad"]
    + _shared(""),
]
CONTRACT_2020 = [
    ["C_8_2_3_4_5", "caw8", "1.00", "1.00", "2019-11-02", "2020", "2019-11-02", "013", "Department of Commerce",
     "013", "Department of Commerce", "U2", "Recipient Two", "01001", "AUTAUGA", "111", "Farming", "USA",
     "UNITED STATES", "S", "SMALL BUSINESS", ""] + _shared(),
]

HOUSE = [["year", "state_po", "district", "candidate", "candidatevotes", "party"],
         ["2018", "AL", "1", "Smith", "100", "REPUBLICAN"], ["2018", "AL", "1", "Jones", "100", "DEMOCRAT"],   # tie
         ["2020", "AL", "1", "Smith", "90", "REPUBLICAN"], ["2020", "AL", "1", "Smith", "20", "CONSERVATIVE"],
         ["2020", "AL", "1", "Lee", "95", "DEMOCRAT"], ["2022", "AL", "2", "Ray", "5", "REPUBLICAN"],
         ["2017", "AL", "1", "Old", "999", "WHIG"], ["2020", "AK", "0", "Young", "10", "REPUBLICAN"]]
UNEMPLOYMENT = [["fips_code", "State", "unemployment_rate_2019", "unemployment_rate_2020", "unemployment_rate_2021",
                 "unemployment_rate_2022", "median_household_income_2021"],
                ["00000", "US", "3.7", "8.1", "5.3", "3.6", "69717"], ["01001", "AL", "2.7", "4.9", "2.9", "2.5", "66444"]]
EDUCATION = [["Federal Information Processing Standard (FIPS) Code", "Less than a high school diploma, 2017-21",
              "High school diploma only, 2017-21", "Some college or associate's degree, 2017-21",
              "Bachelor's degree or higher, 2017-21",
              "Percent of adults with less than a high school diploma, 2017-21",
              "Percent of adults with a high school diploma only, 2017-21",
              "Percent of adults completing some college or associate's degree, 2017-21",
              "Percent of adults with a bachelor's degree or higher, 2017-21", "Area name"],
             ["1001", "4,291", "12,551", "10,596", "10,700", "11.5", "33.6", "28.4", "26.6", "Autauga"],
             ["1003", "1,234,567", "", "40,000", "50,000", "9.2", "27.7", "31.3", "31.9", "Baldwin"]]
GDP = [["county", "state", "gdp_2019", "gdp_2020", "gdp_2021", "gdp_2022"],
       ["Autauga", "Alabama", "1,000", "1,100", "1,200", "3,000,000,000"],
       ["Baldwin", "Alabama", "2,000", "x", "2,200", "2,300"], ["Nowhere", "Alabama", "1", "1", "1", "1"]]
EST2020 = [["state", "county", "stname", "ctyname", "popestimate2019"],
           ["01", "000", "Alabama", "Alabama", "4903185"], ["01", "001", "Alabama", "Autauga County", "55869"],
           ["01", "003", "Alabama", "Baldwin County", "223234"]]
EST2022 = [["state", "county", "popestimate2020", "popestimate2021", "popestimate2022"],
           ["01", "000", "5031864", "5049846", "5074296"], ["01", "001", "58877", "59095", "59759"],
           ["01", "003", "233140", "239294", "246435"], ["01", "005", "1", "1", "1"]]
PRES = [["year", "state", "state_po", "county_name", "county_fips", "office", "candidate", "party", "candidatevotes",
         "version", "mode"],
        ["2016", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "TRUMP", "REPUBLICAN", "100", "1", "TOTAL"],
        ["2016", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "CLINTON", "DEMOCRAT", "60", "1", "TOTAL"],
        ["2020", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "BIDEN", "DEMOCRAT", "50", "1", "MAIL"],
        ["2020", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "BIDEN", "DEMOCRAT", "50", "1", "POLLS"],
        ["2020", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "BIDEN", "DEMOCRAT", "50", "1", "POLLS"],
        ["2020", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "TRUMP", "REPUBLICAN", "90", "1", "TOTAL"],
        ["2016", "ALABAMA", "AL", "BALDWIN", "1003", "US PRESIDENT", "TRUMP", "REPUBLICAN", "5", "1", "TOTAL"],
        ["2020", "ALABAMA", "AL", "BALDWIN", "1003", "US PRESIDENT", "BIDEN", "DEMOCRAT", "7", "1", "TOTAL"],
        ["2020", "ALABAMA", "AL", "BALDWIN", "1003", "US PRESIDENT", "TRUMP", "REPUBLICAN", "7", "1", "TOTAL"],
        ["2012", "ALABAMA", "AL", "AUTAUGA", "1001", "US PRESIDENT", "OBAMA", "DEMOCRAT", "1", "1", "TOTAL"],
        ["2020", "ALABAMA", "AL", "NOWHERE", "", "US PRESIDENT", "X", "OTHER", "1", "1", "TOTAL"]]


def _write(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        csv.writer(fh).writerows(rows)


def write_landing(base: str, years=(2019, 2020)) -> str:
    data = {2019: (ASSISTANCE_2019, CONTRACT_2019), 2020: (ASSISTANCE_2020, CONTRACT_2020)}
    for year in years:
        a, c = data[year]
        _write(f"{base}/assistance/FY{year}_All_Assistance.csv", [ASSISTANCE_HEADER] + a)
        _write(f"{base}/contract/FY{year}_All_Contracts.csv", [CONTRACT_HEADER] + c)
    ext = f"{base}/external_data"
    for name, rows in [("1976-2022-house.csv", HOUSE), ("Unemployment.csv", UNEMPLOYMENT),
                       ("Education.csv", EDUCATION), ("county_gdp.csv", GDP), ("co-est2020-alldata.csv", EST2020),
                       ("co-est2022-alldata.csv", EST2022), ("countypres_2000-2020.csv", PRES)]:
        _write(f"{ext}/{name}", rows)
    return base
