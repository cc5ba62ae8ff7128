"""External county and district data to silver.

Each ``*_frame`` function is the pure transformation (DataFrames in,
DataFrame out); ``job_*`` reads the landed CSV and writes silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.scalars import district_code, fips, pad_code, strip_text, title_case
from starledger.operators.clean import cast_cols, parse_grouped_int, rename
from starledger.operators.joins import merge_vintages, outer_merge, resolve_code_by_name
from starledger.operators.winners import argmax_rows, pivot_first, top_per_group
from starledger.sources.files import load_csv, write_layer
from starledger.sources.schemas import EDUCATION_COLUMNS, EXTERNAL_FILES

HOUSE_YEARS = (2018, 2020, 2022)
PRESIDENTIAL_YEARS = (2016, 2020)
GDP_YEARS = ("gdp_2019", "gdp_2020", "gdp_2021", "gdp_2022")


# -- house results -> district winners (E3) ---------------------------------

def house_winners(house: DataFrame, since: int = 2018, sum_lines: bool = False) -> DataFrame:
    """Winner rows per (year, state, district), ties kept.

    Votes per (candidate, party) line are the line maximum (Q13);
    ``sum_lines=True`` adds a candidate's lines up instead."""
    recent = house.where(F.col("year") >= since)
    if sum_lines:
        # one row per candidate; the party shown is that of the largest line
        per_line = recent.groupBy("year", "state_po", "district", "candidate").agg(
            F.sum("candidatevotes").alias("votes"),
            F.max(F.struct("candidatevotes", "party")).getField("party").alias("party"))
    else:
        per_line = recent.groupBy("year", "state_po", "district", "candidate", "party").agg(
            F.max("candidatevotes").alias("votes"))
    best = top_per_group(per_line, ["year", "state_po", "district"], "votes")
    return best.select("year", "state_po", "district", "candidate", "party")


def district_parties(winners: DataFrame, years=HOUSE_YEARS, method: str = "outer") -> DataFrame:
    """One row per district with the winning party per year.

    ``outer``: per-year frames joined full outer (J11, P15); ties
    multiply rows, as in the source pipeline.  ``pivot``: one aggregation
    (A5), one row per district, smallest party on a tie."""
    if method == "outer":
        per_year = [winners.where(F.col("year") == y).select(
            "state_po", "district", F.col("party").alias(f"party_{y}")) for y in years]
        merged = outer_merge(per_year, ["state_po", "district"])
    else:
        merged = pivot_first(winners, ["state_po", "district"], "year", list(years), "party",
                             names={y: f"party_{y}" for y in years})
    return merged.select(district_code("state_po", "district").alias("congressional_district"),
                         *[f"party_{y}" for y in years])


def job_house(spark: SparkSession, landing: str, silver: str) -> None:
    house = load_csv(spark, landing, EXTERNAL_FILES["house"]).select(
        F.col("year").try_cast("int").alias("year"), "state_po", "district", "candidate",
        F.col("candidatevotes").try_cast("bigint").alias("candidatevotes"), "party")
    write_layer(district_parties(house_winners(house)), f"{silver}/external/cd/house", files=1)


# -- unemployment (E12) -----------------------------------------------------

def unemployment_frame(df: DataFrame) -> DataFrame:
    """County rows only: the national row is filtered before projection."""
    return df.where(F.col("State") != "US").select(
        "fips_code", *[F.col(f"unemployment_rate_{y}").try_cast("double").alias(f"unemployment_rate_{y}")
                       for y in (2019, 2020, 2021, 2022)],
        F.col("median_household_income_2021").try_cast("double").alias("median_household_income_2021"))


def job_unemployment(spark: SparkSession, landing: str, silver: str) -> None:
    raw = load_csv(spark, landing, EXTERNAL_FILES["unemployment"])
    write_layer(unemployment_frame(raw), f"{silver}/external/county/unemployment", files=1)


# -- education (E4) ---------------------------------------------------------

def education_frame(df: DataFrame) -> DataFrame:
    """Project, pad FIPS to 5, parse grouped counts, rename."""
    out = rename(df.select(*[F.col(f"`{c}`") for c in EDUCATION_COLUMNS]), EDUCATION_COLUMNS)
    out = out.withColumn("fips_code", pad_code("fips_code", 5))
    counts = ["less_than_hs_17_21", "hs_only_17_21", "some_college_17_21", "bach_or_higher_17_21"]
    out = parse_grouped_int(out, counts, "int")
    return cast_cols(out, {c: "double" for c in out.columns if c.startswith("perc_")})


def job_education(spark: SparkSession, landing: str, silver: str) -> None:
    edu = load_csv(spark, landing, EXTERNAL_FILES["education"])
    write_layer(education_frame(edu), f"{silver}/external/county/education", files=1)


# -- GDP with FIPS resolved by names (E5) ------------------------------------

def gdp_frame(gdp: DataFrame, codes: DataFrame, suffix: str = " County") -> DataFrame:
    """Join GDP rows to county codes on (state name, county name) after
    stripping the county suffix; parse grouped values as bigint (J9, F3,
    F5, P6, Q12)."""
    ref = codes.select(fips("state", "county").alias("fips_code"), "stname",
                       strip_text("ctyname", suffix).alias("ctyname"))
    vals = gdp.select("county", "state", *GDP_YEARS)
    joined = resolve_code_by_name(vals, ref, {"state": "stname", "county": "ctyname"})
    joined = parse_grouped_int(joined, GDP_YEARS, "bigint")
    return joined.select("fips_code", "stname", "ctyname", *GDP_YEARS)


def job_gdp(spark: SparkSession, landing: str, silver: str) -> None:
    gdp = load_csv(spark, landing, EXTERNAL_FILES["gdp"])
    codes = load_csv(spark, landing, EXTERNAL_FILES["population_2020"])
    write_layer(gdp_frame(gdp, codes), f"{silver}/external/county/gdp", files=1)


# -- population (E6) --------------------------------------------------------

def population_frame(older: DataFrame, newer: DataFrame, older_cols=("popestimate2019",),
                     newer_cols=("popestimate2020", "popestimate2021", "popestimate2022")) -> DataFrame:
    """Join two vintages on (state, county) codes, pad, build FIPS."""
    a = older.select("state", "county", *[F.col(c).try_cast("int").alias(c) for c in older_cols])
    b = newer.select("state", "county", *[F.col(c).try_cast("int").alias(c) for c in newer_cols])
    both = merge_vintages([a, b], ["state", "county"])
    return both.select(*older_cols, *newer_cols,
                       fips(pad_code("state", 2), pad_code("county", 3)).alias("fips_code"))


def job_population(spark: SparkSession, landing: str, silver: str) -> None:
    older = load_csv(spark, landing, EXTERNAL_FILES["population_2020"])
    newer = load_csv(spark, landing, EXTERNAL_FILES["population_2022"])
    write_layer(population_frame(older, newer), f"{silver}/external/county/pop_est", files=1)


# -- presidential winner per county (E7) ------------------------------------

def presidential_frame(pres: DataFrame, years=PRESIDENTIAL_YEARS, dedupe: bool = True) -> DataFrame:
    """County winner party per election year, one column per year.

    Filter years (P12), drop exact duplicate rows (A4), pad FIPS (F1),
    sum votes over voting modes (A2), keep the maximum per county-year
    with ties (A3, J12), title-case the party (F6), pivot (A5, min on tie)."""
    rows = pres.where(F.col("year").isin(list(years)))
    rows = rows.drop("office", "version")
    if dedupe:
        rows = rows.distinct()
    rows = rows.withColumn("county_fips", pad_code("county_fips", 5))
    group = [c for c in ("year", "state", "state_po", "county_name", "county_fips") if c in rows.columns]
    totals = rows.groupBy(*group, "candidate", "party").agg(
        F.sum("candidatevotes").alias("totalcandidatevotes"))
    best = argmax_rows(totals, group, "totalcandidatevotes", join_on=["year", "county_fips"])
    best = best.select("year", "county_fips", title_case("party").alias("party"))
    return pivot_first(best, "county_fips", "year", list(years), "party",
                       names={y: f"party_{y}" for y in years})


def job_presidential(spark: SparkSession, landing: str, silver: str) -> None:
    pres = cast_cols(load_csv(spark, landing, EXTERNAL_FILES["presidential"]),
                     {"year": "int", "candidatevotes": "bigint"})
    write_layer(presidential_frame(pres), f"{silver}/external/county/pres", files=1)
