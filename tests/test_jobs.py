from pyspark.sql import functions as F

from starledger.operators.dims import calendar_dim
from starledger.operators.govern import filter_for_principal
from starledger.plans.jobs import externals as ext
from starledger.plans.jobs.runs import run_historical, run_yearly
from starledger.session import scratch_path
from starledger.sources.files import read_csv
from tests.fixtures import write_landing


def _counts(spark, db, names):
    return {n: spark.table(f"{db}.{n}").count() for n in names}


def test_pipeline_end_to_end(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"), years=(2019,))
    root = scratch_path(spark, "lake")
    cal = calendar_dim(spark, "2018-10-01", "2025-09-30")
    db = "e2e"
    run_historical(spark, landing, root, db, calendar=cal)
    names = ["FactTransaction", "FactAssistance", "FactContract", "DimDate", "DimAgency", "DimCounty",
             "DimCongressionalDistrict", "DimHighlyCompensatedOfficer", "DimNAICS", "ViewSummaryTotalsByDay"]
    first = _counts(spark, db, names)
    assert first["FactTransaction"] == 7 and first["FactAssistance"] == 4 and first["FactContract"] == 2
    assert first["DimDate"] == 2557 and first["DimAgency"] == 3      # one code with two names (Q22)
    assert first["DimHighlyCompensatedOfficer"] == 3                  # Ann, Bob, Dee: Ann in two slots once
    assert first["DimCounty"] == 2
    summaries = ["ViewSummaryByAward", "ViewSummaryTotalsByDay", "ViewAgenciesByDay", "ViewRecipientsByDay",
                 "ViewIndustriesByDay", "ViewSmallBusinessSummaryByDay", "ViewAgenciesByMonth",
                 "ViewIndustriesByMonth", "ViewSmallBusinessSummaryByMonth", "ViewObligatedFedAmtByFips",
                 "AwardByDateTable", "ViewAwardSumsByDay", "AwardSumsDedup"]
    assert all(spark.catalog.tableExists(f"{db}.{n}") for n in summaries)
    small = spark.table(f"{db}.ViewSmallBusinessSummaryByDay").agg(
        F.sum("small_business_transactions"), F.sum("total_transactions")).first()
    assert tuple(small) == (1, 2)                                    # S -> 1, O -> 2; null-description row dropped
    industries = sorted((r.calendar_month, r.naics_code, r.industry_count)
                        for r in spark.table(f"{db}.ViewIndustriesByMonth").collect())
    assert industries == [("February", "111", 1), ("January", "111", 1)]
    assert spark.table(f"{db}.ViewSummaryByAward").count() == 2      # aw1, aw2
    assert sorted(r.calendar_month for r in spark.table(f"{db}.ViewSmallBusinessSummaryByMonth").collect()) == \
        ["February", "January"]
    letters = [r.state_abbreviation for r in spark.table(f"{db}.DimStateLetters").collect()]
    assert letters == ["AL"]                                          # the FIPS-coded role is not in it (Q4)
    assert spark.table(f"{db}.DimState").count() == 2
    from starledger.sources.schemas import TABLES
    for table, contract in TABLES.items():                            # published layouts equal the contracts
        got = [(f.name, f.dataType) for f in spark.table(f"{db}.{table}").schema.fields]
        assert got == [(f.name, f.dataType) for f in contract.fields], table
    run_historical(spark, landing, root, db, calendar=cal)            # idempotent re-run
    assert _counts(spark, db, names) == first

    fact = spark.table(f"{db}.FactTransaction")
    hco = {r.hco_name: r.hco_code for r in spark.table(f"{db}.DimHighlyCompensatedOfficer").collect()}
    ann = fact.where(F.col("transaction_unique_key") == "A_1_2_3_6").first()
    assert ann.highly_compensated_officer_1_code == ann.highly_compensated_officer_2_code == hco["Ann"]
    county = {r.county_fips: r for r in spark.table(f"{db}.DimCounty").collect()}
    assert county["01001"].party_2016 == "Republican" and county["01001"].party_2020 == "Democrat"
    assert county["01001"].gdp_2022 == 3_000_000_000 and county["01001"].less_than_hs_17_21 == 4291
    cd_rows = spark.table(f"{db}.DimCongressionalDistrict").collect()
    assert sorted(r.cd_original for r in cd_rows) == ["AL-01", "AL-01", "AL-02"]   # 2018 tie multiplies (outer form)
    assert {r.party_2020 for r in cd_rows if r.cd_original == "AL-01"} == {"DEMOCRAT"}
    commerce = filter_for_principal(fact, "awarding_agency_code", spark.table(f"{db}.DimAgency"), "Department of Commerce")
    assert commerce.where(F.col("awarding_agency_code") != "013").count() == 0 and commerce.count() == 6

    # yearly increment: the new year lands, the old partition is untouched
    write_landing(str(tmp_path / "landing"), years=(2020,))
    run_yearly(spark, landing, root, 2020, db, calendar=cal)
    run_yearly(spark, landing, root, 2020, db, calendar=cal)          # replay of the same year
    after = _counts(spark, db, ["FactTransaction", "FactContract"])
    assert after == {"FactTransaction": 10, "FactContract": 3}
    out_of_calendar = fact.sparkSession.table(f"{db}.FactTransaction").where(
        F.col("transaction_unique_key") == "A_9_2_3_5").first()
    assert out_of_calendar.action_date_key is None


def test_house_and_unemployment(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"), years=(2019,))
    house = read_csv(spark, f"{landing}/external_data/1976-2022-house.csv").select(
        F.col("year").try_cast("int").alias("year"), "state_po", "district", "candidate",
        F.col("candidatevotes").try_cast("bigint").alias("candidatevotes"), "party")
    winners = ext.house_winners(house)
    assert winners.where("year = 2018").count() == 2                  # tie kept
    assert winners.where("year = 2020 and state_po = 'AL'").first().candidate == "Lee"   # line max, not sum (Q13)
    assert ext.house_winners(house, sum_lines=True).where("year = 2020 and state_po = 'AL'").first()[3:] == ("Smith", "REPUBLICAN")
    outer = ext.district_parties(winners)
    assert outer.where("congressional_district = 'AL-01'").count() == 2   # ties multiply in the outer form
    pivot = ext.district_parties(winners, method="pivot")
    assert pivot.where("congressional_district = 'AL-01'").count() == 1
    un = ext.unemployment_frame(read_csv(spark, f"{landing}/external_data/Unemployment.csv"))
    assert [r.fips_code for r in un.collect()] == ["01001"]
