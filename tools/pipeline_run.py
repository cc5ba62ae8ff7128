"""End-to-end run of the whole pipeline (E1 -> E11) on raw CSV derived from
the driver tables: ``python tools/pipeline_run.py [sf_dir]``.

Raw award files: lineitem x orders x customer x supplier x part x nation x
region, one row per line item, written as all-text CSV per family; the six
external files come from nation / region / customer / supplier / events.
Prints one JSON line with the wall time of each stage and table sizes."""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from starledger.operators.dims import calendar_dim  # noqa: E402
from starledger.plans.jobs import runs  # noqa: E402
from starledger.plans.roles import EVENT_TYPES, table  # noqa: E402
from starledger.sources.schemas import EDUCATION_COLUMNS  # noqa: E402
from starledger.session import build_session, scratch_path  # noqa: E402


def s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c):
    return s(F.col(c).cast("decimal(18,2)"))


def fips(region, nation):
    return F.concat(F.lpad(s(region), 2, "0"), F.lpad(s(nation), 3, "0"))


def district(name_src, number_src, modulus):
    kind = F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (name_src % 5 + 1).cast("int"))
    return F.concat(kind, F.lit("-"), F.lpad(s(number_src % modulus), 2, "0"))


def land(spark, sf: str, landing: str) -> None:
    t = lambda n: table(spark, sf, n)
    cn = t("nation").select(F.col("n_nationkey").alias("cnk"), F.col("n_name").alias("cnn"), F.col("n_regionkey").alias("crk"))
    sn = t("nation").select(F.col("n_nationkey").alias("snk"), F.col("n_name").alias("snn"), F.col("n_regionkey").alias("srk"))
    rg = t("region")
    j = (t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(cn, F.col("c_nationkey") == F.col("cnk"))
         .join(rg.select(F.col("r_regionkey").alias("crk2"), F.col("r_name").alias("crn")), F.col("crk") == F.col("crk2"))
         .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(sn, F.col("s_nationkey") == F.col("snk"))
         .join(rg.select(F.col("r_regionkey").alias("srk2"), F.col("r_name").alias("srn")), F.col("srk") == F.col("srk2"))
         .join(t("part"), F.col("l_partkey") == F.col("p_partkey")))
    ship, order = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    fy = F.when(F.month(ship) >= 10, F.year(ship) + 1).otherwise(F.year(ship))
    shared = [
        money("l_extendedprice").alias("federal_action_obligation"),
        s(ship).alias("action_date"), s(fy).alias("action_date_fiscal_year"), s(order).alias("last_modified_date"),
        s("cnk").alias("awarding_agency_code"), F.col("cnn").alias("awarding_agency_name"),
        s("snk").alias("funding_agency_code"), F.col("snn").alias("funding_agency_name"),
        F.col("c_mktsegment").alias("awarding_office_code"), F.lower("c_mktsegment").alias("awarding_office_name"),
        s(F.col("s_suppkey") % 7).alias("funding_office_code"), F.concat(F.lit("office "), s(F.col("s_suppkey") % 7)).alias("funding_office_name"),
        s("o_custkey").alias("recipient_uei"), F.col("c_name").alias("recipient_name_raw"),
        s("crk").alias("recipient_country_code"), F.col("crn").alias("recipient_country_name"),
        F.substring("cnn", 1, 2).alias("recipient_state_code"), F.col("cnn").alias("recipient_state_name"),
        fips("crk", "cnk").alias("prime_award_transaction_recipient_county_fips_code"), F.col("cnn").alias("recipient_county_name"),
        district(F.col("l_suppkey"), F.col("l_partkey"), 4).alias("prime_award_transaction_recipient_cd_original"),
        s("srk").alias("primary_place_of_performance_country_code"), F.col("srn").alias("primary_place_of_performance_country_name"),
        fips("srk", "snk").alias("prime_award_transaction_place_of_performance_county_fips_code"),
        F.col("snn").alias("primary_place_of_performance_county_name"),
        F.lpad(s("snk"), 2, "0").alias("prime_award_transaction_place_of_performance_state_fips_code"),
        F.col("snn").alias("primary_place_of_performance_state_name"),
        district(F.col("o_custkey"), F.col("l_linenumber"), 6).alias("prime_award_transaction_place_of_performance_cd_original"),
        F.col("s_name").alias("highly_compensated_officer_1_name"), money("l_tax").alias("highly_compensated_officer_1_amount"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("c_name")).alias("highly_compensated_officer_2_name"),
        F.col("l_returnflag").alias("unwanted_flag"),
    ]
    key = [s("l_orderkey"), s("l_partkey"), s("l_suppkey"), s("l_linenumber"), F.col("l_returnflag")]
    assistance = j.where(F.col("l_linestatus") == "F").select(
        F.concat_ws("_", *key).alias("assistance_transaction_unique_key"), s("l_orderkey").alias("assistance_award_unique_key"),
        money("o_totalprice").alias("total_obligated_amount"), money("o_totalprice").alias("total_face_value_of_loan"),
        F.col("o_orderpriority").alias("primary_place_of_performance_scope"),
        F.col("p_brand").alias("cfda_number"), F.col("p_type").alias("cfda_title"), *shared)
    contract = j.where(F.col("l_linestatus") == "O").select(
        F.concat_ws("_", *key, F.lit("C")).alias("contract_transaction_unique_key"), s("l_orderkey").alias("contract_award_unique_key"),
        money("o_totalprice").alias("total_dollars_obligated"),
        F.col("p_brand").alias("naics_code"), F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("naics_description"),
        s("snk").alias("country_of_product_or_service_origin_code"), F.col("snn").alias("country_of_product_or_service_origin"),
        F.when(F.col("l_returnflag") == "A", "S").when(F.col("l_returnflag") == "R", "O").otherwise("X")
        .alias("contracting_officers_determination_of_business_size_code"),
        F.concat(F.lit("size "), F.col("l_returnflag")).alias("contracting_officers_determination_of_business_size"),
        *shared)
    for name, df in (("assistance", assistance), ("contract", contract)):
        df.write.mode("overwrite").option("header", True).csv(f"{landing}/{name}")

    ext = f"{landing}/external_data"
    nat = t("nation").join(rg, F.col("n_regionkey") == F.col("r_regionkey"))
    cust = t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    supp = t("supplier").groupBy("s_nationkey").agg(F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("g"))
    base = nat.join(cust, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(
        supp, F.col("n_nationkey") == F.col("s_nationkey"), "left")

    def csv(df, name):
        df.write.mode("overwrite").option("header", True).csv(f"{ext}/{name}")

    ev = t("events")
    csv(ev.select(s(F.lit(2014) + F.lit(2) * (F.dayofmonth("ts") % 5)).alias("year"), F.col("event_type").alias("state_po"),
                  s(F.hour("ts") % 4).alias("district"), s("user_id").alias("candidate"),
                  s(F.floor("value")).alias("candidatevotes"), F.concat(F.lit("party "), s(F.col("event_id") % 3)).alias("party")),
        "1976-2022-house.csv")
    edu = {}
    for i, (header, name) in enumerate(EDUCATION_COLUMNS.items()):
        if name == "fips_code":
            edu[header] = s(F.col("n_regionkey") * 1000 + F.col("n_nationkey"))
        elif name.startswith("perc_"):
            edu[header] = s(F.lit(10.0 * i))
        else:
            edu[header] = F.format_number(F.coalesce(F.col("n"), F.lit(0)) * (i + 1) * 1000, 0)
    csv(base.select(*[v.alias(k) for k, v in edu.items()]), "Education.csv")
    gdp = F.format_number(F.floor(F.coalesce(F.col("g"), F.lit(0))), 0)
    csv(base.select(F.col("n_name").alias("county"), F.col("r_name").alias("state"),
                    *[gdp.alias(f"gdp_{y}") for y in (2019, 2020, 2021, 2022)]), "county_gdp.csv")
    codes = [F.lpad(s("n_regionkey"), 2, "0").alias("state"), F.lpad(s("n_nationkey"), 3, "0").alias("county")]
    csv(base.select(*codes, F.col("r_name").alias("stname"), F.concat("n_name", F.lit(" County")).alias("ctyname"),
                    s(F.coalesce("n", F.lit(0))).alias("popestimate2019")), "co-est2020-alldata.csv")
    csv(base.select(*codes, *[s(F.coalesce("n", F.lit(0)) + i).alias(f"popestimate{2020 + i}") for i in range(3)]),
        "co-est2022-alldata.csv")
    pres = ev.join(nat, (F.col("user_id") % 25) == F.col("n_nationkey"))
    csv(pres.select(s(F.when(F.dayofmonth("ts") % 2 == 0, 2016).otherwise(2020)).alias("year"), F.col("r_name").alias("state"),
                    F.col("r_name").alias("state_po"), F.col("n_name").alias("county_name"),
                    s(F.col("n_regionkey") * 1000 + F.col("n_nationkey")).alias("county_fips"), F.lit("US PRESIDENT").alias("office"),
                    F.col("event_type").alias("candidate"), F.upper(F.concat("event_type", F.lit(" party"))).alias("party"),
                    s(F.floor("value")).alias("candidatevotes"), F.lit("1").alias("version")), "countypres_2000-2020.csv")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    # CSV is splittable: size the splits to the data (about one per core
    # here), as a cluster would size them to its executors.
    spark = build_session(extra={"spark.sql.files.maxPartitionBytes": "16m"})
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    t0 = time.time()
    land(spark, sf, landing)
    t1 = time.time()
    cal = calendar_dim(spark, "1994-10-01", "2002-09-30")
    stages = {}
    silver, gold = f"{root}/silver", f"{root}/gold"
    clock = time.time()

    def lap(name):
        nonlocal clock
        now = time.time()
        stages[name] = round(now - clock, 1)
        clock = now

    runs.run_concurrently({f: runs.partial(runs.job_b2s, spark, landing, silver, f)
                           for f in ("assistance", "contract")}, 2)
    lap("bronze_to_silver")
    runs.run_externals(spark, landing, silver)
    lap("externals")
    tables = runs.run_gold(spark, silver, gold, cal)
    lap("silver_to_gold")
    runs.job_publish(spark, tables, "demo", location=f"{root}/warehouse")
    lap("publish")
    runs.job_summaries(spark, "demo", location=f"{root}/warehouse/demo.db")
    lap("summaries")
    t2 = time.time()
    sizes = {n: spark.table(f"demo.{n}").count() for n in ("FactTransaction", "FactAssistance", "FactContract",
                                                           "DimCounty", "DimCongressionalDistrict",
                                                           "DimHighlyCompensatedOfficer", "ViewAgenciesByMonth")}
    print(json.dumps({"sf": sf, "landing_sec": round(t1 - t0, 1), "pipeline_sec": round(t2 - t1, 1),
                      "stages_sec": stages, "tables": len(tables), "rows": sizes}))
    spark.stop()


if __name__ == "__main__":
    main()
