"""Queries that exercise the sources and sinks."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.clean import cast_cols, cast_money
from starledger.operators.dims import build_dim
from starledger.plans import roles, star
from starledger.plans.queries import register
from starledger.plans.job_queries import silver_contract
from starledger.plans.jobs.gold import gold_contracts
from starledger.plans.jobs.runs import DIM_ROWS_PER_FILE
from starledger.session import drop_path, run_concurrently, scratch_path, store
from starledger.sources.files import (
    load_csv, read_if_exists, read_layer, read_year, sql_over, write_csv_years, write_layer, write_sized,
)
from starledger.sources.schemas import TABLES
from starledger.sources.versions import publish_version, version_database, version_table
from starledger.sources.warehouse import refresh_warehouse


@register("publish_roundtrip")
def publish_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Gold frames -> parquet layer -> typed, bucketed catalog tables ->
    read back -> rows and content per table: the rows as text, and the
    values that are not null in each column, added up."""
    txn = roles.transactions(spark, sf, customer=True, supplier=True)
    jobs = gold_contracts(silver_contract(spark, sf), size_keys=star.ROLE_SIZE_KEYS)
    gold = {"DimAgency": star.agency_dim(txn), "DimRecipient": build_dim(txn, ["recipient_uei", "recipient_name_raw"]),
            **{t: jobs[t] for t in ("DimNAICS", "DimBusinessSize", "DimCountryOfOrigin", "FactContract")}}
    base = scratch_path(spark, "publish")
    run_concurrently({name: partial(write_sized, df, f"{base}/gold/{name}", DIM_ROWS_PER_FILE)
                      for name, df in gold.items()})
    layer = {name: read_layer(spark, f"{base}/gold/{name}") for name in gold}
    db = f"sl_rt_{uuid.uuid4().hex[:10]}"
    refresh_warehouse(spark, layer, TABLES, db, location=f"{base}/warehouse")
    out = None
    for name in gold:
        table = spark.table(f"{db}.{name}")
        columns = sorted(table.columns)
        text = F.concat_ws("|", *[roles.s(c) for c in columns])
        found = table.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.length(text)).alias("text_length"),
                          F.sum(sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))).alias("values_present"),
                          F.count_distinct(text).alias("distinct_rows"))
        part = found.select(F.lit(name).alias("table_name"), "row_count", "text_length", "values_present", "distinct_rows")
        out = part if out is None else out.unionByName(part)
    # the few result rows are kept, the database is dropped with its tables
    path = scratch_path(spark, "publish-content")
    out.write.parquet(path)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    drop_path(spark, base)
    return spark.read.parquet(path)


@register("publish_versioned")
def publish_versioned(spark: SparkSession, sf: str) -> DataFrame:
    """The agency and recipient dimensions up to 1996 published as one
    version, then those of all years with the contract fact as the next:
    what the views hold, and whether the version before held it, too (S13,
    E10)."""
    # silver lies on storage, as in the job: each dimension of each version reads its columns of it
    txn = store(roles.transactions(spark, sf, customer=True, supplier=True).select(
        "action_date", "awarding_agency_code", "awarding_agency_name", "funding_agency_code", "funding_agency_name",
        "recipient_uei", "recipient_name_raw"), "silver-transactions")
    base = scratch_path(spark, "versions")
    silver = store(silver_contract(spark, sf), "silver-contract")
    loads = []
    for n, part in enumerate((F.col("action_date") < "1997-01-01", F.lit(True))):
        rows = txn.where(part)
        dims = {"DimAgency": star.agency_dim(rows), "DimRecipient": build_dim(rows, ["recipient_uei", "recipient_name_raw"])}
        for name, df in dims.items():
            write_sized(df, f"{base}/gold_{n}/{name}", DIM_ROWS_PER_FILE)
        loads.append({name: read_layer(spark, f"{base}/gold_{n}/{name}") for name in dims})
    fact = gold_contracts(silver, size_keys=star.ROLE_SIZE_KEYS)["FactContract"]
    write_sized(fact, f"{base}/gold_1/FactContract", DIM_ROWS_PER_FILE)
    loads[1]["FactContract"] = read_layer(spark, f"{base}/gold_1/FactContract")
    db, at = f"sl_ver_{uuid.uuid4().hex[:10]}", f"{base}/warehouse"
    first, second = (publish_version(spark, tables, TABLES, db, at) for tables in loads)
    found = []
    for name in ("DimAgency", "DimRecipient"):
        code, label = TABLES[name].names
        before = version_table(spark, at, name, first).select(F.col(code).alias("_c"), F.col(label).alias("_l"), F.lit(True).alias("_b"))
        now = spark.table(f"{db}.{name}")
        found.append(now.join(before, (now[code] == before["_c"]) & now[label].eqNullSafe(before["_l"]), "left").select(
            F.lit(name).alias("table_name"), now[code].alias("code"), now[label].alias("name"),
            F.coalesce("_b", F.lit(False)).cast("bigint").alias("in_version_before")))
    found.append(spark.table(f"{db}.FactContract").select(F.lit("FactContract"), "transaction_unique_key", "award_unique_key",
                                                          F.lit(0).cast("bigint")))
    # the rows are kept, the databases are dropped with their tables
    path = scratch_path(spark, "versions-content")
    found[0].unionByName(found[1]).union(found[2]).write.parquet(path)
    for database in (db, *(version_database(db, v) for v in (first, second))):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    drop_path(spark, base)
    return spark.read.parquet(path)


@register("csv_roundtrip")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as CSV partitioned by year (one pass over the table);
    one year read back with partition pruning, typed from text."""
    od = roles.table(spark, sf, "orders")
    text = od.select(F.year("o_orderdate").alias("fy"), roles.s("o_orderkey").alias("o_orderkey"),
                     roles.s(roles.money("o_totalprice")).alias("o_totalprice"),
                     roles.s(F.col("o_orderdate").cast("date")).alias("o_orderdate"), "o_orderpriority")
    base = write_csv_years(text, scratch_path(spark, "landing"), "fy")
    year = read_year(spark, base, 1997, layout="partitioned", year_col="fy")
    typed = cast_money(cast_cols(year, {"o_orderkey": "bigint", "o_orderdate": "date"}), ["o_totalprice"])
    return typed.select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"),
                        "o_orderdate", "o_orderpriority")


@register("year_layers")
def year_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as ``FY{year}*`` folders, each year read back by its
    glob, merged as text into one sized layer, and summed in SQL (S2, S4,
    S6, S8, S9, S16)."""
    od = roles.table(spark, sf, "orders")
    text = od.select(F.year("o_orderdate").alias("fy"), roles.s("o_orderkey").alias("o_orderkey"),
                     roles.s(roles.money("o_totalprice")).alias("o_totalprice"))
    base = scratch_path(spark, "year-landing")
    years = sorted(r[0] for r in text.select("fy").distinct().collect())  # the calendar years of the orders
    whole = None
    for y in years:
        for half in (0, 1):  # a year's files come in several deliveries
            rows = text.where((F.col("fy") == y) & (F.col("o_orderkey").cast("bigint") % 2 == half))
            write_layer(rows, f"{base}/FY{y}_{half}", mode="errorifexists", fmt="csv", header=True)
        whole = read_year(spark, base, y) if whole is None else whole.unionByName(read_year(spark, base, y))
    layer = f"{base}/layer"
    if read_if_exists(spark, layer) is None and whole is not None:
        write_sized(whole.unionByName(load_csv(spark, base, f"FY{years[0]}_0").limit(0)), layer, 5_000, exact=True)
    typed = cast_money(cast_cols(read_layer(spark, layer), {"o_orderkey": "bigint", "fy": "bigint"}), ["o_totalprice"])
    return sql_over(spark, {"sl_year_layer": typed}, """
        select fy, count(*) as n_orders, count(distinct o_orderkey) as n_keys, cast(sum(o_totalprice) as double) as total
        from sl_year_layer group by fy""")
