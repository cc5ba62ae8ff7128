"""Queries over several loads: drifting headers, stable keys, upserts.

Each builds the deliveries of its loads from the driver's tables, in the
schema the jobs expect, and runs the library's loads over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.clean import cast_cols, cast_money
from starledger.operators.registry import load_fact, register_keys
from starledger.operators.upsert import upsert_to
from starledger.operators import rollup as ro
from starledger.plans import roles, star
from starledger.plans.queries import register, widen
from starledger.session import scratch_path, store
from starledger.sources.files import read_layer, write_layer
from starledger.sources.reconcile import read_csv_reconciled


@register("csv_schema_drift")
def csv_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as CSV in three layouts by year (the columns in another
    order; one missing, one more), read back as one folder and typed (S1,
    S3, E1)."""
    od = roles.table(spark, sf, "orders")
    text = od.select(F.year("o_orderdate").alias("fy"), roles.s("o_orderkey").alias("o_orderkey"),
                     roles.s(roles.money("o_totalprice")).alias("o_totalprice"),
                     roles.s(F.col("o_orderdate").cast("date")).alias("o_orderdate"), "o_orderpriority", "o_orderstatus")
    layouts = [["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"],
               ["o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice"],
               ["o_orderdate", "o_orderstatus", "o_totalprice", "o_orderkey"]]
    base = scratch_path(spark, "drift")
    for i, columns in enumerate(layouts):
        write_layer(text.where(F.col("fy") % 3 == i).select(columns), f"{base}/delivery_{i}", fmt="csv", header=True)
    whole = read_csv_reconciled(spark, f"{base}/*")
    typed = cast_money(cast_cols(whole, {"o_orderkey": "bigint", "o_orderdate": "date"}), ["o_totalprice"])
    return typed.select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderdate",
                        "o_orderpriority", "o_orderstatus")


@register("stable_keys")
def stable_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Recipient keys and the fact over three loads of orders, each load
    with new recipients (W2, D4): keys given once stay, the fact of an
    earlier load is not rewritten."""
    od = roles.table(spark, sf, "orders").select(
        roles.s("o_custkey").alias("recipient_uei"), F.col("o_orderkey"), roles.money("o_totalprice").alias("total"),
        F.col("o_orderdate").cast("date").alias("action_date"))
    load = F.when(F.col("action_date") < "1995-02-01", 1).when(F.col("action_date") < "1995-06-01", 2).otherwise(3)
    base = scratch_path(spark, "stable-keys")
    for n in (1, 2, 3):
        rows = od.where(load == n).withColumn("delivery", F.lit(n))
        load_fact(rows, f"{base}/fact", {"recipient_key": (f"{base}/keys", "recipient_uei")}, "delivery")
    fact = read_layer(spark, f"{base}/fact").groupBy("recipient_key").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("total").cast("double").alias("total"))
    keys = read_layer(spark, f"{base}/keys")
    return keys.join(fact, "recipient_key").select("recipient_uei", "recipient_key", F.col("load").cast("bigint").alias("load"),
                                                   "n_orders", "total")


@register("keyed_upsert")
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions up to a year on storage, then one load with later rows,
    corrected amounts, deletions, rows that move to another fiscal year and
    stale versions, then that load again with old versions of the deleted
    rows (U4, E2).  A key that several lines share is one transaction: of
    equal versions the first load's stays, within a load the greatest row."""
    txn = roles.transactions(spark, sf).select(
        "transaction_unique_key", "total_obligated_amount", "last_modified_date", F.year("action_date").alias("fiscal_year"),
        ((F.col("award_unique_key").cast("bigint") + F.substring_index("transaction_unique_key", "_", -1).cast("bigint")) % 10)
        .alias("_case"))
    marked = store(txn, "upsert-deliveries").withColumn("correction_delete_indicator_code", F.lit(None).cast("string"))
    first = marked.where("fiscal_year <= 1996")
    later = lambda days: F.date_add("last_modified_date", days)
    second = marked.where("fiscal_year > 1996 or _case < 4").withColumns({
        "total_obligated_amount": F.when(F.col("_case").isin(0, 3), (F.col("total_obligated_amount") + 1).cast("decimal(18,2)"))
                                   .otherwise(F.col("total_obligated_amount")),
        "fiscal_year": F.col("fiscal_year") + F.when(F.col("_case") == 2, 1).otherwise(0),
        "last_modified_date": F.when(F.col("_case") == 3, later(-5)).when(F.col("_case") < 3, later(30))
                               .otherwise(F.col("last_modified_date")),
        "correction_delete_indicator_code": F.when(F.col("_case") == 1, "D")})
    third = second.unionByName(marked.where("_case = 1"))
    path = scratch_path(spark, "upsert-silver")
    for rows in (first, second, third):
        upsert_to(spark, path, rows.drop("_case"), "transaction_unique_key", "last_modified_date", "fiscal_year",
                  deleted=F.col("correction_delete_indicator_code") == "D")
    return widen(read_layer(spark, path).select("transaction_unique_key", "total_obligated_amount", "last_modified_date",
                                                "fiscal_year"))


@register("summary_incremental")
def summary_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Stored summary states of the fiscal years up to 1998, refreshed after
    a load of the later years and of corrections in 1998 (its second half
    was missing): the summaries by day and by month from states (E11, A8,
    A9, A12)."""
    txn = star.transaction_fact(spark, sf, True, True, True)
    agency = star.agency_dim(txn)
    codes = {"agency": "funding_agency_code", "recipient": "recipient_uei"}
    year = ro.fiscal_year_of(F.col("action_date_key"))
    path = scratch_path(spark, "states")
    ro.store_states(ro.period_states(txn.where((year <= 1998) & (F.col("action_date_key") < 19980401)), codes), path)
    years = [r[0] for r in txn.where(year >= 1998).select(year).distinct().collect()]
    ro.store_states(ro.period_states(txn, codes, years), path, years)
    states = ro.read_states(spark, path)
    names = ("agency", agency, "agency_code", "agency_name", "n")
    month = ro.rows_by_name(states, *names, grain="month_year")
    day = ro.rows_by_name(states, *names)
    parts = [ro.totals_by_day(states).select(F.lit("total").alias("kind"), roles.s("action_date_key").alias("period"),
                                             F.lit(None).cast("string").alias("name"), F.col("number_of_transactions").alias("n")),
             day.select(F.lit("day"), roles.s("action_date_key"), "agency_name", "n"),
             month.select(F.lit("month"), "calendar_year_month", "agency_name", "n")]
    return parts[0].union(parts[1]).union(parts[2])
