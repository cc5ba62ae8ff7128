"""Role views: the award pipeline's inputs expressed over the driver's
star-schema tables (lineitem, orders, customer, supplier, part, nation,
region, events).  Pure projections and joins, so every query built on
them reads whole tables and grows with them.

Mapping (same text in the oracle SQL):
  transaction  = lineitem x orders; key = orderkey_partkey_suppkey_linenumber
  award        = l_orderkey;  family: l_linestatus F -> assistance, O -> contract
  action date  = l_shipdate;  last modified = o_orderdate
  obligated    = l_extendedprice; loan face value = o_totalprice (decimal 18,2)
  awarding agency = customer's nation; funding agency = supplier's nation
  recipient    = customer; recipient county = customer's nation (5-digit code)
  industry     = (p_brand, nullif(p_type, 'ECONOMY'))
  business size code = l_returnflag; performance scope = nullif(o_orderpriority, '5-LOW')
  districts    = event-type name + 2-digit number, from supplier/part and customer/line
  officers 1..5 = supplier name of line 1..5 of the order (min per slot)
  elections    = events: state = event_type, candidate = user_id, votes = value
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starledger.operators.keys import measured_bytes
from starledger.sources.schemas import BROADCAST_MAX_BYTES

# Event types of the driver's events table, sorted.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
OFFICER_SLOTS = [f"highly_compensated_officer_{i}_name" for i in range(1, 6)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def s(c) -> Column:
    """Column as string."""
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def money(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("decimal(18,2)")


def txn_key() -> Column:
    return F.concat_ws("_", s("l_orderkey"), s("l_partkey"), s("l_suppkey"), s("l_linenumber"))


def event_type_of(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (c % 5 + 1).cast("int"))


def district_of(name_src: Column, number_src: Column, modulus: int) -> Column:
    return F.concat(event_type_of(name_src), F.lit("-"),
                    F.lpad(s(number_src % modulus), 2, "0"))


def transactions(spark: SparkSession, sf: str, customer: bool = False, supplier: bool = False,
                 part: bool = False, orders: bool = True, officers: bool = False) -> DataFrame:
    """The conformed transaction role (silver-like, typed).  ``orders=False``
    leaves out the order's columns, and the join with orders (every line
    has one), unless the customer, reached through it, is asked for.

    ``officers``: joined with :func:`officer_slots` by transaction key.  A
    key begins with its order, so that join is one by order with each row
    as often as lines share its key: all on lines dealt by order once."""
    df = table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    orders = orders or customer
    small = officers and measured_bytes(
        table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")) <= BROADCAST_MAX_BYTES
    if officers:
        df = with_officers(df, supplier_names(spark, sf), small)
    if orders:
        od = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        if customer:    # a customer belongs to the order: joined before its lines
            cu = table(spark, sf, "customer")
            na = table(spark, sf, "nation").select(F.col("n_nationkey").alias("_cn"), F.col("n_name").alias("_cnn"))
            od = od.join(cu, od["o_custkey"] == cu["c_custkey"]).join(na, F.col("c_nationkey") == F.col("_cn"))
        df = df.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    cols = [
        txn_key().alias("transaction_unique_key"),
        s("l_orderkey").alias("award_unique_key"),
        F.when(F.col("l_linestatus") == "F", "assistance").otherwise("contract").alias("award_type"),
        F.col("l_shipdate").cast("date").alias("action_date"),
        money("l_extendedprice").alias("total_obligated_amount"),
        F.col("l_returnflag").alias("business_size_code"),
        district_of(F.col("l_suppkey"), F.col("l_partkey"), 4)
        .alias("prime_award_transaction_recipient_cd_original"),
    ]
    if orders:
        cols += [
            F.col("o_orderdate").cast("date").alias("last_modified_date"),
            money("o_totalprice").alias("total_face_value_of_loan"),
            s("o_custkey").alias("recipient_uei"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
             .alias("primary_place_of_performance_scope"),
            district_of(F.col("o_custkey"), F.col("l_linenumber"), 6)
            .alias("prime_award_transaction_place_of_performance_cd_original"),
        ]
    if customer:
        cols += [s("c_nationkey").alias("awarding_agency_code"), F.col("_cnn").alias("awarding_agency_name"),
                 F.col("c_name").alias("recipient_name_raw"),
                 F.lpad(s("c_nationkey"), 5, "0").alias("prime_award_transaction_recipient_county_fips_code"),
                 F.col("_cnn").alias("recipient_county_name")]
    if supplier:
        su = table(spark, sf, "supplier")
        na = table(spark, sf, "nation").select(F.col("n_nationkey").alias("_sn"), F.col("n_name").alias("_snn"))
        df = df.join(F.broadcast(su) if small else su, df["l_suppkey"] == su["s_suppkey"]).join(na, F.col("s_nationkey") == F.col("_sn"))
        cols += [s("s_nationkey").alias("funding_agency_code"), F.col("_snn").alias("funding_agency_name"),
                 F.lpad(s("s_nationkey"), 5, "0")
                 .alias("prime_award_transaction_place_of_performance_county_fips_code"),
                 F.col("_snn").alias("primary_place_of_performance_county_name")]
    if part:
        pa = table(spark, sf, "part")
        df = df.join(pa, df["l_partkey"] == pa["p_partkey"])
        cols += [F.col("p_brand").alias("naics_code"),
                 F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("naics_description")]
    if officers:
        df = df.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_lines"))))
        cols += OFFICER_SLOTS
    return df.select(*cols)


def supplier_names(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier key, the smallest name."""
    return table(spark, sf, "supplier").where(F.col("s_suppkey").isNotNull()).groupBy(
        F.col("s_suppkey").alias("_supplier")).agg(F.min("s_name").alias("_name"))


def with_officers(lines: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """Lines with the officer names of their order (min per slot) and
    ``_lines``, how many share their transaction key; lines of an order
    without any known supplier go.  One shuffle and one sort by order serve
    all of it.  ``small``: the suppliers' bytes were checked; names are broadcast
    to lines already dealt, else joined before, on narrow rows."""
    def named(df):
        return df.join(F.broadcast(names) if small else names, F.col("l_suppkey") == F.col("_supplier"), "left")

    lines = lines.where(F.col("l_orderkey").isNotNull())
    dealt = named(lines.repartition("l_orderkey")) if small else named(lines).repartition("l_orderkey")
    order = Window.partitionBy("l_orderkey")
    found = dealt.withColumn("_lines", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", txn_key()))).withColumns({
        "_known": F.count("_supplier").over(order),
        **{slot: F.min(F.when(F.col("l_linenumber") == i, F.col("_name"))).over(order) for i, slot in enumerate(OFFICER_SLOTS, 1)}})
    return found.where(F.col("_known") > 0).drop("_known", "_supplier", "_name")


def order_officers(spark: SparkSession, sf: str) -> DataFrame:
    """Per order, the five officer names (min per slot)."""
    li = table(spark, sf, "lineitem")
    su = table(spark, sf, "supplier")
    named = li.join(su, li["l_suppkey"] == su["s_suppkey"])
    return named.groupBy("l_orderkey").agg(*[
        F.min(F.when(F.col("l_linenumber") == i, F.col("s_name"))).alias(slot) for i, slot in enumerate(OFFICER_SLOTS, 1)])


def officer_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Per transaction, the five officer names of its order."""
    return table(spark, sf, "lineitem").join(order_officers(spark, sf), "l_orderkey").select(
        txn_key().alias("transaction_unique_key"), *OFFICER_SLOTS)


def house_results(spark: SparkSession, sf: str) -> DataFrame:
    """Election rows for districts (house role)."""
    ev = table(spark, sf, "events")
    return ev.select(
        (F.lit(2014) + F.lit(2) * (F.dayofmonth("ts") % 5)).cast("int").alias("year"),
        F.col("event_type").alias("state_po"),
        s(F.hour("ts") % 4).alias("district"),
        s("user_id").alias("candidate"),
        F.concat(F.lit("party "), s(F.col("event_id") % 3)).alias("party"),
        money("value").alias("candidatevotes"))


def county_results(spark: SparkSession, sf: str) -> DataFrame:
    """Election rows per county (presidential role)."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.when(F.dayofmonth("ts") % 2 == 0, F.lit(2016)).otherwise(F.lit(2020)).alias("year"),
        F.lpad(s(F.col("user_id") % 25), 5, "0").alias("county_fips"),
        F.col("event_type").alias("candidate"),
        F.concat(F.col("event_type"), F.lit(" party")).alias("party"),
        money("value").alias("candidatevotes"))


def county_gdp(spark: SparkSession, sf: str) -> DataFrame:
    """GDP role: all suppliers, summed per nation; nations whose key leaves
    2 modulo 5 have no row, so the inner enrichment drops those counties."""
    su = table(spark, sf, "supplier").where(F.col("s_nationkey") % 5 != 2)
    return su.groupBy("s_nationkey").agg(
        F.floor(F.sum(money("s_acctbal"))).cast("long").alias("gdp_2022")).select(
        F.lpad(s("s_nationkey"), 5, "0").alias("fips_code"), "gdp_2022")


def county_population(spark: SparkSession, sf: str) -> DataFrame:
    """Population role: customers per nation in 2019, one more each year."""
    cu = table(spark, sf, "customer")
    years = [f"popestimate{y}" for y in (2019, 2020, 2021, 2022)]
    return cu.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n")).select(
        F.lpad(s("c_nationkey"), 5, "0").alias("fips_code"),
        *[(F.col("_n") + i).alias(y) for i, y in enumerate(years)])
