"""Summaries from stored partial states.

Instead of one pass over the fact per summary, one scan feeds all grains:
``GROUPING SETS`` over (day) and (day, code) for each role, counted per
fiscal year.  Awards keep their distinct (day, amounts) rows with the
smallest transaction key, which is all that the award tables need.  Every
summary, by day or by month, is a small aggregation of these states.

States are stored per fiscal year.  A load recomputes the states of the
years it touched, from those partitions of the fact alone, and replaces
them; counts, sums, minima and distinct rows of all other years stay as
stored, so deletions and corrections need no retraction and the result
always equals a rebuild.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators import summaries as sm
from starledger.session import drop_path
from starledger.sources.files import read_if_exists, write_sized
from starledger.sources.schemas import FISCAL_START_MONTH

YEAR, DAY, TXN = "fiscal_year", "action_date_key", "transaction_unique_key"
ALL = "all"        # the grain without a code
ROWS_PER_FILE = 2_500_000
NO_YEAR = 0        # fiscal year of rows without a day


def fiscal_year_of(day_key: Column) -> Column:
    """Fiscal year of a ``yyyymmdd`` key (``NO_YEAR`` for null)."""
    month = F.floor(day_key / 100) % 100
    return F.coalesce((F.floor(day_key / 10000) + F.when(month >= FISCAL_START_MONTH, 1).otherwise(0)).cast("int"),
                      F.lit(NO_YEAR))


def _touching(fact: DataFrame, years) -> DataFrame:
    fact = fact.withColumn(YEAR, fiscal_year_of(F.col(DAY)))
    return fact if years is None else fact.where(F.col(YEAR).isin([int(y) for y in years]))


def period_states(fact: DataFrame, codes: Mapping[str, str], years=None) -> DataFrame:
    """(grain, day, code, rows, transactions, fiscal year) of the given
    fiscal years (default: all), one scan for all grains.  ``codes``: grain
    name to code column; the grain ``all`` has no code."""
    fact = _touching(fact, years)
    columns = [YEAR, DAY, *codes.values()]
    sets = [[YEAR, DAY], *[[YEAR, DAY, c] for c in codes.values()]]
    fact = fact.select(*columns, TXN)
    grouped = fact.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    made = grouped.agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n_rows"), F.count(TXN).alias("n_transactions"))
    grain, code = F.lit(ALL), F.lit(None).cast("string")
    for i, (name, c) in enumerate(codes.items()):     # the set's one code has bit 0, all other codes have bit 1
        own = (1 << len(codes)) - 1 - (1 << (len(codes) - 1 - i))
        grain = F.when(F.col("_g") == own, name).otherwise(grain)
        code = F.when(F.col("_g") == own, F.col(c).cast("string")).otherwise(code)
    return made.select(grain.alias("grain"), DAY, code.alias("code"), "n_rows", "n_transactions", YEAR)


def award_states(txn: DataFrame, assistance: DataFrame, years=None) -> DataFrame:
    """Distinct (award, day, obligated, loan value) rows of the given fiscal
    years with the smallest transaction key of each."""
    amounts = ["total_obligated_amount", "total_face_value_of_loan"]
    j = _touching(txn.select(TXN, "award_unique_key", DAY, amounts[0]), years).join(assistance.select(TXN, amounts[1]), TXN)
    return j.groupBy("award_unique_key", DAY, *amounts, YEAR).agg(F.min(TXN).alias("first_transaction"))


def store_states(states: DataFrame, path: str, years=None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write states of ``years`` (default: all years) in place of those
    stored before; other years keep their files.  A year without states any
    more loses its folder."""
    spark = states.sparkSession
    stored = None if years is None else read_if_exists(spark, path)
    options = {"partitionOverwriteMode": "dynamic"} if stored is not None else {}
    write_sized(states, path, rows_per_file, partition_by=YEAR, options=options)
    if stored is not None:
        touched = [int(y) for y in years]
        kept = {r[0] for r in states.select(YEAR).distinct().collect()}     # a handful of fiscal years
        for year in set(touched) - kept:
            drop_path(spark, f"{path.rstrip('/')}/{YEAR}={year}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _codes(states: DataFrame, grain: str) -> DataFrame:
    return states.where((F.col("grain") == grain) & F.col("code").isNotNull())


def totals_by_day(states: DataFrame) -> DataFrame:
    """Transactions per action day."""
    return states.where(F.col("grain") == ALL).groupBy(DAY).agg(F.sum("n_transactions").alias("number_of_transactions"))


def rows_by_name(states: DataFrame, role: str, dim: DataFrame, code: str, names, out: str, grain: str = "day",
                 dates: DataFrame | None = None) -> DataFrame:
    """Rows per period and names of a code's dimension (A9, A10, A12, A13,
    A19)."""
    names = [names] if isinstance(names, str) else list(names)
    named = dim.select(F.col(code).cast("string").alias("code"), *names)
    j, period = sm._grain(_codes(states, role).join(named, "code"), grain, dates)
    return j.groupBy(period, *names).agg(F.sum("n_rows").alias(out))


def small_business(states: DataFrame, role: str, grain: str = "day", dates: DataFrame | None = None) -> DataFrame:
    """Small-business and sized transactions per period (A11, A14); the code
    is the business size key."""
    j, period = sm._grain(states.where(F.col("grain") == role), grain, dates)
    return j.groupBy(period).agg(
        F.sum(F.when(F.col("code") == "1", F.col("n_rows")).otherwise(0)).alias("small_business_transactions"),
        F.sum(F.when(F.col("code").isNotNull(), F.col("n_rows")).otherwise(0)).alias("total_transactions"))


def by_award(awards: DataFrame) -> DataFrame:
    """Per award: max obligated, max loan face value, first action day."""
    return awards.groupBy("award_unique_key").agg(
        F.max("total_obligated_amount").alias("total_obligated_amount"),
        F.max("total_face_value_of_loan").alias("total_face_value_of_loan"), F.min(DAY).alias("initial_action_date_key"))


def award_dates(awards: DataFrame) -> DataFrame:
    """Distinct (award, day, obligated, loan value) rows (A16); a day lies
    in one fiscal year, so rows of different years differ."""
    return awards.select("award_unique_key", DAY, "total_obligated_amount", "total_face_value_of_loan")


def award_first_rows(awards: DataFrame) -> DataFrame:
    """The first transaction per award and day (A18): the smallest of the
    groups' smallest."""
    amounts = ["total_obligated_amount", "total_face_value_of_loan"]
    first = sm.first_per_group(awards.where(F.col(DAY).isNotNull()), ["award_unique_key", DAY],
                               [amounts[0], "first_transaction", amounts[1]], columns=amounts)
    return first.select(DAY, "award_unique_key", *amounts)
