"""The whole historical load in order (E1 -> E11), and the yearly
variant.  Paths follow ``root/{silver,gold,warehouse}/...``; raw files are
read from ``landing``.  Published tables live at explicit paths under the
lake root, so a re-run overwrites its own folders whatever the catalog
remembers."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from starledger.operators.dims import calendar_dim
from starledger.plans.jobs import externals as ext
from starledger.plans.jobs.bronze import job_b2s, job_b2s_year
from starledger.plans.jobs.gold import gold_assistance, gold_contracts, gold_transactions
from starledger.plans.jobs.publish import job_publish, job_summaries
from starledger.session import run_concurrently
from starledger.sources.files import read_layer, write_sized
from starledger.sources.schemas import CALENDAR_BEGIN, CALENDAR_END, ROWS_PER_FILE

DIM_ROWS_PER_FILE = 5_000_000
GOLD_ROWS = {"FactTransaction": ROWS_PER_FILE["gold_transaction"],
             "FactAssistance": ROWS_PER_FILE["gold_assistance"],
             "FactContract": ROWS_PER_FILE["gold_contract"]}


def fixed_calendar(spark: SparkSession):
    """DimDate over the default span, in date order."""
    return calendar_dim(spark, CALENDAR_BEGIN, CALENDAR_END).sort("date_key")


def run_externals(spark: SparkSession, landing: str, silver: str, workers: int = 4) -> None:
    """The six external jobs are independent; they run side by side."""
    jobs = (ext.job_house, ext.job_education, ext.job_gdp, ext.job_population, ext.job_presidential,
            ext.job_unemployment)
    run_concurrently({job.__name__: partial(job, spark, f"{landing}/external_data", silver) for job in jobs},
                     workers)


def run_gold(spark: SparkSession, silver: str, gold: str, calendar=None, workers: int = 4) -> dict:
    """Silver -> gold parquet, every table sized by rows per file; every
    surrogate key comes from a registry beside the gold tables, so it stays
    the same when the next year is loaded; every
    table is then read back, so later steps start from written data (no
    recomputation, lineage cut)."""
    registry = f"{gold.rstrip('/')}_keys"
    assistance = read_layer(spark, f"{silver}/assistance")
    contract = read_layer(spark, f"{silver}/contract")
    externals = {
        "education": read_layer(spark, f"{silver}/external/county/education"),
        "gdp": read_layer(spark, f"{silver}/external/county/gdp"),
        "pop_est": read_layer(spark, f"{silver}/external/county/pop_est"),
        "pres": read_layer(spark, f"{silver}/external/county/pres"),
        "house": read_layer(spark, f"{silver}/external/cd/house"),
    }
    # the three builders are independent (each runs its own checkpoint and
    # count jobs while building), so they are built side by side too
    parts = run_concurrently({
        "assistance": partial(gold_assistance, assistance),
        "transactions": partial(gold_transactions, assistance, contract, externals, calendar=calendar, registry=registry),
        "contracts": partial(gold_contracts, contract, registry=registry)}, workers)
    tables = {}
    for part in parts.values():
        tables.update(part)
    run_concurrently({name: partial(write_sized, df, f"{gold}/{name}", GOLD_ROWS.get(name, DIM_ROWS_PER_FILE))
                      for name, df in tables.items()}, workers)
    return {name: read_layer(spark, f"{gold}/{name}") for name in tables}


def run_historical(spark: SparkSession, landing: str, root: str, database: str = "prod",
                   calendar=None) -> dict:
    """``calendar``: DimDate; by default the fixed span."""
    calendar = fixed_calendar(spark) if calendar is None else calendar
    silver, gold = f"{root}/silver", f"{root}/gold"
    run_concurrently({family: partial(job_b2s, spark, landing, silver, family)
                      for family in ("assistance", "contract")}, 2)
    run_externals(spark, landing, silver)
    tables = run_gold(spark, silver, gold, calendar)
    job_publish(spark, tables, database, location=f"{root}/warehouse")
    job_summaries(spark, database, location=f"{root}/warehouse/{database}.db")
    return tables


def run_yearly(spark: SparkSession, landing: str, root: str, year, database: str = "prod",
               calendar=None) -> dict:
    """One fiscal year merged into silver, then gold and the warehouse
    rebuilt (only bronze -> silver is incremental)."""
    calendar = fixed_calendar(spark) if calendar is None else calendar
    silver, gold = f"{root}/silver", f"{root}/gold"
    for family in ("assistance", "contract"):
        job_b2s_year(spark, landing, silver, family, year)
    tables = run_gold(spark, silver, gold, calendar)
    job_publish(spark, tables, database, location=f"{root}/warehouse")
    job_summaries(spark, database, location=f"{root}/warehouse/{database}.db")
    return tables
