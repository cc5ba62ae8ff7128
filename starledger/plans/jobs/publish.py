"""Gold to typed catalog tables, then summaries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from starledger.operators import rollup as ro
from starledger.operators import summaries as sm
from starledger.session import drop_path, run_concurrently, scratch_path
from starledger.sources.schemas import OPTIONAL_COLUMNS, TABLES
from starledger.sources.warehouse import refresh_warehouse


def job_publish(spark: SparkSession, gold: dict, database: str = "prod",
                buckets: int | None = None, location: str | None = None) -> list[str]:
    """Publish every gold frame under its contract."""
    return refresh_warehouse(spark, gold, TABLES, database, buckets=buckets, location=location,
                             optional=OPTIONAL_COLUMNS)


#: Grains of the summaries over FactTransaction, and over its contract rows.
TRANSACTION_CODES = {"agency": "funding_agency_code", "recipient": "recipient_uei"}
CONTRACT_CODES = {"industry": "naics_key", "size": "business_size_key"}


def refresh_states(spark: SparkSession, database: str, root: str, years=None) -> dict:
    """Recompute the summaries' stored states (all, or those of the fiscal
    years a load touched) with one scan of FactTransaction for each of the
    three: its own grains, those of contracts, and awards."""
    t = lambda name: spark.table(f"{database}.{name}")
    txn, contract = t("FactTransaction"), t("FactContract")
    contracts = txn.select(ro.TXN, ro.DAY).join(contract.select(ro.TXN, *CONTRACT_CODES.values()), ro.TXN)
    states = {"periods": ro.period_states(txn, TRANSACTION_CODES, years),
              "contracts": ro.period_states(contracts, CONTRACT_CODES, years),
              "awards": ro.award_states(txn, t("FactAssistance"), years)}
    for name, df in states.items():
        ro.store_states(df, f"{root.rstrip('/')}/{name}", years)
    return {name: ro.read_states(spark, f"{root.rstrip('/')}/{name}") for name in states}


def summary_frames(spark: SparkSession, states: dict, database: str = "prod") -> dict:
    """Every summary (E11), from stored states and the labelling dimensions;
    only the county summary reads the fact, once, pre-aggregated."""
    t = lambda name: spark.table(f"{database}.{name}")
    dates, agency, naics = t("DimDate"), t("DimAgency"), t("DimNAICS")
    periods, contracts, awards = states["periods"], states["contracts"], states["awards"]
    agencies = partial(ro.rows_by_name, periods, "agency", agency, "agency_code", "agency_name", "agency_count")
    industries = partial(ro.rows_by_name, contracts, "industry", naics, "naics_key", ["naics_code", "naics_description"],
                         "industry_count")
    return {
        "ViewSummaryByAward": ro.by_award(awards),
        "ViewSummaryTotalsByDay": ro.totals_by_day(periods),
        "ViewAgenciesByDay": agencies(),
        "ViewRecipientsByDay": ro.rows_by_name(periods, "recipient", t("DimRecipient"), "recipient_uei", "recipient_name_raw",
                                               "recipient_count"),
        "ViewIndustriesByDay": industries(),
        "ViewSmallBusinessSummaryByDay": ro.small_business(contracts, "size"),
        "ViewAgenciesByMonth": agencies(grain="month", dates=dates),
        "ViewIndustriesByMonth": industries(grain="month", dates=dates),
        "ViewSmallBusinessSummaryByMonth": ro.small_business(contracts, "size", "month", dates),
        "ViewObligatedFedAmtByFips": sm.summary_by_county(t("FactTransaction"), t("DimCounty")),
        "AwardByDateTable": ro.award_dates(awards),
        "AwardSumsDedup": ro.award_first_rows(awards),
    }


def job_summaries(spark: SparkSession, database: str = "prod", location: str | None = None,
                  workers: int = 4, states: str | None = None, years=None) -> list[str]:
    """Materialise the summaries as tables (E11), at ``location`` if given;
    the independent writes run side by side.  ``states``: folder of the
    stored states (default: scratch space, dropped afterwards); with it and
    ``years``, the fiscal years touched since, only their states are
    recomputed."""
    if years is not None and states is None:
        raise ValueError("an incremental refresh needs the folder of the stored states")
    root = states or scratch_path(spark, "summary-states")
    stored = refresh_states(spark, database, root, years)

    def save(name, df):
        writer = df.write.mode("overwrite").format("parquet")
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{name}")
        writer.saveAsTable(f"{database}.{name}")
        return f"{database}.{name}"
    tasks = {name: partial(save, name, df) for name, df in summary_frames(spark, stored, database).items()}
    done = list(run_concurrently(tasks, workers).values())
    # from the table just written, not from the facts again
    by_day = sm.award_sums_by_day(spark.table(f"{database}.AwardByDateTable"))
    done.append(save("ViewAwardSumsByDay", by_day))
    if states is None:
        drop_path(spark, root)
    return done
