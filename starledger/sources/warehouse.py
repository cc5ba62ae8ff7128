"""Typed publication of gold tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starledger.session import run_concurrently
from starledger.sources.schemas import FACT_TABLES, GOLD_TO_PUBLISHED


#: Rows of a published fact per bucket: a few hundred MB each.
BUCKET_ROWS = 4_000_000


def conform(df: DataFrame, schema: StructType, renames: dict | None = None,
            optional=()) -> DataFrame:
    """Project ``df`` onto ``schema`` *by name*.

    Gold names that differ from the contract are renamed first; every
    column is ``try_cast`` to its contract type.  A contract column the
    frame lacks is an error, unless it is named in ``optional``: then it
    becomes a typed null."""
    mapping = dict(GOLD_TO_PUBLISHED)
    mapping.update(renames or {})
    present = {c: c for c in df.columns}
    for old, new in mapping.items():
        if old in present and new not in present:
            present[new] = old
    out = []
    for f in schema.fields:
        if f.name in present:
            out.append(F.col(f"`{present[f.name]}`").try_cast(f.dataType).alias(f.name))
        elif f.name in optional:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name} missing for contract")
    return df.select(*out)


def publish(df: DataFrame, table: str, schema: StructType, database: str = "prod",
            bucket_by: str | None = None, buckets: int | None = None,
            mode: str = "overwrite", path: str | None = None, analyze: bool = True, optional=()) -> str:
    """Conform and save as a catalog table.

    Facts can be bucketed on the transaction key so later fact-fact
    joins on that key read co-located buckets without an exchange;
    dimensions are left unbucketed (joins broadcast them when small)."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    data = conform(df, schema, optional=optional)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bucket_by:
        # One shuffle on the bucket key first: every task then writes one
        # bucket file instead of one file per bucket it happens to hold.
        data = data.repartition(n, bucket_by)
    writer = data.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    if analyze:
        # size from file metadata only (no scan): lets the planner broadcast
        # small published dimensions statically
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return name


def refresh_warehouse(spark: SparkSession, tables: dict, schemas: dict,
                      database: str = "prod", buckets: int | None = None,
                      location: str | None = None, workers: int = 4, optional: dict | None = None) -> list[str]:
    """Full refresh (S13): drop what exists (summaries included), recreate,
    load every table.  ``location``: folder for the database and its tables
    (else the session's warehouse folder).  ``optional``: per table the
    contract columns a load may lack.  All facts get the same number of
    buckets, one per ``BUCKET_ROWS`` rows of the largest."""
    where = f" LOCATION '{location.rstrip('/')}/{database}.db'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for table in [*tables, *(t.name for t in spark.catalog.listTables(database))]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    if buckets is None:
        rows = max([tables[t].count() for t in FACT_TABLES if t in tables], default=0)
        buckets = max(1, -(-rows // BUCKET_ROWS))
    tasks = {}
    for table, df in tables.items():
        bucket = "transaction_unique_key" if table in FACT_TABLES else None
        path = f"{location.rstrip('/')}/{table}" if location else None
        tasks[table] = partial(publish, df, table, schemas[table], database, bucket_by=bucket,
                               buckets=buckets, path=path, optional=(optional or {}).get(table, ()))
    return list(run_concurrently(tasks, workers).values())
