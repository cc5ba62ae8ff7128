"""Scans and sinks."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starledger.sources.reconcile import read_csv_reconciled


def read_csv(spark: SparkSession, path, schema: StructType | None = None,
             infer: bool = False, header: bool = True, **options) -> DataFrame:
    """CSV scan (S1, S3).  Default: every column as string, so codes keep
    their leading zeros and dirty numbers can be ``try_cast`` later.
    ``infer=True`` reproduces inference (an extra pass over the files)."""
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def load_csv(spark: SparkSession, base: str, relative: str, **options) -> DataFrame:
    """CSV scan addressed by (base location, relative path)."""
    return read_csv(spark, f"{base.rstrip('/')}/{relative.lstrip('/')}", **options)


def read_year(spark: SparkSession, base: str, year, layout: str = "glob",
              year_col: str = "fiscal_year", **options) -> DataFrame:
    """Files of one fiscal year.

    ``layout="glob"``: files named ``FY{year}*`` under ``base``, united by
    the names in their headers; an empty year or a year without files is an
    error, never an empty result.
    ``layout="partitioned"``: ``base/{year_col}={year}/`` folders written by
    :func:`write_csv_years`; the year filter prunes the other folders, and a
    year without rows is an error as well."""
    if year is None or str(year).strip() == "":
        raise ValueError("a fiscal year is required")
    if layout == "partitioned":
        df = read_csv(spark, base, **options).where(F.col(year_col) == F.lit(int(str(year).strip())))
        if df.isEmpty():  # reads one row of the pruned folder
            raise FileNotFoundError(f"no rows for fiscal year {year} under {base}")
        return df.drop(year_col)
    path = f"{base.rstrip('/')}/FY{str(year).strip()}*"
    try:
        if {"schema", "infer"} & set(options) or options.get("header") is False:
            return read_csv(spark, path, **options)
        return read_csv_reconciled(spark, path, **{k: v for k, v in options.items() if k != "header"})
    except AnalysisException as exc:
        if _is_missing(exc):
            raise FileNotFoundError(f"no files for fiscal year {year} under {base}") from exc
        raise


def read_layer(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """Parquet scan of a directory or glob (S5).  A known ``schema`` skips
    the footer-reading inference job (worth it over many files)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else list(path)))


def _is_missing(exc: AnalysisException) -> bool:
    condition = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    name = condition() if condition else None
    return name == "PATH_NOT_FOUND" or (name is None and "PATH_NOT_FOUND" in str(exc))


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Scan that returns ``None`` when the path does not exist yet (S6);
    every other failure propagates."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        if _is_missing(exc):
            return None
        raise


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                partition_by=None, fmt: str = "parquet", **options) -> None:
    """Parquet sink (S7, S8, S10).  ``files=1`` is meant for dimensions
    only; facts use :func:`write_sized`."""
    if files is not None:
        df = df.repartition(max(1, int(files)))
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)


def write_sized(df: DataFrame, path: str, rows_per_file: int, mode: str = "overwrite",
                exact: bool = False, partition_by=None, options: dict | None = None, rebalance: bool = True) -> None:
    """Write with about ``rows_per_file`` rows per file.

    Default: one pass.  A ``REBALANCE`` hint lets adaptive execution
    even out the task sizes and ``maxRecordsPerFile`` caps every file, so
    the frame is computed once.  ``exact=True`` reproduces the
    count-then-repartition form (two passes; ``max(1, ...)`` avoids
    ``repartition(0)`` on an empty frame).  Also used for dimensions:
    small ones end in one file after AQE coalescing, large ones (e.g.
    recipients) are not funnelled through a single task.
    ``rebalance=False``: the frame's own tasks are even, they write."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if exact:
        n = df.count()
        df = df.repartition(max(1, math.ceil(n / rows_per_file)), *parts)
    elif rebalance:
        # Rebalancing by the partition columns keeps each task to ~one
        # output partition (few files) while AQE still splits a big one.
        df = df.hint("rebalance", *parts)
    writer = df.write.mode(mode).options(**(options or {})).option("maxRecordsPerFile", int(rows_per_file))
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)


def write_csv_years(df: DataFrame, base: str, year_col: str, mode: str = "overwrite") -> str:
    """Land a frame as CSV folders per year, ``base/{year_col}=YYYY/`` (one
    pass; read back with ``read_year(..., layout="partitioned")``)."""
    df.write.mode(mode).option("header", True).partitionBy(year_col).csv(base)
    return base


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Bounded preview (S15); the limit is the feature here."""
    return df.limit(n)


def sql_over(spark: SparkSession, frames: dict, text: str) -> DataFrame:
    """Register frames as temporary views and run SQL over them."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text)
