"""Incremental merge of a new fiscal year into silver (U4, Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starledger.session import drop_path, scratch_path
from starledger.sources.files import read_if_exists, write_sized

ROWS_PER_FILE = 2_500_000
MAX_PARTITIONS = 10_000  # partition values one load may touch


def merge_increment(current: DataFrame | None, new: DataFrame, dedupe_first: bool = False) -> DataFrame:
    """Existing rows plus the new ones, full-row distinct (U4).  When
    nothing exists yet the new rows are taken as they are, or, with
    ``dedupe_first``, distinct too, so that replaying the first load
    changes nothing.  A column that only one side has is null on the
    other."""
    if current is None:
        return new.distinct() if dedupe_first else new
    return current.unionByName(new, allowMissingColumns=True).distinct()


def touched_partitions(new: DataFrame, partition_col: str):
    """Literal predicate on the partition values present in ``new``.

    A semi join with the new rows would not prune (dynamic pruning needs
    a selective filter on the other side), so the whole history would be
    read.  The distinct partition values (fiscal years) are fetched and
    turned into a literal ``IN`` that prunes silver statically; more than
    ``MAX_PARTITIONS`` of them is an error (not a column of years)."""
    values = [r[0] for r in new.select(partition_col).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(values) > MAX_PARTITIONS:
        raise ValueError(f"{partition_col} has more than {MAX_PARTITIONS} values in this load")
    present = [v for v in values if v is not None]
    cond = F.col(partition_col).isin(present) if present else F.lit(False)
    return cond | F.col(partition_col).isNull() if None in values else cond


def merge_increment_to(spark: SparkSession, silver_path: str, new: DataFrame,
                       partition_col: str | None = None, rows_per_file: int = ROWS_PER_FILE,
                       dedupe_first: bool = False) -> int:
    """Merge ``new`` into the table at ``silver_path`` safely (Q5); returns
    the rows of the partitions written.

    The new rows are staged first (so their source is read once), then the
    merged partitions; the staged rows are counted against what the write
    produced, the target partitions are replaced from the staged files, and
    counted again.  Only then the staging folder goes.  With
    ``partition_col`` (the fiscal year) only the partitions present in the
    new data are read and rewritten.  Files hold about ``rows_per_file``
    rows."""
    staging = scratch_path(spark, "merge")
    parts = {"partition_by": partition_col} if partition_col else {}
    write_sized(new, f"{staging}/new", rows_per_file, mode="errorifexists", **parts)
    landed = spark.read.schema(new.schema).parquet(f"{staging}/new")
    current = read_if_exists(spark, silver_path)
    touched = touched_partitions(landed, partition_col) if partition_col else F.lit(True)
    if partition_col and current is None and not dedupe_first:
        merged_path, expected = f"{staging}/new", landed.count()
    else:
        merged_path, seen = f"{staging}/merged", Observation()
        merged = merge_increment(None if current is None else current.where(touched), landed, dedupe_first)
        write_sized(merged.observe(seen, F.count(F.lit(1)).alias("rows")), merged_path, rows_per_file,
                    mode="errorifexists", **parts)
        expected = seen.get["rows"]
    staged = spark.read.parquet(merged_path) if expected else landed.limit(0)
    if staged.count() != expected:
        raise RuntimeError(f"merge of {silver_path}: staged rows differ from the {expected} merged; target untouched")
    if expected:
        # per-write option (not a session setting): only the partitions present
        # in the staged data are replaced; safe next to concurrent writes
        options = {"partitionOverwriteMode": "dynamic"} if partition_col and current is not None else {}
        write_sized(staged, silver_path, rows_per_file, options=options, **parts)
        written = spark.read.parquet(silver_path).where(touched).count()
        if written != expected:
            raise RuntimeError(f"merge of {silver_path}: {written} rows written, {expected} staged in {merged_path}")
    drop_path(spark, staging)
    return expected
