"""Upsert by transaction key, with corrections, deletions and moves between
partitions (U4, E2).

The full-row distinct of a plain merge keeps a corrected row next to its
first version.  Here a row replaces an older version of its key, a
deletion leaves a tombstone, and a row whose partition (fiscal year)
changed leaves its old partition.

Beside the table lies an index, append-only: (key, partition, version,
deleted) of every change applied.  It tells without a scan of the table
which keys a load really changes, in which partitions their old versions
are, and that a late copy of an old version, or of a deleted row, is old.
Reading it is a scan of a few narrow columns, joined by key.

Only partitions that hold an old or a new version of a changed key are
read and rewritten.  The table is written before the index, and all steps
give the same state when a load is repeated after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.merge import ROWS_PER_FILE, touched_partitions
from starledger.session import drop_path, scratch_path
from starledger.sources.files import read_if_exists, write_sized

STAGING_CODEC = "zstd"     # staged rows are read once or twice
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def latest_versions(rows: DataFrame, key: str, version: str, deleted: Column) -> DataFrame:
    """The last row of each key: greatest ``version`` (null before all
    others), a deletion after other rows of the same version, remaining ties
    by the greatest row in column order.  An aggregation: partial results
    before the shuffle, so a key with very many versions is no hot task.
    The row is its own order (two equal copies side by side, which the
    shuffle's compression makes one), and the result stays dealt by key,
    for a join."""
    rest = [c for c in rows.columns if c not in (key, version)]
    order = F.struct(F.col(version).alias("_version"), F.coalesce(deleted, F.lit(False)).alias("_last"),
                     *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)])     # null before all others
    last = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max_by(order, order).alias("_r"))
    found = {key: F.col("_k"), version: F.col("_r")["_version"], **{c: F.col("_r")[f"_c{i}"] for i, c in enumerate(rest)}}
    return last.select(*[found[c].alias(c) for c in rows.columns])


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_index"


def read_index(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The last entry of each key: ``key``, ``partition`` (null for none),
    ``version``, ``deleted``."""
    log = read_if_exists(spark, index_path(path))
    if log is None:
        return None
    last = log.groupBy(F.col(key)).agg(F.max(F.struct("load", "partition", "version", "deleted")).alias("_e"))
    return last.select(key, "_e.partition", "_e.version", "_e.deleted")


def upsert_to(spark: SparkSession, path: str, new: DataFrame, key: str, version: str, partition_col: str,
              deleted: Column | None = None, rows_per_file: int = ROWS_PER_FILE) -> dict[str, int]:
    """Apply one load to the table at ``path``; returns the numbers of rows
    ``inserted``, ``updated``, ``deleted`` and ``stale`` (versions not newer
    than what is there).

    ``deleted`` is a condition over ``new``: such a row removes its key.
    Rows without a key are left out, as in the cleaning rules.  The first
    load may hold several versions, too."""
    deleted = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    staging = scratch_path(spark, "upsert")
    rows = latest_versions(new.withColumn("_deleted", deleted), key, version, F.col("_deleted"))
    index = read_index(spark, path, key)
    if index is None:
        changes = rows.withColumns({"_known": F.lit(False), "_was": F.lit(None).cast(new.schema[partition_col].dataType),
                                    "_gone": F.lit(True), "_applies": F.lit(True)})
    else:
        old = index.select(F.col(key).alias("_key"), F.col("partition").alias("_was"), F.col("version").alias("_version"),
                           F.col("deleted").alias("_gone"))
        changes = rows.join(old, rows[key] == old["_key"], "left").withColumn("_known", F.col("_key").isNotNull())
        newer = F.col("_version").isNull() & F.col(version).isNotNull() | (F.col(version) > F.col("_version"))
        changes = changes.withColumn("_applies", ~F.col("_known") | F.coalesce(newer, F.lit(False))).drop("_key", "_version")
    # of a version that does not apply only the count is needed
    changes = changes.select(*[c if c == "_applies" else F.when(F.col("_applies"), F.col(f"`{c}`")).alias(c)
                               for c in changes.columns])
    changes.write.parquet(f"{staging}/changes", compression=STAGING_CODEC)
    staged = spark.read.schema(changes.schema).parquet(f"{staging}/changes")
    applied = staged.where("_applies")
    lives = F.coalesce(~F.col("_gone"), F.lit(False))
    count = lambda cond: F.coalesce(F.sum((F.col("_applies") & cond).cast("long")), F.lit(0))
    seen = staged.agg(count(~F.col("_deleted") & ~lives).alias("inserted"), count(~F.col("_deleted") & lives).alias("updated"),
                      count(F.col("_deleted") & lives).alias("deleted"),
                      F.coalesce(F.sum((~F.col("_applies")).cast("long")), F.lit(0)).alias("stale"),
                      count(F.lit(True)).alias("applied")).first().asDict()
    if seen.pop("applied"):
        _rewrite(spark, path, applied, new.columns, key, partition_col, rows_per_file, staging, lives)
        log = read_if_exists(spark, index_path(path))
        load = 1 if log is None else (log.agg(F.max("load")).first()[0] or 0) + 1
        entry = applied.select(key, F.when(~F.col("_deleted"), F.col(partition_col)).alias("partition"),
                               F.col(version).alias("version"), F.col("_deleted").alias("deleted"))
        write_sized(entry, f"{index_path(path)}/load={load}", rows_per_file, mode="errorifexists", rebalance=False)
    drop_path(spark, staging)
    return seen


def _rewrite(spark, path, applied, columns, key, partition_col, rows_per_file, staging, lives) -> None:
    """Replace the partitions that hold an old or a new version of an applied row."""
    live = applied.where(~F.col("_deleted")).select(*[f"`{c}`" for c in columns])
    places = live.select(partition_col).unionByName(applied.where(lives).select(F.col("_was").alias(partition_col)))
    touched = touched_partitions(places, partition_col)
    current = read_if_exists(spark, path)
    if current is None:         # nothing to merge with: the staged changes are the copy
        write_sized(live, path, rows_per_file, partition_by=partition_col)
        return
    rest = current.where(touched)
    merged = rest.join(applied.select(F.col(key).alias("_key")), rest[key] == F.col("_key"), "left_anti").unionByName(
        live, allowMissingColumns=True)
    merged.write.parquet(f"{staging}/merged", compression=STAGING_CODEC)
    written = spark.read.schema(merged.schema).parquet(f"{staging}/merged")
    write_sized(written, path, rows_per_file, options={"partitionOverwriteMode": "dynamic"}, partition_by=partition_col)
    # a partition that lost its last row is not in what was written
    left = {r[0] for r in written.select(partition_col).distinct().collect()}
    before = {r[0] for r in places.select(partition_col).distinct().collect()}
    for value in before - left:
        drop_path(spark, f"{path.rstrip('/')}/{partition_col}={NULL_PARTITION if value is None else value}")
