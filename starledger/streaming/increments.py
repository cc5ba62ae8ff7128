"""Incremental ingest of newly landed award files (E2 as a stream).

The yearly job is "files for a new fiscal year appear -> clean them ->
merge into silver".  A file-source stream expresses exactly that: the
source's checkpoint remembers which files were processed, an
``availableNow`` trigger processes whatever is new and stops (so it can
be scheduled like the batch job), and each micro-batch is read, cleaned
and merged with the staged, per-fiscal-year merge.  The stream itself only
carries the paths of new files (their bytes are not read by it); a batch's
files are then read with their headers reconciled, so files whose columns
differ or are in another order land right.  Every batch, the first
included, is merged as a full-row distinct, so replaying one after a
failure, or another split of the files into batches, gives the same
silver.  The checkpoint lies next to the target table, so each target
keeps its own list of files, across applications.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starledger.operators.merge import merge_increment_to
from starledger.plans.jobs.bronze import FISCAL_YEAR, bronze_to_silver
from starledger.sources.reconcile import literal_path, read_csv_reconciled
from starledger.sources.schemas import FAMILIES

#: Schema of the file source that lists files; only ``path`` is selected.
FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(spark: SparkSession, landing: str, silver: str, family: str,
                     checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Process every not-yet-seen file under ``landing/family`` into
    ``silver/family`` and return when done."""
    spec = FAMILIES[family]
    source = f"{landing.rstrip('/')}/{family}"
    target = f"{silver.rstrip('/')}/{family}"
    checkpoint = checkpoint or f"{silver.rstrip('/')}/_checkpoints/{family}"
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source).select("path")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(literal_path(r["path"]) for r in batch.collect())  # the paths of one batch
        raw = read_csv_reconciled(batch.sparkSession, files) if files else None
        if raw is not None and raw.columns:
            merge_increment_to(batch.sparkSession, target, bronze_to_silver(raw, spec), partition_col=FISCAL_YEAR,
                               rows_per_file=spec.rows_per_file, dedupe_first=True)

    query = (stream.writeStream.foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
