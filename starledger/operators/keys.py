"""Deterministic, parallel surrogate keys.

``row_number()`` over a window without ``partitionBy`` moves every row
to one task.  :func:`dense_key` gives the same numbers in parallel:

1. range-partition the rows on the sort order and checkpoint them, so
   every later pass sees the same split (range bounds are sampled);
2. count the rows and bytes of each range: one row per range;
3. running sum of those counts = the offset of each range, a table of one
   row per range, joined by broadcast;
4. key = offset + place of the row in its range.  Ranges are sorted before
   the checkpoint, so the place is the position in the checkpointed
   partition and no second exchange or sort is needed.

The result equals ``row_number() over (order by ...)`` exactly, as long as
the order is total; the remaining columns are appended as tie-breakers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.session import cut_lineage

_RANGE, _PLACE = "_sl_range", "_sl_place"
_PLACE_MASK = (1 << 33) - 1  # monotonically_increasing_id: place within the partition


def _sort_exprs(df: DataFrame, order) -> list[Column]:
    """``order`` items: a column name (ascending, nulls first) or a pair
    ``(name, "desc")`` (descending, nulls last), Spark's defaults."""
    exprs, named = [], []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        c = F.col(f"`{name}`")
        exprs.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first())
        named.append(name)
    # Tie-breakers: every other column, so the order is total.
    exprs += [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in named]
    return exprs


def _width(columns) -> Column:
    return sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in columns), F.lit(8))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows (one pass), to check a broadcast."""
    return df.agg(F.sum(_width(df.columns)).alias("bytes")).first()["bytes"] or 0


def _range_offsets(ranged: DataFrame, columns) -> tuple[list[tuple[int, int]], int]:
    """(range, offset) of each range, and the bytes of all rows.  One row
    per range is all this algorithm brings to the driver."""
    sizes = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("rows"), F.sum(_width(columns)).alias("bytes"))
    offsets, total, size = [], 0, 0
    for r in sorted(sizes.collect(), key=lambda r: r[_RANGE]):
        offsets.append((r[_RANGE], total))
        total += r["rows"]
        size += r["bytes"]
    return offsets, size


def dense_key_sized(df: DataFrame, order, out: str, ranges: int | None = None,
                    key_type: str = "long") -> tuple[DataFrame, int]:
    """:func:`dense_key` plus the measured bytes of the rows it numbered
    (from the per-range pass), so callers can check a broadcast."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    exprs = _sort_exprs(df, order)
    ranged = df.repartitionByRange(n, *exprs).sortWithinPartitions(*exprs).withColumns({
        _RANGE: F.spark_partition_id(), _PLACE: F.monotonically_increasing_id().bitwiseAND(_PLACE_MASK)})
    ranged = cut_lineage(ranged)
    offsets, size = _range_offsets(ranged, df.columns)
    table = spark.createDataFrame(offsets, f"{_RANGE} int, _sl_offset long")
    keyed = ranged.join(F.broadcast(table), _RANGE).withColumn(
        out, (F.col("_sl_offset") + F.col(_PLACE) + 1).cast(key_type))
    return keyed.drop("_sl_offset", _RANGE, _PLACE), size


def dense_key(df: DataFrame, order, out: str, ranges: int | None = None,
              key_type: str = "long") -> DataFrame:
    """Append ``out`` = 1..n following ``order``, computed in parallel."""
    return dense_key_sized(df, order, out, ranges, key_type)[0]
