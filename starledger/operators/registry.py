"""Surrogate keys that stay the same over loads.

A registry is a Parquet table of (natural columns, key, load), one folder
``load=N`` per load, only ever appended to.  A load looks for natural
keys that the registry does not have (anti join), numbers them in
parallel after the highest key so far (:func:`keys.dense_key`), and adds
them as one more folder.  Old keys never move, so facts written by earlier
loads stay valid and only the partitions a load touches are rewritten.

A load that dies while its folder is written leaves keys that are unique
and after all older ones; the next load keeps them and goes on from
there.  One load runs at a time; a second one that started from the same
state fails on the folder's name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.keys import dense_key
from starledger.session import cut_lineage
from starledger.sources.files import read_if_exists, write_sized

LOAD = "load"
ROWS_PER_FILE = 2_500_000


def _same(a: DataFrame, b: DataFrame, natural):
    return reduce(lambda x, y: x & y, [a[f"`{c}`"].eqNullSafe(b[f"`{c}`"]) for c in natural])


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """All keys given so far, or None before the first load."""
    return read_if_exists(spark, path)


def register_keys(rows: DataFrame, path: str, natural, key: str, order=None, key_type: str = "long") -> DataFrame:
    """Give every distinct natural key of ``rows`` that the registry at
    ``path`` lacks the next keys, in ``order`` (default: the natural
    columns), and return the registry.  Rows with a null in every natural
    column get no key; a null beside other values is a value.  With nothing
    new the registry stays as it is."""
    spark = rows.sparkSession
    natural = [natural] if isinstance(natural, str) else list(natural)
    some = reduce(lambda x, y: x | y, [F.col(f"`{c}`").isNotNull() for c in natural])
    new = rows.select(*[f"`{c}`" for c in natural]).where(some).distinct()
    known = read_registry(spark, path)
    last, load = 0, 1
    if known is not None:
        state = known.agg(F.max(key).alias("k"), F.max(LOAD).alias("n")).first()
        last, load = state["k"] or 0, (state["n"] or 0) + 1
        new = new.join(known, _same(new, known, natural), "left_anti")
    new = cut_lineage(new)
    if new.isEmpty():
        return known if known is not None else new.select(
            F.lit(None).cast(key_type).alias(key), *[f"`{c}`" for c in natural], F.lit(0).alias(LOAD))
    keyed = dense_key(new, order or natural, key).withColumn(key, (F.col(key) + F.lit(last)).cast(key_type))
    write_sized(keyed.select(key, *[f"`{c}`" for c in natural]), f"{path}/{LOAD}={load}", ROWS_PER_FILE, mode="errorifexists")
    return read_registry(spark, path)


def rekey(fact: DataFrame, registry: DataFrame, natural, key: str, how: str = "inner") -> DataFrame:
    """``fact`` with its natural columns replaced by ``key``.  The registry
    is joined without a hint: AQE broadcasts it while its measured size is
    small and splits skewed fact partitions otherwise.  ``how="left"`` keeps
    rows without a key."""
    natural = [natural] if isinstance(natural, str) else list(natural)
    found = registry.select(key, *[f"`{c}`" for c in natural])
    joined = fact.join(found, _same(fact, found, natural), how)
    return joined.select(*[fact[f"`{c}`"] for c in fact.columns if c not in natural], found[key])


def load_fact(fact: DataFrame, path: str, registries: dict, partition_col: str, rows_per_file: int = ROWS_PER_FILE,
              how: str = "inner") -> None:
    """Re-key the rows of one load and replace the partitions they touch;
    all others stay as files.  ``registries``: key column to (registry path,
    natural columns); each is extended first."""
    for key, (where, natural) in registries.items():
        fact = rekey(fact, register_keys(fact, where, natural, key), natural, key, how)
    write_sized(fact, path, rows_per_file, partition_by=partition_col, options={"partitionOverwriteMode": "dynamic"})
