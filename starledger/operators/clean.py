"""Projection, typing and row cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.scalars import as_col, code_to_key_expr, grouped_int, matches, to_money


def select_present(df: DataFrame, wanted) -> DataFrame:
    """Keep the wanted columns that exist, in wish-list order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in have])


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename to a common vocabulary; absent names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column, e.g. the family name."""
    return df.withColumn(name, F.lit(value))


def cast_money(df: DataFrame, cols, precision: int = 18, scale: int = 2,
               observation=None) -> DataFrame:
    """Money columns to ``decimal(p,s)``; junk text becomes null (P5, Q1).

    With a ``pyspark.sql.Observation`` the number of rows and, per column,
    the values that were present but could not be typed are collected
    while the frame is written: the silent nulls become visible without
    an extra pass over the data."""
    present = [c for c in cols if c in df.columns]
    if observation is not None:
        rejected = [F.count(F.when(F.col(f"`{c}`").isNotNull()
                                   & to_money(F.col(f"`{c}`"), precision, scale).isNull(), F.lit(1)))
                    .alias(f"rejected_{c}") for c in present]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *rejected)
    return df.withColumns({c: to_money(F.col(f"`{c}`"), precision, scale) for c in present})


def parse_grouped_int(df: DataFrame, cols, data_type: str = "int") -> DataFrame:
    """Thousands-separated text to integers."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: grouped_int(F.col(f"`{c}`"), data_type) for c in present})


def cast_cols(df: DataFrame, types: dict) -> DataFrame:
    """Plain ANSI-safe casts ``{column: type}``."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def drop_all_null(df: DataFrame, cols) -> DataFrame:
    """Drop rows where every listed column is null."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return df.dropna(how="all", subset=present)


def require_key(df: DataFrame, cols) -> DataFrame:
    """Drop rows with a null in any key column."""
    return df.dropna(how="any", subset=list(cols) if not isinstance(cols, str) else [cols])


def filter_key_shape(df: DataFrame, key: str, pattern: str) -> DataFrame:
    """Keep keys matching the (partial) regex shape."""
    return df.where(matches(key, pattern))


def code_to_key(df: DataFrame, code: str, mapping: dict, out: str) -> DataFrame:
    """Code -> small integer key by membership, others null."""
    return df.withColumn(out, code_to_key_expr(code, mapping))


def split_by_value(df: DataFrame, column: str, values) -> dict:
    """One filtered frame per value."""
    return {v: df.where(as_col(column) == F.lit(v)) for v in values}


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both frames, in ``a``'s order."""
    other = set(b.columns)
    return [c for c in a.columns if c in other]
