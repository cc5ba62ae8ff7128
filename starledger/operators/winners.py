"""Winners, first rows and pivots.

Hot groups: aggregations are partial, and the rank form keeps only
candidates for rank 1 before its shuffle (Spark plans a partial group
limit under ``rank() = 1``), so no task sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def top_per_group(df: DataFrame, by, value: str, descending: bool = True) -> DataFrame:
    """Rows holding the group's best ``value``, ties kept.

    ``rank() over (partition by by order by value) = 1``, nulls last: null
    groups form one group, and a group whose values are all null keeps all
    its rows.  One scan, and no equality test on ``value``."""
    by = [by] if isinstance(by, str) else list(by)
    best = _q(value).desc_nulls_last() if descending else _q(value).asc_nulls_last()
    place = Window.partitionBy(*[_q(b) for b in by]).orderBy(best)
    return df.withColumn("_rank", F.rank().over(place)).where("_rank = 1").drop("_rank")


def first_per_group(df: DataFrame, by, order, ascending: bool = True, columns=None) -> DataFrame:
    """One row per group: the first by ``order``.

    Equals ``row_number() over (partition by by order by order) = 1`` when
    ``order`` is total within the group (add a unique key as the last
    order column).  Computed as ``min(struct(order..., payload...))``, a
    partial aggregate, so a hot group is reduced map-side."""
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    wanted = [c for c in (columns or df.columns) if c not in by]
    # each column once: payload columns that are part of the order come from it
    packed = order + [c for c in wanted if c not in order]
    pick = F.min if ascending else F.max
    best = df.groupBy(*by).agg(pick(F.struct(*[_q(c).alias(f"_f{i}") for i, c in enumerate(packed)])).alias("_w"))
    return best.select(*by, *[F.col(f"_w._f{packed.index(c)}").alias(c) for c in wanted])


def argmax_rows(df: DataFrame, group, value: str, join_on=None) -> DataFrame:
    """Join the group maximum back to the detail rows.

    ``join_on`` (default: ``group``) are the keys used to find the detail
    rows again; all rows equal to the maximum are returned (ties kept)."""
    group = list(group)
    keys = list(join_on or group)
    best = df.groupBy(*group).agg(F.max(_q(value)).alias(value)).select(*keys, value)
    return best.join(df.drop(*[c for c in group if c not in keys]), keys + [value])


def pivot_first(df: DataFrame, by, pivot_col: str, values, value_col: str,
                names: dict | None = None, ties: str | None = None) -> DataFrame:
    """Pivot ``values`` of ``pivot_col`` to columns (A5).

    With several candidates per cell the smallest value is taken, which
    is deterministic (Q8); ``ties`` names an optional column counting the
    distinct candidates of the cells so ties stay visible."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.min(_q(value_col)).alias("v")]
    if ties:
        aggs.append(F.count_distinct(_q(value_col)).alias("n"))
    wide = df.groupBy(*by).pivot(pivot_col, list(values)).agg(*aggs)
    out = []
    for v in values:
        name = (names or {}).get(v, str(v))
        if ties:
            out += [F.col(f"`{v}_v`").alias(name), F.col(f"`{v}_n`").alias(f"{name}_{ties}")]
        else:
            out.append(F.col(f"`{v}`").alias(name))
    return wide.select(*by, *out)
