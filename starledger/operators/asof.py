"""Dimensions with validity intervals and lookups as of a day.

A natural dimension keeps every (code, name) pair it ever saw, so a code
with two names multiplies fact rows.  Here each name is valid from the
first day it was seen until the day before the next one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"


def validity_dim(rows: DataFrame, key: str, attrs, date: str) -> DataFrame:
    """``key``, ``attrs``, ``valid_from``, ``valid_to`` (the first day after;
    null for the last interval of a key): one row per run of days in which
    the key was seen with the same ``attrs`` and no other in between.

    Of several ``attrs`` on one day the greatest in column order holds, nulls
    being smallest.  Rows without key or day are left out.  A key that comes
    back to an old name gets a new interval.  Rows are reduced to one per key
    and day first (partial aggregation), so the window over a key sees at
    most as many rows as there are days, however often the key occurs."""
    attrs = [attrs] if isinstance(attrs, str) else list(attrs)
    q = lambda c: F.col(f"`{c}`")
    days = rows.where(q(key).isNotNull() & q(date).isNotNull()).groupBy(q(key).alias("_k"), q(date).cast("date").alias("_d")).agg(
        F.max(F.struct(*[q(a).alias(f"a{i}") for i, a in enumerate(attrs)])).alias("_a"))
    by_day = Window.partitionBy("_k").orderBy("_d")
    changed = (F.row_number().over(by_day) == 1) | ~F.col("_a").eqNullSafe(F.lag("_a").over(by_day))
    starts = days.withColumn("_new", changed).where("_new")
    return starts.select(F.col("_k").alias(key), *[F.col(f"_a.a{i}").alias(a) for i, a in enumerate(attrs)],
                         F.col("_d").alias(FROM), F.lead("_d").over(by_day).alias(TO))


def lookup_as_of(fact: DataFrame, dim: DataFrame, key: str, date: str, dim_key: str | None = None,
                 out: dict | None = None) -> DataFrame:
    """``fact`` with the columns ``out`` (dimension column -> name; default
    all but key and interval) of the interval of its key that holds its day;
    null without one, or without key or day.  Every fact row stays once.

    ``dim``: intervals that don't overlap within a key, as
    :func:`validity_dim` makes them.  The join is on (key, year) with the
    days as a remaining condition: an interval is laid out over the years it
    has in common with the fact (its first and last day, two values on the
    driver), so a fact row meets only the intervals of its own year, not all
    of its key.  No hint is given; AQE broadcasts a dimension from its
    measured size and splits skewed partitions of a larger one."""
    dim_key = dim_key or key
    out = out if out is not None else {c: c for c in dim.columns if c not in (dim_key, FROM, TO)}
    clash = set(out.values()) & set(fact.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in the fact already; name others in out")
    day = fact[f"`{date}`"].cast("date")
    span = fact.agg(F.year(F.min(day)).alias("lo"), F.year(F.max(day)).alias("hi")).first()
    lo, hi = F.lit(span["lo"]).cast("int"), F.lit(span["hi"]).cast("int")
    first = F.greatest(F.year(FROM), lo)
    last = F.least(F.coalesce(F.year(F.date_sub(TO, 1)), hi), hi)
    laid = dim.where(first <= last).select(
        F.col(f"`{dim_key}`").alias("_k"), F.col(FROM).alias("_from"), F.col(TO).alias("_to"),
        *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(out)], F.explode(F.sequence(first, last)).alias("_year"))
    holds = (day >= laid["_from"]) & (laid["_to"].isNull() | (day < laid["_to"]))
    joined = fact.join(laid, (fact[f"`{key}`"] == laid["_k"]) & (F.year(day) == laid["_year"]) & holds, "left")
    return joined.select(*[fact[f"`{c}`"] for c in fact.columns],
                         *[laid[f"_o{i}"].alias(name) for i, name in enumerate(out.values())])
