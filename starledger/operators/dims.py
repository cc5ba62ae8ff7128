"""Dimension builders."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.scalars import (
    code_to_key_expr, date_key, fiscal_month, fiscal_year, yes_no,
)
from starledger.operators.keys import dense_key_sized
from starledger.operators.registry import LOAD, register_keys
from starledger.sources.schemas import BROADCAST_MAX_BYTES, FISCAL_START_MONTH


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def build_dim(df: DataFrame, cols, null_rule: str | list = "any", names=None,
              unique_code: bool = False) -> DataFrame:
    """Natural-key dimension: project, drop nulls, distinct.

    ``null_rule``: "any" / "all" or the list of columns that must be
    non-null.  Nulls are dropped before the distinct so less is shuffled.
    ``unique_code=True`` keeps one row per code (the smallest name),
    so a code with two spellings cannot multiply fact rows (Q22)."""
    names = list(names or cols)
    dim = df.select(*[_q(c).alias(n) for c, n in zip(cols, names)])
    dim = _drop_nulls(dim, null_rule)
    if unique_code and len(names) > 1:
        return dim.groupBy(names[0]).agg(*[F.min(n).alias(n) for n in names[1:]])
    return dim.distinct()


def _drop_nulls(df: DataFrame, null_rule, among=None) -> DataFrame:
    if null_rule in ("any", "all"):
        return df.dropna(how=null_rule, subset=list(among) if among else None)
    if null_rule:
        return df.dropna(how="any", subset=list(null_rule))
    return df


def build_role_dim(df: DataFrame, roles, out, null_rule: str | list = "any",
                   role_tag: str | None = None, role_names=None) -> DataFrame:
    """Dimension whose rows come from several column groups ("roles")
    of one frame, e.g. awarding and funding agency (D2, D3, U2, U3).

    One scan: every row emits one struct per role (``explode`` of an
    array), then nulls are dropped and duplicates removed.  Equals the
    union of per-role projections followed by ``distinct``.  With
    ``role_tag`` the role name is kept as a column (and is part of the
    distinct), e.g. to mark which code system a state code uses (Q4)."""
    out = list(out)
    structs = []
    for i, role in enumerate(roles):
        fields = [_q(c).alias(o) for c, o in zip(role, out)]
        if role_tag:
            fields.append(F.lit(role_names[i] if role_names else str(i)).alias(role_tag))
        structs.append(F.struct(*fields))
    exploded = df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
    return _drop_nulls(exploded, null_rule, among=out).distinct()


def keyed_natural(base: DataFrame, order, key: str, key_type: str = "long",
                  registry: str | None = None) -> tuple[DataFrame, float]:
    """Distinct natural keys with their surrogate key, and their measured
    bytes: numbered densely, or, with ``registry``, all keys ever given
    (bytes unknown, so infinite: their joins get no broadcast hint)."""
    if registry is None:
        return dense_key_sized(base, order, key, key_type=key_type)
    return register_keys(base, registry, base.columns, key, order, key_type).drop(LOAD), math.inf


def extract_dim(fact: DataFrame, natural, key: str, order=None, null_rule="any",
                how: str = "inner", key_type: str = "int", names=None,
                max_bytes: int = BROADCAST_MAX_BYTES, registry: str | None = None):
    """Dense-key dimension plus re-keyed fact.

    With ``registry`` (a path) keys come from the key registry there: keys
    of earlier loads stay, new natural keys follow them.

    Returns ``(dim, fact)``: the dimension has ``key`` first, then the
    natural columns (renamed to ``names`` if given); the fact has the
    natural columns replaced by ``key``.  ``how="inner"`` drops fact rows
    whose natural key is absent from the dimension (also rows with a null
    part, since equality never matches null), ``"left"`` keeps them with
    a null key (Q11).

    The keyed dimension's bytes are measured with its keys; up to
    ``max_bytes`` it is broadcast and the fact is re-keyed map-side
    without a shuffle, otherwise a shuffle join is left to AQE (which
    splits skewed fact partitions)."""
    natural = [natural] if isinstance(natural, str) else list(natural)
    base = fact.select(*[_q(c) for c in natural])
    base = _drop_nulls(base, null_rule).distinct()
    keyed, size = keyed_natural(base, order or natural, key, key_type, registry)
    rekeyed = fact.join(F.broadcast(keyed) if size <= max_bytes else keyed, on=natural, how=how).drop(*natural)
    names = list(names or natural)
    dim = keyed.select(_q(key), *[_q(c).alias(n) for c, n in zip(natural, names)])
    return dim, rekeyed


def code_dim(fact: DataFrame, code: str, name: str, mapping: dict, key: str,
             code_out: str | None = None, name_out: str | None = None):
    """Mapped-key dimension (D5): ``key`` from the code by membership;
    the dimension is the distinct (key, code, name) with a key.
    Returns ``(dim, fact_with_key)``."""
    keyed = fact.withColumn(key, code_to_key_expr(code, mapping))
    dim = (keyed.where(F.col(key).isNotNull())
           .select(key, _q(code).alias(code_out or code), _q(name).alias(name_out or name))
           .distinct())
    return dim, keyed


def calendar_columns(d: Column, fy_start: int = FISCAL_START_MONTH) -> list[Column]:
    """The 14 calendar attributes of a date."""
    return [
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("calendar_year"),
        F.date_format(d, "MMMM").alias("calendar_month"),
        F.month(d).alias("month_of_year"),
        F.date_format(d, "EEEE").alias("calendar_day"),
        F.dayofweek(d).alias("day_of_week"),
        yes_no(F.weekday(d) < 5).alias("is_weekday"),
        F.dayofmonth(d).alias("day_of_month"),
        yes_no(d == F.last_day(d)).alias("last_day_of_month"),
        F.weekofyear(d).alias("week_of_year_iso"),
        F.quarter(d).alias("quarter_of_year"),
        fiscal_year(d, fy_start).alias("fiscal_year"),
        fiscal_month(d, fy_start).alias("fiscal_month"),
    ]


def calendar_from_bounds(bounds: DataFrame, begin: str = "begin", end: str = "end",
                         fy_start: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar for every (begin, end) row of ``bounds`` (D7).  Its size is
    the number of days in the span, independent of the fact size."""
    # one row per year first, dealt out by year, so that a long span (one
    # stray date is enough) is not one array in one task
    years = bounds.select(begin, end, F.explode(F.sequence(F.year(begin), F.year(end))).alias("_y")).repartition("_y")
    first = F.greatest(F.col(begin), F.make_date("_y", F.lit(1), F.lit(1)))
    last = F.least(F.col(end), F.make_date("_y", F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("_d"))
    return days.select(*calendar_columns(F.col("_d"), fy_start))


def calendar_dim(spark: SparkSession, begin: str, end: str,
                 fy_start: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar between two literal dates."""
    bounds = spark.range(1).select(F.to_date(F.lit(begin)).alias("begin"),
                                   F.to_date(F.lit(end)).alias("end"))
    return calendar_from_bounds(bounds, fy_start=fy_start)


def fiscal_bounds(df: DataFrame, date_cols, fy_start: int = FISCAL_START_MONTH) -> DataFrame:
    """One row (begin, end): whole fiscal years covering every date in
    ``date_cols`` (one aggregation pass, no driver round trip)."""
    lo = F.array_min(F.array(*[F.min(_q(c)) for c in date_cols]))
    hi = F.array_max(F.array(*[F.max(_q(c)) for c in date_cols]))
    span = df.agg(lo.alias("lo"), hi.alias("hi"))
    first_fy = fiscal_year(F.col("lo"), fy_start)
    last_fy = fiscal_year(F.col("hi"), fy_start)
    if fy_start == 1:
        begin = F.make_date(first_fy, F.lit(1), F.lit(1))
    else:
        begin = F.make_date(first_fy - 1, F.lit(fy_start), F.lit(1))
    end = F.date_sub(F.make_date(last_fy if fy_start != 1 else last_fy + 1, F.lit(fy_start), F.lit(1)), 1)
    return span.select(begin.alias("begin"), end.alias("end"))


def calendar_for(df: DataFrame, date_cols, fy_start: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar spanning the fiscal years the data touches."""
    return calendar_from_bounds(fiscal_bounds(df, date_cols, fy_start), fy_start=fy_start)


def conform_union(a: DataFrame, b: DataFrame, columns=None) -> DataFrame:
    """Union of two families on their shared columns, in ``a``'s order
    (D10, U1, P19).  Where types differ, ``b`` is cast to ``a``'s type, so
    the result never silently widens to string or double (Q10)."""
    from starledger.operators.clean import shared_columns
    cols = list(columns or shared_columns(a, b))
    types_a = dict(a.dtypes)
    types_b = dict(b.dtypes)
    left = a.select(*[_q(c) for c in cols])
    right = b.select(*[(_q(c) if types_a[c] == types_b[c] else _q(c).try_cast(types_a[c])).alias(c)
                       for c in cols])
    return left.unionByName(right)
