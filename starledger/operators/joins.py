"""Lookups and enrichment joins.

Broadcast policy: a side is broadcast explicitly only after a check of
its measured bytes.  Otherwise no hint is given and adaptive execution
decides at run time from the *measured* size of the shuffled side
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), falling back to a
sort-merge join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.scalars import date_key
from starledger.session import store
from starledger.sources.schemas import BROADCAST_MAX_BYTES


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def lookup_key(fact: DataFrame, dim: DataFrame, on, key: str | None = None,
               how: str = "left", drop_natural: bool = True, out: str | None = None,
               small: bool = False) -> DataFrame:
    """Replace a natural key by the dimension's surrogate key.

    ``on``: a name / list of names shared by both sides, or a mapping
    ``{fact_col: dim_col}``.  ``how="left"`` keeps every fact row (the
    row count never changes when the dimension is unique on ``on``).
    ``small``: the caller has checked the dimension's bytes; broadcast it."""
    pairs = ({c: c for c in ([on] if isinstance(on, str) else on)}
             if not isinstance(on, dict) else dict(on))
    keep = [key] if key else [c for c in dim.columns if c not in pairs.values()]
    right = dim.select(*[_q(d).alias(f"_k{i}") for i, d in enumerate(pairs.values())],
                       *[_q(k).alias(out if (out and k == key) else k) for k in keep])
    right = F.broadcast(right) if small else right
    cond = [fact[f"`{f}`"] == right[f"_k{i}"] for i, f in enumerate(pairs)]
    joined = fact.join(right, cond, how).drop(*[f"_k{i}" for i in range(len(pairs))])
    return joined.drop(*pairs.keys()) if drop_natural else joined


def _one_code(dim: DataFrame, dim_on: str, dim_key: str, unique: bool) -> DataFrame:
    """(dim_on, dim_key) with one row per value: the largest key where a
    value repeats.  ``unique``: the dimension is known to have one row per
    value (it was made by a distinct on that column)."""
    pair = dim.select(_q(dim_on).alias("_v"), _q(dim_key).alias("_code"))
    return pair if unique else pair.groupBy("_v").agg(F.max("_code").alias("_code"))


def lookup_roles(fact: DataFrame, dim: DataFrame, roles: dict, dim_on: str, dim_key: str,
                 how: str = "left", drop_natural: bool = True, unique: bool = False,
                 dim_bytes: int | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Role-playing lookup: one dimension used for several fact columns
    (J3, J4, J5).  ``roles = {fact_col: output_key_col}``.

    One join per role; a dimension whose values repeat gives its largest
    key, so a lookup never multiplies fact rows.  With ``dim_bytes`` (the
    measured size, e.g. from :func:`dense_key_sized`) of at most
    ``max_bytes`` the dimension is broadcast; otherwise AQE plans the
    joins.  The size changes the plan, never the result;
    :func:`lookup_roles_unpivot` gives the same rows with one narrow join
    for all roles, for a dimension known to be large."""
    right = _one_code(dim, dim_on, dim_key, unique)
    right = F.broadcast(right) if dim_bytes is not None and dim_bytes <= max_bytes else right
    out = fact
    for fact_col, out_col in roles.items():
        r = right.select(F.col("_v").alias("_rk"), F.col("_code").alias(out_col))
        out = out.join(r, out[f"`{fact_col}`"] == r["_rk"], how).drop("_rk")
        if drop_natural:
            out = out.drop(fact_col)
    return out


def lookup_roles_unpivot(fact: DataFrame, dim: DataFrame, roles: dict, row_key,
                         dim_on: str, dim_key: str, drop_natural: bool = True,
                         unique: bool = False) -> DataFrame:
    """Left role-playing lookup for a *large* dimension (J5 at scale): the
    same rows as :func:`lookup_roles`.

    Instead of one fact-sized join per role, the narrow (row, role, value)
    triples are joined once and regrouped, then attached to the fact with
    one join.  The fact is computed once and stored with a number per row:
    8 bytes tell the rows apart in every shuffle, exactly and evenly
    spread, also where ``row_key``, the fact's own key, repeats or is
    null."""
    missing = [c for c in ([row_key] if isinstance(row_key, str) else row_key) if c not in fact.columns]
    if missing:
        raise ValueError(f"the fact lacks its key columns {missing}")
    names = list(roles)
    fact = store(fact.withColumn("_row", F.monotonically_increasing_id()), "unpivot-fact")
    triples = fact.select("_row", F.explode(F.array(*[
        F.struct(F.lit(i).alias("_role"), _q(c).alias("_v")) for i, c in enumerate(names)
    ])).alias("_t")).select("_row", "_t._role", "_t._v").where(F.col("_v").isNotNull())
    coded = triples.join(_one_code(dim, dim_on, dim_key, unique), "_v")
    wide = coded.groupBy("_row").agg(*[
        F.max(F.when(F.col("_role") == i, F.col("_code"))).alias(roles[c]) for i, c in enumerate(names)
    ])
    kept = fact.drop(*names) if drop_natural else fact      # before the join: not shuffled
    return kept.join(wide, "_row", "left").drop("_row")


def date_key_roles(fact: DataFrame, roles: dict, begin=None, end=None,
                   drop_natural: bool = True) -> DataFrame:
    """Role-playing *date* lookup without a join (J3 at scale).

    The calendar key is a function of the date, so a left join to the
    calendar equals computing ``yyyymmdd`` when the date lies inside the
    calendar span (``begin``/``end``: literals or Columns) and null
    outside it.  No shuffle, no broadcast."""
    cols = {}
    for date_col, key_col in roles.items():
        d = _q(date_col)
        inside = d.isNotNull()
        if begin is not None:
            inside = inside & (d >= (begin if isinstance(begin, Column) else F.to_date(F.lit(begin))))
        if end is not None:
            inside = inside & (d <= (end if isinstance(end, Column) else F.to_date(F.lit(end))))
        cols[key_col] = F.when(inside, date_key(d))
    out = fact.withColumns(cols)
    return out.drop(*roles.keys()) if drop_natural else out


def enrich(dim: DataFrame, sources, how: str = "inner") -> DataFrame:
    """Attach external attributes (J6, J7, J8).  ``sources``: list of
    ``(frame, dim_col, source_col)``; the source key is dropped after the
    join.  ``how="inner"`` drops dimension rows a source lacks (Q17)."""
    out = dim
    for frame, left, right in sources:
        if left == right:
            out = out.join(frame, on=left, how=how)
        else:
            out = out.join(frame, out[f"`{left}`"] == frame[f"`{right}`"], how).drop(frame[f"`{right}`"])
    return out


def resolve_code_by_name(df: DataFrame, ref: DataFrame, pairs: dict, how: str = "inner") -> DataFrame:
    """Obtain a code by joining on several *name* columns with different
    column names (J9).  ``pairs = {df_col: ref_col}``."""
    cond = reduce(lambda a, b: a & b, [df[f"`{l}`"] == ref[f"`{r}`"] for l, r in pairs.items()])
    return ref.join(df, cond, how)


def merge_vintages(frames, on, how: str = "inner") -> DataFrame:
    """Join several vintages of one table on shared keys."""
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda a, b: a.join(b, on, how), frames)


def outer_merge(frames, on) -> DataFrame:
    """Chained full outer ``USING`` join."""
    return merge_vintages(frames, on, how="full")


def semi_filter(df: DataFrame, allowed: DataFrame, on: dict) -> DataFrame:
    """Keep rows whose key appears in ``allowed`` (J14, as ``left_semi``)."""
    cond = reduce(lambda a, b: a & b, [df[f"`{l}`"] == allowed[f"`{r}`"] for l, r in on.items()])
    return df.join(allowed, cond, "left_semi")
