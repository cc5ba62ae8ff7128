"""Rows that the cleaning rules leave out, kept as a table.

The rules are conditions over the typed row, each with a reason code; a row
that breaks one or more goes to ``outcome=reject`` with its reasons and the
raw text of the columns concerned, every other row to ``outcome=silver``.
Both come from one pass and one write, partitioned by outcome, so neither
the source is read twice nor a row can be in both places or in none.

A value that was present but could not be typed does not reject its row,
the row is kept with a null; the column is named in ``untyped`` and its text
is kept, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OUTCOME = "outcome"
SILVER, REJECT = "silver", "reject"
REASONS, UNTYPED, RAW = "reasons", "untyped", "raw"
EXTRA = (REASONS, UNTYPED, RAW)


def route(df: DataFrame, types: dict, rules: dict[str, Column], raw_cols=()) -> DataFrame:
    """``df`` with the columns of ``types`` typed (``try_cast``), and

    * ``reasons``: codes of the ``rules`` (code -> condition over the typed
      row under which it is rejected; null counts as not) that the row
      breaks, in their order; null where there are none,
    * ``untyped``: columns whose text could not be typed, or null,
    * ``raw``: map of column to text for ``types`` and ``raw_cols``, null
      for rows that are clean in both respects,
    * ``outcome``: ``silver`` or ``reject``.

    Every input row gives one row, repeated ones, too."""
    taken = {OUTCOME, *EXTRA} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are made by the routing; rename them")
    types = {c: t for c, t in types.items() if c in df.columns}
    q = lambda c: F.col(f"`{c}`")
    texts = [c for c in dict.fromkeys([*types, *raw_cols]) if c in df.columns]
    names = list(df.columns)
    shadow = {c: f"_text_{i}" for i, c in enumerate(texts)}
    out = df.select(*[q(c) for c in names], *[q(c).cast("string").alias(s) for c, s in shadow.items()])
    out = out.withColumns({c: q(c).try_cast(t) for c, t in types.items()})
    failed = F.array_compact(F.array(*[F.when(q(shadow[c]).isNotNull() & q(c).isNull(), F.lit(c)) for c in types])
                             if types else F.array().cast("array<string>"))
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in rules.items()])
                             if rules else F.array().cast("array<string>"))
    out = out.withColumns({"_failed": failed, "_broken": broken})
    dirty = (F.size("_failed") > 0) | (F.size("_broken") > 0)
    raw = (F.map_from_arrays(F.array(*[F.lit(c) for c in texts]), F.array(*[q(s) for s in shadow.values()]))
           if texts else F.lit(None).cast("map<string,string>"))
    return out.select(*[q(c) for c in names],
                      F.when(F.size("_broken") > 0, F.col("_broken")).alias(REASONS),
                      F.when(F.size("_failed") > 0, F.col("_failed")).alias(UNTYPED),
                      F.when(dirty, raw).alias(RAW),
                      F.when(F.size("_broken") > 0, REJECT).otherwise(SILVER).alias(OUTCOME))


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def silver_of(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The kept rows of a routed table, without the routing's columns; only
    the folder of that outcome is read.  ``schema`` (that of the routed
    frame) is needed where the table may be empty."""
    return _table(spark, path, schema).where(F.col(OUTCOME) == SILVER).drop(OUTCOME, *EXTRA)


def rejects_of(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rejected rows of a routed table with reasons and raw text."""
    return _table(spark, path, schema).where(F.col(OUTCOME) == REJECT).drop(OUTCOME)


def reject_report(spark: SparkSession, path: str) -> DataFrame:
    """(kind, code, n): rows per reason and per untyped column; a row counts
    under each of its reasons."""
    t = spark.read.parquet(path)
    codes = F.concat(F.transform(F.coalesce(REASONS, F.array()), lambda c: F.struct(F.lit("reason").alias("kind"), c.alias("code"))),
                     F.transform(F.coalesce(UNTYPED, F.array()), lambda c: F.struct(F.lit("untyped").alias("kind"), c.alias("code"))))
    return t.select(F.explode(codes).alias("c")).groupBy("c.kind", "c.code").agg(F.count(F.lit(1)).alias("n"))


def check_balance(spark: SparkSession, path: str, schema, seen: int) -> dict[str, int]:
    """Rows per outcome, from the written table; an error unless they add
    up to the ``seen`` input rows."""
    got = {r[0]: r[1] for r in spark.read.schema(schema).parquet(path).groupBy(OUTCOME).count().collect()}
    counts = {o: got.get(o, 0) for o in (SILVER, REJECT)}
    if sum(got.values()) != seen or sum(counts.values()) != seen:
        raise RuntimeError(f"{path}: {seen} rows came in, {got} were written")
    return counts
