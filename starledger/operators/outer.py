"""Full outer merge that no hot key can hold up.

A full outer join sends all rows of a key to one task, and AQE cannot
split it there.  Here keys with more than a given share of a side's rows
are taken out: as many as fit into that share twice over, so their table
is small whatever the input.  All other keys meet in a plain full outer
join.  A hot key of one side only needs no join; one of both sides is
joined in cells, each of which holds about one share of either side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.005   # at most 2 / HOT_SHARE keys are hot


def _sizes(df: DataFrame, on: list[str], name: str) -> DataFrame:
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return df.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias(name))


def _hot_keys(left: DataFrame, right: DataFrame, on: list[str], share: float) -> DataFrame:
    """(on, _l, _r): the cells that a hot key's rows are dealt to on each
    side; null where the side has none of them."""
    sizes = _sizes(left, on, "_ln").join(_sizes(right, on, "_rn"), on, "full")
    total = sizes.agg(F.sum("_ln"), F.sum("_rn")).first()
    least = [max(1.0, share * (n or 0)) for n in total]
    cells = [F.ceil(F.col(c) / F.lit(n)).cast("int") for c, n in zip(("_ln", "_rn"), least)]
    return (sizes.where((F.col("_ln") > least[0]) | (F.col("_rn") > least[1]))
            .select(*on, cells[0].alias("_l"), cells[1].alias("_r")))


def _dealt(rows: DataFrame, own: str, other: str, times: str) -> DataFrame:
    """Equal rows once with their number, in one cell of the own side (by a
    hash, so a repeated task deals alike) and all cells of the other's."""
    keep = [c for c in rows.columns if c not in ("_l", "_r")]
    once = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(times))
    return (once.withColumn("_" + own, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in keep]), F.col(own)))
            .withColumn("_" + other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other).cast("long") - 1)))
            .drop("_l", "_r"))


def outer_merge_hot(left: DataFrame, right: DataFrame, on, share: float = HOT_SHARE) -> DataFrame:
    """The rows of ``left.join(right, on, "full")``, ties multiplied and null
    keys unmatched as there; columns: ``on``, then left's, then right's.
    Besides ``on`` the sides share no column name."""
    on = [on] if isinstance(on, str) else list(on)
    columns = on + [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
    hot = F.broadcast(_hot_keys(left, right, on, share))   # at most 2 / share keys
    cold = left.join(hot, on, "left_anti").join(right.join(hot, on, "left_anti"), on, "full")
    l_hot, r_hot = left.join(hot, on), right.join(hot, on)
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    cells = (_dealt(l_hot.where(both), "_l", "_r", "_lt")
             .join(_dealt(r_hot.where(both), "_r", "_l", "_rt"), [*on, "__l", "__r"])
             .withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_lt") * F.col("_rt")))))
    out = cold.select(columns).unionByName(cells.select(columns))
    for side, lacks in ((l_hot, "_r"), (r_hot, "_l")):
        out = out.unionByName(side.where(F.col(lacks).isNull()).drop("_l", "_r"), allowMissingColumns=True)
    return out
