"""Interaction audit of document filters, over all orders of applying them.

*Documents.*  One scan evaluates the conditions of every document; what a
document does under any order depends only on the set of filters that it
fails (its mask) and its labels.  Counts per (part, mask) are all that
later steps need, so nothing after the scan grows with the documents.

*Copies.*  A document fails the copy filter if a row with a smaller id has
the same text.  Rows are counted by (text digest, part, labels, mask) with
the smallest id of each group, so a text that a third of all rows share
is summed up before any shuffle; no row list of a group is ever held.

*Lattice.*  Filters applied so far form a subset; applying one more is an
edge.  Forward path counts (orders that reach a subset) and backward path
counts (orders that leave it) are summed along the edges of the lattice,
2 ** k subsets of k filters.  What an edge removes from a part is one sum
over its masks, weighted by forward times backward count for the Shapley
column; every step of every order is read from the same edges.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import SPACE, text_of

MAX_FILTERS = 6     # 6! * 6 steps and 2 ** 6 * 6 edges: the tables of the lattice stay small


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on one text: few words (A), few distinct words
    (B), many capitals (C), signs of markup (D)."""
    words = F.array_remove(F.split(text, f"{SPACE}+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], copies: str | None = "E",
                  part: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, bit
    i for the i-th filter, with how many of them have a label row of
    quality 1 and of toxic 1.

    ``filters`` are conditions over ``docs`` (null: not failed); ``copies``
    names one more filter, failed by a row whose text a row of smaller id
    has, too.  Null text is empty, a null part the empty string.  A null id
    is neither smaller nor larger than any; rows that repeat an id and a
    text don't fail for each other."""
    part = F.lit("") if part is None else F.coalesce(part.cast("string"), F.lit(""))
    mask = F.lit(0)
    for bit, condition in enumerate(filters.values()):
        mask = mask + F.when(F.coalesce(condition, F.lit(False)), 1 << bit).otherwise(0)
    digest = F.sha2(text_of(docs, text_col).cast("binary"), 256)
    rows = docs.select(docs[id_col].alias("id"), part.alias("part"), mask.cast("int").alias("mask"),
                       F.unhex(digest).alias("digest"))
    is_one = lambda c: F.max(F.coalesce(labels[c].try_cast("int") == 1, F.lit(False)).cast("int"))
    taught = labels.groupBy(labels[id_col].alias("id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rows = rows.join(taught, "id", "left").select("id", "part", "mask", "digest", zero("good"), zero("toxic"))
    kinds = ["digest", "part", "mask", "good", "toxic"]
    # One row per (id, kind), then per kind the smallest id and the rows that have it: partial sums before each shuffle.
    ids = rows.groupBy("id", *kinds).agg(F.count(F.lit(1)).alias("n"))
    groups = ids.groupBy(*kinds).agg(
        F.sum("n").alias("n"), F.min("id").alias("least"),
        F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"))
    if copies is None:
        counted = groups.select("part", "mask", "n", "good", "toxic")
    else:
        first = groups.groupBy("digest").agg(F.min("least").alias("first"))
        kept = F.col("no_id") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
        both = groups.join(first, "digest").select("part", "mask", "good", "toxic", "n", kept.alias("kept"))
        counted = both.select("part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("mask"), F.col("kept").alias("n")),
            F.struct((F.col("mask") + (1 << len(filters))).cast("int").alias("mask"), (F.col("n") - F.col("kept")).alias("n")))))
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For every subset of ``k`` filters, as bits: the number of ways to
    reach it from the empty set and to go on from it to the full set, one
    filter at a time.  Summed along edges, forward and backward."""
    full = (1 << k) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):
        for bit in (b for b in range(k) if not state >> b & 1):
            reach[state | 1 << bit] += reach[state]
    for state in range(full, -1, -1):
        for bit in (b for b in range(k) if not state >> b & 1):
            leave[state] += leave[state | 1 << bit]
    return reach, leave


def edge_counts(masks: DataFrame, k: int) -> DataFrame:
    """Per part and lattice edge (``state``, ``bit``): documents kept after
    it, removed by it, failing its filter but removed before, failing its
    filter alone, the labelled ones among the removed, and the number of
    orders that pass the edge (``orders``).  Edges that remove nothing are
    there, too."""
    spark = masks.sparkSession
    reach, leave = path_counts(k)
    # (edge, mask): what documents of that mask are at that edge; 2 ** k * 2 ** (k - 1) * k rows at most
    roles = [(state, bit, mask, reach[state] * leave[state | 1 << bit],
              not mask & (state | 1 << bit), bool(mask >> bit & 1 and not mask & state),
              bool(mask >> bit & 1 and mask & state), mask == 1 << bit)
             for state in range(1 << k) for bit in range(k) if not state >> bit & 1 for mask in range(1 << k)]
    table = spark.createDataFrame(roles, "state int, bit int, mask int, orders long, stays boolean, goes boolean, "
                                         "went boolean, alone boolean")
    of = lambda role, what: F.sum(F.when(F.col(role), F.col(what)).otherwise(0))
    return masks.join(F.broadcast(table), "mask").groupBy("part", "state", "bit", "orders").agg(
        of("stays", "n").alias("kept"), of("goes", "n").alias("removed"), of("went", "n").alias("redundant"),
        of("alone", "n").alias("unique_fails"), of("goes", "good").alias("good_lost"),
        of("goes", "toxic").alias("toxic_lost"))


def audit_filters(masks: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters (a permutation of
    ``letters``) and step, zeros included, from :func:`failure_masks`.  An
    empty table has no parts and no rows."""
    k = len(letters)
    if not 1 <= k <= MAX_FILTERS or len(set(letters)) < k:
        raise ValueError(f"one to {MAX_FILTERS} distinct letters are needed")
    edges = edge_counts(masks, k)
    shapley = edges.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        state, name = 0, "".join(letters[b] for b in order)
        for step, bit in enumerate(order, 1):
            steps.append((name, step, state, bit))
            state |= 1 << bit
    steps = masks.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    return (edges.join(F.broadcast(steps), ["state", "bit"]).join(shapley, ["part", "bit"])
            .select("part", "filter_order", "step",
                    *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails",
                                                               "good_lost", "toxic_lost", "shapley")]))
