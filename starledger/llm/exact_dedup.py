"""Exact duplicate removal by progressive refinement.

Two texts are equal when they are identical after each run of ASCII
white space became one space.  Rows are told apart in three steps, each
looking only at what the step before left together:

1. by normalised length,
2. by a hash of the first ``prefix_chars`` characters,
3. by the SHA-256 of the whole normalised text.

The first pass groups (length, prefix hash) with partial aggregation and
shuffles two numbers per distinct pair.  Pairs seen once are settled: a
length that occurs once has no pair that occurs twice, so the length step
is part of the same aggregate.  What is left is counted and turned into a
bitmap of 16 bits per pair, up to a fixed size, which is broadcast; the
second pass reads the documents with that bitmap and computes the full
hash of surviving rows only.  A collision in the bitmap costs one needless
hash, never a wrong answer.  Texts are never shuffled; rows of a group
meet only as (id, hash) in partial aggregates, settled rows not at all.

Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import BITMAP_BITS, SPACE, pick_rows, shared_table, text_of, with_bitmap

PREFIX_CHARS = 256


def normalised(df: DataFrame, text_col: str):
    """Each run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(text_of(df, text_col), SPACE + "+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False,
                prefix_chars: int = PREFIX_CHARS, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``
    (rows with the equal text), ``kept``, ``text_sha256``.

    * ``text_sha256`` is null for rows settled before the full hash,
      unless ``digest_all`` asks for the digest of every row.
    * Null text equals the empty text.  The smallest id stays; null ids
      sort last (``keep_id`` is null only if all ids of a group are null).
    * Of repeated rows that share the smallest id exactly one is kept.
    * Extra columns are ignored; an empty table gives an empty result.
    """
    return _decided(docs, id_col, text_col, digest_all, prefix_chars, bitmap_bits).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def _decided(docs: DataFrame, id_col: str, text_col: str, digest_all: bool, prefix_chars: int, bitmap_bits: int,
             raw: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept, sha) of every row; with ``raw`` also
    a hash of the text as it stands."""
    keys = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"), normalised(docs, text_col).alias("norm"))
    keys = keys.select("id", "text", "norm", F.length("norm").alias("len"),
                       F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"))
    pairs = keys.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = shared_table(pairs.select(F.xxhash64("len", "prefix").alias("pair")), "exact-dedup-pairs")

    full = F.sha2(F.col("norm").cast("binary"), 256)
    rows = (with_bitmap(keys, F.xxhash64("len", "prefix"), pairs, "open", bitmap_bits)
            .select("id", "len", "prefix", "open", (full if digest_all else F.when(F.col("open"), full)).alias("sha"),
                    *([F.xxhash64("text").alias("raw")] if raw else []), F.monotonically_increasing_id().alias("row")))
    rows = shared_table(rows, "exact-dedup-rows")
    left = rows.where("open")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    groups = (left.groupBy("len", "prefix", "sha").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1")
              .select(F.col("sha").alias("g_sha"), "n", F.col("first.id").alias("g_id"), F.col("first.row").alias("g_row")))
    out = left.join(groups, left["sha"] == groups["g_sha"], "left")
    alone = F.col("n").isNull()
    more = ["sha", *(["raw"] if raw else [])]
    return out.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("g_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("g_row"))).alias("kept"),
        *more).unionByName(rows.where("NOT open").select(
            "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *more))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, all columns.

    Decisions come back to the documents by id and a 64-bit hash of the
    text as it stands, so only rows that the first two steps left together
    are hashed in full; of rows that repeat both, one stays."""
    decided = shared_table(_decided(docs, id_col, text_col, False, prefix_chars, bitmap_bits, raw=True)
                           .select("id", "raw", "kept"), "exact-dedup-kept")
    keep = (decided.groupBy("id", "raw").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("same"))
            .where("kept").select("id", "raw", "same"))
    return pick_rows(docs, id_col, F.xxhash64(text_of(docs, text_col)), keep)
