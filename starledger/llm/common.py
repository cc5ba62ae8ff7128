"""Small helpers shared by the operators: shared-folder tables, column
names that cannot clash, and the text rules the contracts name."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.session import scratch_path

#: ASCII white space as the contracts define it, as a Java regex class.
SPACE = r"[\x20\x09-\x0D]"
BITMAP_BITS = 27     # 16 MB: what a broadcast bitmap may have at most
BLOCK = 1 << 15      # bits of a block, as bitmap_construct_agg makes them
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read
    it back: lineage is cut, every later pass sees the same rows, and a
    lost executor costs nothing but a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, each with underscores appended until no column of
    ``df`` (in any case) has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def text_of(df: DataFrame, name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod`` (null: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(mod)).cast("int")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_bitmap(df: DataFrame, place: Column, places: DataFrame, found: str, max_bits: int = BITMAP_BITS) -> DataFrame:
    """``df`` plus the boolean column ``found``: whether the hash ``place``
    may be among those in the only column of ``places`` (a stored table).
    False is certain, true may be a collision, null hashes are not found.

    What is broadcast is a bitmap of 16 bits per hash and 2 ** ``max_bits``
    bits at most, in blocks of 4 KB; ``df`` is not shuffled."""
    bits = min(max_bits, (16 * places.count()).bit_length())
    at, block, own, bitmap = fresh(df.withColumn(found, F.lit(True)), "at", "block", "own", "bitmap")
    bucket = lambda h: F.pmod(h, F.lit(1 << bits))
    inside = lambda c: F.col(c).bitwiseAND(F.lit(BLOCK - 1))
    blocks = (places.select(bucket(F.col(places.columns[0])).alias(at)).where(F.col(at).isNotNull())
              .groupBy((F.col(at) - inside(at)).alias(block)).agg(F.bitmap_construct_agg(inside(at)).alias(bitmap)))
    byte = F.col(bitmap).substr((F.floor(inside(at) / 8) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(F.col(at), F.lit(8)).cast("int")) == 1
    marked = df.withColumn(at, bucket(place)).withColumn(own, F.col(at) - inside(at))
    return (marked.join(F.broadcast(blocks), F.col(own) == F.col(block), "left")
            .select(*[df[c] for c in df.columns], F.coalesce(hit, F.lit(False)).alias(found)))


def pick_rows(docs: DataFrame, id_col: str, key: Column, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (id, key) is in ``keep`` (columns: id,
    key, number of rows of ``docs`` with that pair), all columns, one row
    per pair.  Rows that repeat a pair are equal in id and text; only if
    there are any, one of them is picked by an extra aggregation."""
    key_col, k_id, k_key, same = fresh(docs, "key", "k_id", "k_key", "same")
    keep = keep.toDF(k_id, k_key, same)
    keyed = docs.withColumn(key_col, key)
    kept = keyed.join(keep, keyed[id_col].eqNullSafe(keep[k_id]) & (keyed[key_col] == keep[k_key]))
    if keep.where(F.col(same) > 1).isEmpty():
        return kept.select(docs.columns)
    once = kept.where(F.col(same) == 1).select(docs.columns)
    return once.unionByName(kept.where(F.col(same) > 1).dropDuplicates([k_id, k_key]).select(docs.columns))


def pack_steps(values: np.ndarray) -> bytes:
    """An array of integers in few bytes: the differences of neighbours,
    their bytes by place value, compressed.  Small for ascending values."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_steps(data: bytes, kind) -> np.ndarray:
    """The array, of numpy type ``kind``, that :func:`pack_steps` packed."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)
