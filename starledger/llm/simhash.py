"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints link when they differ in at most three bits.  Two linked
fingerprints a and b meet in the middle: after one bit of a and one bit
of b are flipped, at most one differing bit is left between the two
variants.  Every distinct fingerprint therefore emits the variants of its
ball of radius one (half of three, rounded down); the odd bit in the
middle is left open by keying each variant on three of its four 16-bit
blocks, so a variant and its neighbour in the open block share a key.
That is 4 * (1 + 48) = 196 short rows per distinct fingerprint (flips
inside the open block share the unflipped key and are made after the
shuffle), against 2,081 for keys of whole variants of radius two.

Rows that share a key meet in one task, at most 49 * 2**16 per key by
construction.  There, a *cell* holds the fingerprints whose ball contains
one variant: its members differ pairwise in at most two bits, and members
of two cells whose variants differ in one open bit differ in at most
three.  So each cell is linked to its smallest member, and neighbouring
cells by their smallest members; every emitted pair is verified by its
bit distance.  Star links carry the same components as all pairs, and
their number grows linearly with a group of near copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import pick_rows, shared_table, text_of
from starledger.llm.components import connected_components, local_forest

SHINGLE = 3
SEED = 42
MAX_BITS = 3
VARIANTS = 4 * (1 + 48)
TASK_FINGERPRINTS = 25_000  # 4.9 million variant rows made by a task
TASK_VARIANTS = 1 << 20     # variant rows whose cells a task holds
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of one text (null or wordless: 0)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    count, total, digest, chunk = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest, []
    for gram in grams:
        chunk.append(digest(gram, seed))
        if len(chunk) == _CHUNK:
            count += _bit_counts(chunk)
            total += len(chunk)
            chunk = []
    if chunk:
        count += _bit_counts(chunk)
        total += len(chunk)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big", signed=True)


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(len(hashes), 8)
    return np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, text_hash, fp) for every row of ``docs``; whole texts."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["id", "text_hash", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    narrow = docs.select(docs[id_col].alias("id"), F.xxhash64(text_of(docs, text_col)).alias("text_hash"),
                         text_of(docs, text_col).alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, text_hash long, fp long")


def _variant_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): open block in the top 16 bits, the other 48 bits below."""
    block = F.col("block")
    wide = (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("block"))
            .select("fp", "block", F.explode(F.sequence(F.lit(-1), F.lit(47))).alias("bit")))
    low = F.expr("shiftleft(1L, block * 16) - 1")
    rest = F.col("fp").bitwiseAND(low).bitwiseOR(
        # the bits above the open block move down by 16; block 3 has none
        F.when(block == 3, F.lit(0)).otherwise(
            F.expr("shiftleft(shiftrightunsigned(fp, block * 16 + 16), block * 16)")))
    flip = F.when(F.col("bit") < 0, F.lit(0)).otherwise(F.expr("shiftleft(1L, bit)"))
    return wide.select(rest.bitwiseXOR(flip).bitwiseOR(F.expr("shiftleft(cast(block as bigint), 48)")).alias("key"),
                       "fp")


def _squeeze(fp: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The 48 bits outside the open block (numpy twin of _variant_keys)."""
    at = (block * np.uint64(16)).astype(np.uint64)
    low = (np.uint64(1) << at) - np.uint64(1)
    high = np.where(block == 3, np.uint64(0), (fp >> np.minimum(at + np.uint64(16), np.uint64(63))) << at)
    return (fp & low) | high


def link_cells(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the fingerprints (uint64) that share a key."""
    none = np.empty(0, np.uint64)
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.r_[start[1:], len(key)] - 1
    mixed = fp[start] != fp[end]  # keys with one distinct fingerprint link nothing
    size = end - start + 1
    use = np.repeat(mixed, size)
    if not use.any():
        return none, none
    bucket = np.repeat(np.arange(len(start)), size)[use].astype(np.int64)
    key, fp = key[use], fp[use]
    block = key >> np.uint64(48)
    inside = ((fp >> (block * np.uint64(16))) & np.uint64(0xFFFF)).astype(np.int64)
    plain = _squeeze(fp, block) == (key & np.uint64((1 << 48) - 1))
    bits = np.int64(1) << np.arange(16)
    cell = np.concatenate([bucket << 16 | inside,
                           ((bucket[plain] << 16 | inside[plain])[:, None] ^ bits).ravel()])
    member = np.concatenate([fp, np.repeat(fp[plain], 16)])
    order = np.lexsort((member, cell))
    cell, member = cell[order], member[order]
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    head = member[start]
    star = np.repeat(head, np.diff(np.r_[start, len(cell)]))
    src, dst = [member], [star]
    cells = cell[start]
    for bit in bits:
        want = cells ^ bit
        at = np.minimum(np.searchsorted(cells, want), len(cells) - 1)
        hit = (cells[at] == want) & (want > cells)
        src.append(head[hit])
        dst.append(head[at[hit]])
    src, dst = np.concatenate(src), np.concatenate(dst)
    ok = (src != dst) & (np.bitwise_count(src ^ dst) <= MAX_BITS)
    return src[ok], dst[ok]


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) whose connected components are those of "at most three
    differing bits" over the distinct values of column ``fp``."""
    def run(batches):
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
                 for b in batches if b.num_rows]
        if not parts:
            return
        key = np.concatenate([p[0] for p in parts]).astype(np.int64).view(np.uint64)
        fp = np.concatenate([p[1] for p in parts]).astype(np.int64).view(np.uint64)
        src, dst = link_cells(key, fp)
        if len(src):
            src, dst = local_forest(src.view(np.int64), dst.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["a", "b"])

    # the variants are made by tasks of a bounded number of fingerprints
    found = fps.count()
    tasks = -(-found // TASK_FINGERPRINTS)
    keys = _variant_keys(fps.select("fp").repartition(max(1, tasks), "fp").distinct())
    # and the cells by tasks of a bounded number of variants
    tasks = -(-found * VARIANTS // TASK_VARIANTS)
    return keys.repartition(max(1, tasks), "key").mapInArrow(run, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex
    digits), ``component_id`` (the smallest id reachable through links).

    Null and wordless texts have fingerprint zero and link like any other.
    Repeated rows give repeated result rows.  A null id keeps its place; it
    is ``component_id`` only if every id of the component is null.  Extra
    columns are ignored; an empty table gives an empty result."""
    found = _labelled_rows(docs, id_col, text_col, shingle, seed)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def _labelled_rows(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """(id, text_hash, fp, component, component_id) for every row."""
    rows = shared_table(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-rows")
    nodes = shared_table(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-fps")
    comp = connected_components(fingerprint_links(nodes))
    labelled = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "low", F.coalesce("comp", "fp").alias("component"))
    labelled = shared_table(labelled, "simhash-labelled")
    lows = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    return rows.join(labelled.select("fp", "component").join(lows, "component"), "fp")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row of each component of :func:`near_dedup`, all columns: the
    one with the smallest id (null ids last; of different texts under that
    id the one with the smallest text hash; of repeated rows any one)."""
    found = shared_table(_labelled_rows(docs, id_col, text_col, shingle, seed), "simhash-decided")
    best = (found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
                                           .alias("best")).select("best.id", "best.text_hash"))
    same = found.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("same"))
    keep = best.toDF("b_id", "b_hash").join(
        same, F.col("b_id").eqNullSafe(F.col("id")) & (F.col("b_hash") == F.col("text_hash")))
    return pick_rows(docs, id_col, F.xxhash64(text_of(docs, text_col)), keep.select("b_id", "b_hash", "same"))
