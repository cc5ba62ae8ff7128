"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` rows.  With weight ``w``
its i-th block is released at slot ``floor(i / w)`` and due at slot
``ceil((i + 1) / w)``; each slot takes, of the released blocks, the one
due first (the smaller source number, if two are due together).  With
weights that add up to one this meets every deadline, so at every moment
the blocks taken from a source differ from its target by less than one.

Weights are taken exactly as their decimals read and brought to whole
parts without rounding, so the schedule repeats after as many slots as
the parts add up to and a block's slot follows from its number by
arithmetic.  When a source runs out, the others' weights are scaled up
and a new phase begins; every row is placed exactly once.  The driver
computes one period per phase, at most one phase per source; of a period
longer than its phase it computes the phase's slots only.  With weights
whose parts add up to more than there are blocks (1/3 as a float, say)
it so holds one entry per block; it never sees rows.

Rows get their number within the source without a single-task window:
they are dealt by range of (source, row hash), so a hot source spreads
over many tasks, written once with their place in the task's file, and
numbered by adding each task's starting number (one count per task and
source reaches the driver).
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import fresh, shared_table
from starledger.sources.schemas import BROADCAST_MAX_BYTES

BLOCK_ROWS = 64
RESOLUTION = 1000
MAX_SOURCES = 500
LAST_SLOT = 2**63 - 1  # a deadline beyond it counts as this


def whole_parts(weights: list[float], resolution: int) -> list[int]:
    """Whole parts in exactly the proportions of ``weights``, which count
    as their decimals read (0.1 is a tenth), in lowest terms; scaled up to
    add up to ``resolution`` where that is a multiple of their sum."""
    exact = [Fraction(str(w)) for w in weights]
    whole = math.lcm(*[e.denominator for e in exact])
    parts = [e.numerator * (whole // e.denominator) for e in exact]
    least = math.gcd(*parts)
    parts = [p // least for p in parts]
    total = sum(parts)
    return parts if resolution % total else [p * (resolution // total) for p in parts]


def windows(parts: int, total: int, i: int) -> tuple[int, int]:
    """Release and deadline of block ``i`` of a source with weight
    ``parts / total``."""
    return i * total // parts, -(-(i + 1) * total // parts)


def period(parts: list[int]) -> Iterator[int]:
    """The source of each slot of one period, earliest deadline first."""
    total = sum(parts)
    waiting = [(0, s) for s in range(len(parts))]  # (release, source)
    taken = [0] * len(parts)
    ready: list[tuple[int, int]] = []              # (deadline, source)
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (windows(parts[s], total, taken[s])[1], s))
        due, s = heapq.heappop(ready)
        if slot >= due:
            raise AssertionError("a deadline was missed")
        yield s
        taken[s] += 1
        heapq.heappush(waiting, (windows(parts[s], total, taken[s])[0], s))


def plan(blocks: list[int], weights: list[float], resolution: int = RESOLUTION) -> list[dict]:
    """Segments of the schedule: for each, the first slot, the sources'
    parts, how many slots, and each source's blocks taken before it.
    ``phase`` is the slot at which the current set of sources began.
    ``order`` is the period, or the segment's slots if they are fewer."""
    left, used, slot, out = list(blocks), [0] * len(blocks), 0, []
    while any(left):
        live = [s for s in range(len(left)) if left[s]]
        parts = whole_parts([weights[s] for s in live], resolution)
        phase, began = slot, list(used)
        rounds = min(left[s] // p for s, p in zip(live, parts))
        order, head, need = [], 0, [0] * len(live)
        for i in period(parts):  # the last, incomplete round ends where a source has nothing left
            if head == len(order) and left[live[i]] - rounds * parts[i] - need[i]:
                need[i] += 1
                head += 1
            elif not rounds:
                break
            order.append(i)
        out.append({"phase": phase, "slots": rounds * len(order) + head, "live": live, "parts": parts, "order": order,
                    "began": began})
        for i, s in enumerate(live):
            got = rounds * parts[i] + need[i]
            left[s] -= got
            used[s] += got
        slot += rounds * len(order) + head
    return out


def interleave(docs: DataFrame, weights: dict[str, float], source_col: str = "source", other_weight: float = 0.01,
               block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION) -> tuple[DataFrame, list[str]]:
    """All rows and columns of ``docs`` plus ``block`` (number within the
    source), ``place`` (within the block), ``slot`` (the order of blocks),
    ``release`` and ``deadline`` (the slots between which the block had to
    be taken); and the five names, which get underscores where ``docs``
    has such a column.  Ordering by (slot, place) gives the mixture.

    Sources without a weight, null among them, share one queue of weight
    ``other_weight``.  Within a source rows are in hash order.  Repeated
    rows are placed one by one; an empty table gives an empty result."""
    if len(weights) > MAX_SOURCES or any(not w > 0 for w in [*weights.values(), other_weight]):
        raise ValueError(f"between 0 and {MAX_SOURCES} sources, each with a positive weight")
    spark = docs.sparkSession
    names = [*weights, None]
    block, place, slot, release, deadline = added = fresh(docs, "block", "place", "slot", "release", "deadline")
    queue, key, part, at = fresh(docs, "queue", "hash", "part", "at")
    number = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for i, n in enumerate(weights) for x in (n, i)]), docs[source_col])
        if weights else F.lit(None), F.lit(len(weights))).cast("int")
    hashable = [docs[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = docs.withColumns({queue: number, key: F.xxhash64(*hashable)})
    dealt = dealt.repartitionByRange(F.col(queue), F.col(key)).sortWithinPartitions(queue, key)
    dealt = dealt.withColumns({part: F.spark_partition_id(),
                               at: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    dealt = shared_table(dealt, "mix-rows")

    runs = (dealt.groupBy(queue, part).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"))
            .orderBy(queue, part).collect())
    rows, shift = [0] * len(names), []
    for q, p, n, low in runs:
        shift.append((q, p, rows[q] - low))  # number within the source = place in the file + shift
        rows[q] += n
    segments = plan([-(-n // block_rows) for n in rows], [*weights.values(), other_weight], resolution)
    spans, offsets = [], array("q")  # of each slot of a period: queue, segment, number in the period, slot, window
    for k, s in enumerate(segments):
        total, seen = sum(s["parts"]), [0] * len(s["live"])
        for t, i in enumerate(s["order"]):
            low, due = windows(s["parts"][i], total, seen[i])
            offsets.extend((s["live"][i], k, seen[i], t, low, min(due, LAST_SLOT - s["phase"])))
            seen[i] += 1
        for i, q in enumerate(s["live"]):
            if seen[i]:
                spans.append((q, s["began"][q], k, s["phase"], seen[i], len(s["order"])))

    c_q, c_p, c_shift, c_first, c_seg, c_phase, c_total, c_in, c_slot, c_low, c_due, rn, i_ = fresh(
        dealt, "q", "p", "shift", "first", "seg", "phase", "total", "in", "offset", "low", "due", "rn", "i")
    # three tables whose sizes follow from tasks, sources and the periods
    shift_t = F.broadcast(spark.createDataFrame(shift, f"{c_q} int, {c_p} int, {c_shift} long"))
    numbered = dealt.join(shift_t, (dealt[queue] == shift_t[c_q]) & (dealt[part] == shift_t[c_p])).drop(c_q, c_p)
    numbered = numbered.withColumn(rn, F.col(at) + F.col(c_shift))
    numbered = numbered.withColumns({block: F.floor(F.col(rn) / block_rows).cast("long"),
                                     place: (F.col(rn) % block_rows).cast("int")})
    by_queue: dict[int, list] = {}
    for q, first, k, phase, parts, total in spans:
        by_queue.setdefault(q, []).append((first, k, phase, parts, total))
    fields = "first:bigint,seg:int,phase:bigint,parts:bigint,total:bigint"
    span_t = F.broadcast(spark.createDataFrame([(q, sorted(v)) for q, v in by_queue.items()],
                                               f"{c_q} int, {c_seg} array<struct<{fields}>>"))
    # the last segment that begins at or before the block
    begun = numbered.join(span_t, numbered[queue] == span_t[c_q]).drop(c_q)
    begun = begun.withColumn(c_first, F.element_at(F.filter(c_seg, lambda s: s["first"] <= F.col(block)), -1))
    inner = F.col(block) - F.col(c_first)["first"]
    parts, total, phase = (F.col(c_first)[f] for f in ("parts", "total", "phase"))
    begun = begun.withColumns({i_: inner, c_in: inner % parts, c_total: F.col(c_first)["seg"]})
    columns = np.array(offsets, np.int64).reshape(-1, 6).T
    offset_t = spark.createDataFrame(pa.table([pa.array(c) for c in columns], [c_q, c_p, c_phase, c_slot, c_low, c_due]))
    if columns.nbytes <= BROADCAST_MAX_BYTES:
        offset_t = F.broadcast(offset_t)
    done = begun.join(offset_t, (begun[queue] == offset_t[c_q]) & (begun[c_total] == offset_t[c_p])
                      & (begun[c_in] == offset_t[c_phase]))
    start = phase + ((F.col(i_) - F.col(c_in)) / parts).cast("long") * total  # of the block's period
    result = done.withColumns({slot: start + F.col(c_slot), release: start + F.col(c_low), deadline: start + F.col(c_due)})
    return result.select(*docs.columns, *added), added


def in_mixed_order(docs: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """The rows and columns of ``docs`` in the order of the mixture: files
    by ascending slot, rows in order within each file."""
    mixed, (_, place, slot, _, _) = interleave(docs, weights, **options)
    return mixed.repartitionByRange(F.col(slot), F.col(place)).sortWithinPartitions(slot, place).select(docs.columns)
