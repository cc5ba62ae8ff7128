"""Removal of word passages that start earlier in the corpus.

Every window of ``window`` consecutive words gets a Rabin-Karp hash: the
polynomial of its words' 64-bit hashes, modulo 2 ** 64, for all starts of
a text at once.  A second polynomial of another base deals windows to
buckets, so windows are compared on both and chance collisions stay
proportional to a bucket, whatever the corpus holds (about 1e-13 a window
at the default size of a bucket).

*Counting.*  A task takes some thousand texts at a time, keeps the first
of equal windows among them and marks the others at once, so a passage
that very many texts share leaves a task once per such group of texts.
The rest goes to its bucket as packed arrays (hash, id, start), ordered by
id and start; a bucket marks every window but the first of its hash.
Buckets are sized by the bytes of the corpus.

*Removal.*  Marks meet the texts by id; overlapping and touching marked
windows merge into maximal intervals of words, which go.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import pack_steps, text_of, unpack_steps

WINDOW = 20
BUCKET_BYTES = 8 << 20      # of text whose windows share a bucket, on average
LEAST_BUCKETS = 64
GROUP_WINDOWS = 1 << 21     # windows a task compares by itself
CACHE_WORDS = 400_000       # hashes of words a task holds
NO_ID = np.iinfo(np.int64).min

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words; long words are hashed each time."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every window of ``width`` words: the polynomial in ``base``
    of the words' hashes.  Windows of 1, 2, 4, ... words are joined up to
    ``width``, which gives the hashes that rolling along the text gives."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    out, done = None, 0
    part, size = words, 1
    while True:
        if width & size:
            if out is None:
                out = part
            else:
                out = out[:len(words) - done - size + 1] * np.uint64(pow(base, size, 1 << 64)) + part[done:]
            done += size
        if size * 2 > width:
            return out
        part = part[:-size] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
        size *= 2


_PACKED = "bucket int, kind int, id long, body binary, ids binary, starts binary"
_WINDOWS, _MARKS, _TEXT = range(3)


def _rows(kind: int, groups) -> pa.RecordBatch:
    """One row per (bucket, hashes, ids, starts) that has any."""
    full = [g for g in groups if len(g[1])]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(b) for b, *_ in full], pa.int32()), pa.array([kind] * len(full), pa.int32()),
         pa.nulls(len(full), pa.int64()), pa.array([h.tobytes() for _, h, _, _ in full], pa.binary()),
         pa.array([pack_steps(i) for _, _, i, _ in full], pa.binary()),
         pa.array([pack_steps(s) for _, _, _, s in full], pa.binary())], _NAMES)


_NAMES = [c.split()[0] for c in _PACKED.split(", ")]


def _mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    return (values * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(32)


def _grouped(bucket: np.ndarray, buckets: int, *arrays: np.ndarray):
    """(bucket, arrays of its elements in their order) by bucket."""
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    parts = np.split(order, cut)
    return [(bucket[p[0]], *[a[p] for a in arrays]) for p in parts if len(p)]


def _marks(hashes: np.ndarray, ids: np.ndarray, starts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Marked windows, ordered by id and start, dealt by id."""
    return _rows(_MARKS, _grouped(_mix(ids.view(np.uint64)) % np.uint64(buckets), buckets, _check(hashes), ids, starts))


def _check(hashes: np.ndarray) -> np.ndarray:
    """What a mark carries of its window's hash."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


class Grouper:
    """Windows of some thousand texts: the first of equal ones go to their
    buckets, the others are marked."""

    def __init__(self, width: int, buckets: int):
        self.width, self.buckets = width, buckets
        self.words = WordHashes()
        self.held: list[tuple[int, np.ndarray]] = []
        self.many = 0

    def add(self, doc: int, text: str | None) -> None:
        words = words_of(text)
        if len(words) >= self.width:
            self.held.append((doc, np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))))
            self.many += len(words) - self.width + 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self.held.sort(key=lambda d: d[0])
        docs = np.array([d for d, _ in self.held], np.int64)
        sizes = np.array([len(w) - self.width + 1 for _, w in self.held], np.int64)
        hashes = np.concatenate([window_hashes(w, self.width, _BASES[0]) for _, w in self.held])
        spread = np.concatenate([window_hashes(w, self.width, _BASES[1]) for _, w in self.held])
        ids, starts = np.repeat(docs, sizes), _counting(sizes)
        self.held, self.many = [], 0
        bucket = (_mix(spread) % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((bucket, hashes))  # equal windows by id, then start
        again = np.empty(len(order), bool)
        again[order] = _repeats(hashes[order], bucket[order], ids[order], starts[order])
        if again.any():
            yield _marks(hashes[again], ids[again], starts[again], self.buckets)
        first = ~again
        groups = _grouped(bucket[first], self.buckets, hashes[first], ids[first], starts[first])
        for at in range(0, len(groups), 1024):
            yield _rows(_WINDOWS, groups[at:at + 1024])


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for each size."""
    return (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)


def _repeats(hashes: np.ndarray, bucket: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the windows, ordered by hash, bucket, id and start, have an
    equal one at a smaller (id, start)."""
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    return (ids != ids[head]) | (starts != starts[head])


def mark_windows(docs: DataFrame, window: int, buckets: int, group_windows: int) -> DataFrame:
    """Packed marks of the windows of ``docs`` (id, text) that also start
    earlier, dealt by id: the arrays body (the upper half of each hash),
    ids and starts."""
    def spread(batches):
        grouper = Grouper(window, buckets)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grouper.add(NO_ID if doc is None else doc, text.as_py())
                if grouper.many >= group_windows:
                    yield from grouper.flush()
        yield from grouper.flush()

    def compare(batches):
        held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        for batch in batches:
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            if (kinds == _MARKS).any():
                yield batch.filter(pa.array(kinds == _MARKS))
            for row in batch.filter(pa.array(kinds == _WINDOWS)).to_pylist():
                held.setdefault(row["bucket"], []).append((row["body"], row["ids"], row["starts"]))
        for bucket in list(held):
            parts = held.pop(bucket)
            hashes = np.concatenate([np.frombuffer(h, np.uint64) for h, _, _ in parts])
            ids = np.concatenate([unpack_steps(i, np.int64) for _, i, _ in parts])
            starts = np.concatenate([unpack_steps(s, np.int32) for _, _, s in parts])
            order = np.argsort(hashes)
            near = hashes[order]
            same = np.zeros(len(near), bool)     # only windows with an equal one need the full order
            same[1:] = near[1:] == near[:-1]
            same[:-1] |= same[1:]
            some = order[same]
            some = some[np.lexsort((starts[some], ids[some], hashes[some]))]
            again = some[_repeats(hashes[some], np.zeros(len(some)), ids[some], starts[some])]
            again = again[np.lexsort((starts[again], ids[again]))]
            yield _marks(hashes[again], ids[again], starts[again], buckets)

    return docs.mapInArrow(spread, _PACKED).repartition(buckets, "bucket").mapInArrow(compare, _PACKED)


def merged(starts: np.ndarray, width: int) -> np.ndarray:
    """Maximal intervals (begin, end) that the windows at the ascending
    ``starts`` cover."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    starts = starts.astype(np.int64)
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + width])
    return np.stack([starts[new], np.r_[starts[new[1:] - 1], starts[-1]] + width], axis=1)


class Marks:
    """The marked windows of one bucket of ids."""

    def __init__(self, parts: list[tuple[bytes, bytes, bytes]]):
        ids = np.concatenate([np.empty(0, np.int64), *[unpack_steps(i, np.int64) for _, i, _ in parts]])
        starts = np.concatenate([np.empty(0, np.int32), *[unpack_steps(s, np.int32) for _, _, s in parts]])
        checks = np.concatenate([np.empty(0, np.uint32), *[np.frombuffer(c, np.uint32) for c, _, _ in parts]])
        order = np.lexsort((starts, ids))
        ids, self.starts, self.checks = ids[order], starts[order], checks[order]
        first = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1)) if len(ids) else np.empty(0, np.int64)
        self.of = dict(zip(ids[first].tolist(), zip(first.tolist(), [*first[1:].tolist(), len(ids)])))

    def spans(self, doc: int, words: list[bytes], hashes: WordHashes, window: int) -> np.ndarray:
        """Intervals of ``words`` that the marks of ``doc`` remove."""
        if doc not in self.of or len(words) < window:
            return np.empty((0, 2), np.int64)
        begin, end = self.of[doc]
        starts, checks = self.starts[begin:end], self.checks[begin:end]
        numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        own = _check(window_hashes(numbers, window, _BASES[0]))
        fit = starts < len(own)     # another row of the same id may be longer
        starts, checks = starts[fit], checks[fit]
        return merged(np.unique(starts[own[starts] == checks]), window)


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    bucket_bytes: int = BUCKET_BYTES, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``removed``
    (intervals of words, begin and end, that go), ``n_removed`` and ``kept``
    (the other words, joined by one space).

    A word goes if a window of ``window`` words that covers it also starts
    at a smaller id, or at the same id further to the front; windows are
    judged on the input.  Ids are whole numbers; a null id (kept as the
    least long) comes before all others.  Null text has no words.  Rows
    that repeat an id share its starts: equal windows at the same start of
    the same id do not remove each other.  Other columns are ignored."""
    narrow = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / bucket_bytes))
    marks = mark_windows(narrow, window, buckets, group_windows)

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column(0).fill_null(int(NO_ID)).to_numpy()
            bucket = _mix(ids.view(np.uint64)) % np.uint64(buckets)
            nothing = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), pa.array(np.full(len(ids), _TEXT, np.int32)), pa.array(ids),
                 pa.array([squeeze.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column(1)],
                          pa.binary()), nothing, nothing], _NAMES)

    def cut(batches):
        hashes, expand = WordHashes(), zstandard.ZstdDecompressor()
        bucket, parts, marked = None, [], None
        for batch in batches:
            out = []
            for row in batch.to_pylist():     # a bucket's marks come before its texts
                if row["bucket"] != bucket:
                    bucket, parts, marked = row["bucket"], [], None
                if row["kind"] == _MARKS:
                    parts.append((row["body"], row["ids"], row["starts"]))
                    continue
                if marked is None:
                    marked, parts = Marks(parts), []
                words = expand.decompress(row["body"]).split()
                kept, at, removed = [], 0, []
                for begin, end in marked.spans(row["id"], words, hashes, window).tolist():
                    removed.append({"begin": begin, "end": end})
                    kept += words[at:begin]
                    at = end
                kept += words[at:]
                out.append((None if row["id"] == NO_ID else row["id"], len(words), removed, b" ".join(kept)))
            ids, sizes, removed, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.binary())], ["id", "n_words", "removed", "kept"])

    met = (marks.unionByName(narrow.mapInArrow(pack, _PACKED)).repartition(buckets, "bucket")
           .sortWithinPartitions("bucket", "kind"))
    rows = met.mapInArrow(cut, "id long, n_words long, removed array<struct<begin: int, end: int>>, kept binary")
    lengths = F.transform("removed", lambda r: (r["end"] - r["begin"]).cast("long"))
    return rows.select(F.col("id").alias(id_col), "n_words", "removed",
                       F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
                       F.col("kept").cast("string").alias("kept"))
