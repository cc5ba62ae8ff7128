"""Scores of whole texts under a hashed maximum-entropy language model.

*Counts.*  Every training token is counted (words, and one end per text);
each task counts its texts and Spark adds up the counts.  They give the
base score, the model's vocabulary and its starting point.

*Model.*  The next token is predicted from hashed features: the word
before, the two words before (n-grams), the word two back and the word
three back (skips).  The softmax is factored by class: the frequent words
form classes of ``CLASS_WORDS`` by rank, all other words one more class,
so a token costs one softmax over classes and one within its class.  In
the class of other words, a word has its smoothed share of their counts.

*Training.*  Weights start at the logarithm of the counts.  Each training
text belongs to one round and one shard, by a hash.  In a round, one task
per shard runs gradient steps (scaled per row of weights) from the shared
weights, Spark adds up the changes of each row over all shards, weighted
by use, and the driver, which only ever holds the two fixed-size tables,
hands out the sum.  Rounds and shards cover all training texts.

*Scoring.*  A pass over all texts evaluates sparse batches of token
positions in numpy.  Counts of the most frequent words travel with the
tasks (a bounded number); the rest, which are rare by construction, are
looked up by one join on the word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import shared_table, text_of

END = b"\n"               # no word holds white space
CLASSES = 31              # of frequent words; one more holds all others
CLASS_WORDS = 32
VOCABULARY = CLASSES * CLASS_WORDS
LOOKUP = 1 << 17          # at most so many words' counts travel with the tasks, the most frequent ...
LOOKUP_BYTES = 64         # ... of those with so many bytes at most
ROWS_CLASS = 1 << 14      # rows of hashed weights for classes ...
ROWS_WORD = 1 << 15       # ... and for words within a class
WIDTH = CLASSES + 1
ROUNDS = 2
RATE = 0.25
BATCH = 4096              # token positions evaluated at a time
SHARD_TOKENS = 8_000_000  # training tokens per shard
STEP = 1 << 24            # changes are added up in whole 1 / STEP, so their sum does not depend on its order
FEW_USES = 8              # uses of a row in a step that are added side by side
CHUNK_BYTES = 1 << 20     # text whose words are numbered at a time
FLUSH = 400_000           # distinct words a counting task holds

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_SPIN = np.uint64(0xFF51AFD7ED558CCD)
BOS = 1 << 20             # stands for the positions before a text


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


@dataclass
class Chunk:
    """The words of some neighbouring texts, each distinct word once."""

    begin: int               # the first text's place in its batch
    distinct: pa.Array       # distinct words, binary
    codes: np.ndarray        # per word, its place in ``distinct``
    sizes: np.ndarray        # words per text, ends not counted

    @property
    def words(self) -> list[bytes]:
        return self.distinct.to_numpy(zero_copy_only=False).tolist()

    @property
    def number(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES):
    """The texts in chunks of about ``size`` bytes (a longer text alone),
    split as :func:`tokens` does."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + size, side="right")))
        part = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(begin, end - begin), "")))
        words = pc.ascii_split_whitespace(part)
        coded = words.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.binary_length(part).to_numpy(zero_copy_only=False) == 0  # split into one empty word
        sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        if empty.any():
            codes = codes[~np.repeat(empty, sizes)]
            sizes = np.where(empty, 0, sizes)
        yield Chunk(begin, coded.dictionary.cast(pa.binary()), codes, sizes)
        begin = end


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all rows of ``docs``; a shared table."""
    def run(batches):
        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              ["word", "c"])
        seen: Counter = Counter()
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                for word, c in zip(chunk.words, np.bincount(chunk.codes, minlength=len(chunk.distinct)).tolist()):
                    if c:
                        seen[word] += c
                seen[END] += len(chunk.sizes)
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    parts = docs.select(text_of(docs, text_col).alias("text")).mapInArrow(run, "word binary, c long")
    return shared_table(parts.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


@dataclass
class Lexicon:
    """What tasks need of the counts; sizes are bounded."""

    rank: Ranks              # end is 0, then by count; the first VOCABULARY ranks are the model's words
    count: np.ndarray        # by rank
    total: int               # training tokens
    distinct: int            # distinct training tokens

    @property
    def base_scale(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def other_scale(self) -> float:
        """Normaliser of the words outside the model's vocabulary."""
        known = self.count[:VOCABULARY]
        return float(self.total - known.sum()) + 0.5 * (self.distinct - int((known > 0).sum()) + 1)


def lexicon(counts: DataFrame, lookup: int = LOOKUP) -> Lexicon:
    """The most frequent words, ``lookup`` of them at most.  Words of more
    than ``LOOKUP_BYTES`` bytes are never among them, so its size is bounded
    in bytes, too; they are looked up by the join."""
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.max(F.when(F.col("word") == F.lit(bytearray(END)), F.col("c"))).alias("ends")).first()
    # A histogram of counts (some thousand cells at most) tells from which count on words fit, so no task has to rank
    # all words; of the one cell that does not fit as a whole, the first by count, then hash.
    cell = F.floor(F.log2("c") * 64).cast("int")
    words = counts.where((F.col("word") != F.lit(bytearray(END))) & (F.octet_length("word") <= LOOKUP_BYTES)).withColumn("cell", cell)
    room, least, cut = lookup - 1, None, None
    for r in sorted(words.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.cell):
        if r.n > room:
            cut = r.cell
            break
        room, least = room - r.n, r.cell
    top = words.where(F.col("cell") >= least if least is not None else F.lit(False)).select("word", "c").toArrow()
    if cut is not None and room:
        some = words.where(F.col("cell") == cut).orderBy(F.desc("c"), F.xxhash64("word"), "word").limit(room)
        top = pa.concat_tables([top, some.select("word", "c").toArrow()])
    top = top.sort_by([("c", "descending"), ("word", "ascending")])
    words = [END, *top.column("word").to_pylist()]
    return Lexicon(Ranks(zip(words, range(len(words)))),
                   np.array([whole["ends"] or 0, *top.column("c").to_pylist()], np.int64), whole["n"] or 0, whole["v"] or 0)


class Model:
    """Two tables of hashed weights and their unhashed starting points."""

    def __init__(self, lex: Lexicon):
        count = np.zeros(VOCABULARY)
        known = lex.count[:VOCABULARY]
        count[:len(known)] = known
        count += 0.5
        by_class = count.reshape(CLASSES, CLASS_WORDS)
        mass = np.append(by_class.sum(axis=1), max(lex.total - known.sum(), 0) + 0.5)
        self.class_start = np.log(mass / mass.sum()).astype(np.float32)
        self.word_start = np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32)
        self.classes = np.zeros((ROWS_CLASS, WIDTH), np.float32)
        self.words = np.zeros((ROWS_WORD, CLASS_WORDS), np.float32)

    def class_logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((rows.shape[1], WIDTH), np.float32)
        out[:] = self.class_start
        return self._add(out, self.classes, rows)

    def word_logits(self, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        return self._add(self.word_start[of], self.words, rows)

    @staticmethod
    def _add(out: np.ndarray, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        one = np.empty_like(out)
        for r in rows:
            np.take(table, r, axis=0, out=one, mode="clip")
            out += one
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    """In place, over rows; logits are clipped far beyond any use."""
    np.clip(x, -60, 60, out=x)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def log_chance(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of ``target`` under the softmax of each row."""
    np.clip(x, -60, 60, out=x)
    got = x[np.arange(len(x)), target].astype(np.float64)
    np.exp(x, out=x)
    return got - np.log(x.sum(axis=1, dtype=np.float64))


def features(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes (4, n) of the contexts of the positions ``at``: one and two
    words before, and skips of one and two words."""
    one, two, three = (ids[at - k].astype(np.uint64) for k in (1, 2, 3))
    raw = np.stack([one * _MIX[0], one * _MIX[0] + two * _MIX[1], two * _MIX[2], three * _MIX[3]])
    raw ^= raw >> np.uint64(31)
    raw *= _SPIN
    return raw


def class_rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (ROWS_CLASS - 1)


def word_rows(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (of.astype(np.uint64) * _MIX[1])) * _SPIN
    return (mixed >> np.uint64(40)).astype(np.int64) & (ROWS_WORD - 1)


class Ranks(dict):
    """Ranks by word; other words get a number by hash beyond all ranks,
    so that context features still tell them apart."""

    def __missing__(self, word: bytes) -> int:
        return BOS + 1 + (zlib.crc32(word) & 0xFFFF)


def positions(chunk: Chunk, rank: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, at, text number): the numbers of all tokens with three begin
    marks before each text and the end (rank 0) after it, and which
    positions are tokens."""
    ranks = np.fromiter(map(rank.__getitem__, chunk.words), np.int64, len(chunk.distinct))
    whole = chunk.sizes + 4
    start = np.cumsum(whole) - whole
    ids = np.zeros(int(whole.sum()), np.int64)
    ids[(start[:, None] + np.arange(3)).ravel()] = BOS
    ids[np.arange(len(chunk.codes)) + 4 * chunk.number + 3] = ranks[chunk.codes]
    number = np.repeat(np.arange(len(whole)), chunk.sizes + 1)
    return ids, np.arange(len(number)) + 3 * (number + 1), number


def rare_words(chunk: Chunk, known: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Per text, the distinct words that are not ``known`` (per word of the
    chunk) and how often each occurs in it, as two arrays of lists."""
    pick = np.flatnonzero(~known)
    width = max(1, len(chunk.distinct))
    pairs, times = np.unique(chunk.number[pick] * width + chunk.codes[pick], return_counts=True)
    offsets = pa.array(np.searchsorted(pairs, np.arange(len(chunk.sizes) + 1) * width), pa.int32())
    return (pa.ListArray.from_arrays(offsets, chunk.distinct.take(pa.array(pairs % width))),
            pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())))


def evaluate(model: Model, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log probability of each token, or of its class for words
    outside the vocabulary."""
    out = np.empty(len(at), np.float64)
    for k in range(0, len(at), BATCH):
        part = at[k:k + BATCH]
        target = ids[part]
        hashes = features(ids, part)
        of = np.minimum(target // CLASS_WORDS, CLASSES)
        got = log_chance(model.class_logits(class_rows(hashes)), of)
        inner = np.flatnonzero(of < CLASSES)
        got[inner] += log_chance(model.word_logits(word_rows(hashes[:, inner], of[inner]), of[inner]),
                                 target[inner] % CLASS_WORDS)
        out[k:k + BATCH] = got
    return out


class Trainer:
    """Gradient steps of one task, from the shared weights."""

    def __init__(self, model: Model, rate: float):
        self.rate = rate
        self.model = model
        self.class_from, self.word_from = model.classes.copy(), model.words.copy()
        self.class_scale, self.word_scale = np.full(ROWS_CLASS, 1.0, np.float32), np.full(ROWS_WORD, 1.0, np.float32)
        self.class_use, self.word_use = np.zeros(ROWS_CLASS, np.int64), np.zeros(ROWS_WORD, np.int64)

    def step(self, ids: np.ndarray, at: np.ndarray) -> None:
        target = ids[at]
        hashes = features(ids, at)
        of = np.minimum(target // CLASS_WORDS, CLASSES)
        rows = class_rows(hashes)
        grad = softmax(self.model.class_logits(rows))
        grad[np.arange(len(at)), of] -= 1
        self._apply(self.model.classes, self.class_scale, self.class_use, rows, grad)
        inner = np.flatnonzero(of < CLASSES)
        if len(inner):
            rows = word_rows(hashes[:, inner], of[inner])
            grad = softmax(self.model.word_logits(rows, of[inner]))
            grad[np.arange(len(inner)), target[inner] % CLASS_WORDS] -= 1
            self._apply(self.model.words, self.word_scale, self.word_use, rows, grad)

    def _apply(self, weights, scale, use, rows, grad):
        """Per row, the summed gradient over the root of its summed squares."""
        flat = rows.astype(np.uint16).ravel()  # 16 bits: sorted by radix
        order = np.argsort(flat, kind="stable")
        hit = flat[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, hit[1:] != hit[:-1]])
        hit, times = hit[first], np.diff(np.r_[first, len(flat)])
        at = np.tile(np.arange(len(grad)), len(rows))[order]  # the position of each use, uses of a row side by side
        # most rows are used a few times: the k-th uses of all rows are added at once, what is left run by run
        total = grad[at[first]]
        more = np.flatnonzero(times > 1)
        for k in range(1, FEW_USES):
            total[more] += grad[at[first[more] + k]]
            more = more[times[more] > k + 1]
        if len(more):
            left = times[more] - FEW_USES
            start = np.cumsum(left) - left
            rest = grad[at[np.repeat(first[more] + FEW_USES - start, left) + np.arange(left.sum())]]
            total[more] += np.add.reduceat(rest, start, axis=0)
        scale[hit] += (total * total).sum(axis=1)
        weights[hit] -= (self.rate / np.sqrt(scale[hit]))[:, None] * total
        use[hit] += times

    def changes(self):
        """(table, row, use, change times use) of every row that was used."""
        for table, use, now, was in ((0, self.class_use, self.model.classes, self.class_from),
                                     (1, self.word_use, self.model.words, self.word_from)):
            hit = np.flatnonzero(use)
            change = np.zeros((len(hit), WIDTH), np.int64)
            change[:, :now.shape[1]] = np.rint((now[hit] - was[hit]).astype(np.float64) * STEP) * use[hit][:, None]
            yield table, hit, use[hit], change


_SUMS = [f"d{i}" for i in range(WIDTH)]
_CHANGE = "kind int, row int, used long, " + ", ".join(f"{d} long" for d in _SUMS)


def train(docs: DataFrame, lex: Lexicon, text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE,
          shard_tokens: int = SHARD_TOKENS, id_col: str | None = None) -> Model:
    """The model after ``rounds`` rounds, each over its slice of ``docs``.

    Slices and their shards follow from the texts (and ids) and the number
    of training tokens alone, and a shard's texts are taken in the order of
    a hash, so the model does not depend on files, partitions or cores."""
    model = Model(lex)
    own = [F.col("text")] if id_col is None else [docs[id_col].alias("id").cast("string"), F.col("text")]
    shards = max(1, -(-lex.total // (shard_tokens * rounds)))
    slices = docs.withColumn("text", text_of(docs, text_col)).select("text", F.xxhash64(*own).alias("place"))
    slices = slices.select("text", "place", F.pmod("place", F.lit(rounds)).alias("turn"),
                           F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard"))
    for turn in range(rounds):
        def run(batches, model=model):
            trainer = Trainer(model, rate)
            for batch in batches:
                for chunk in chunks(batch.column(0)):
                    ids, at, _ = positions(chunk, lex.rank)
                    for k in range(0, len(at), BATCH):
                        trainer.step(ids, at[k:k + BATCH])
            for kind, row, used, change in trainer.changes():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), kind), pa.int32()), pa.array(row, pa.int32()), pa.array(used, pa.int64()),
                     *[pa.array(change[:, i], pa.int64()) for i in range(WIDTH)]], ["kind", "row", "used", *_SUMS])

        part = (slices.where(F.col("turn") == turn).repartitionById(shards, F.col("shard"))
                .sortWithinPartitions("place", "text").select("text"))
        moved = (part.mapInArrow(run, _CHANGE).groupBy("kind", "row")
                 .agg(*[(F.sum(d) / F.sum("used") / F.lit(STEP)).cast("float").alias(d) for d in _SUMS]))
        got = moved.toArrow()  # at most ROWS_CLASS + ROWS_WORD rows
        kind, row = (got.column(n).to_numpy() for n in ("kind", "row"))
        change = np.stack([got.column(d).to_numpy() for d in _SUMS], axis=1) if len(row) else np.zeros((0, WIDTH), np.float32)
        new = Model(lex)
        new.classes, new.words = model.classes.copy(), model.words.copy()
        new.classes[row[kind == 0]] += change[kind == 0]
        new.words[row[kind == 1]] += change[kind == 1, :CLASS_WORDS]
        model = new
    return model


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                rounds: int = ROUNDS, lookup: int = LOOKUP) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``held_out`` (not
    ``learn``), ``n_tokens``, ``n_known`` (tokens counted in training),
    ``train_tokens``, ``base_score`` (smoothed counts) and ``score`` (the
    model), both log10 probabilities of the whole text.

    ``learn`` is a condition over ``docs``; rows for which it does not
    hold, or is null, teach nothing.  Null text is empty: its only token
    is the end.  With no row to learn from, counts are zero and the model
    stays at its smoothed start.  Repeated rows count and are scored one
    by one; extra columns are ignored."""
    learn = F.coalesce(learn, F.lit(False))
    counts = count_tokens(docs.where(learn), text_col)
    lex = lexicon(counts, lookup)
    model = train(docs.where(learn), lex, text_col, rounds, id_col=id_col)
    base = np.log10((lex.count + 0.5) / lex.base_scale)
    other = np.log10((lex.count + 0.5) / lex.other_scale)

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        for batch, chunk in ((b, c) for b in batches for c in chunks(b.column(2))):
            ids, at, number = positions(chunk, lex.rank)
            target = ids[at]
            known = target < len(lex.count)
            rank = np.where(known, target, 0)
            gained = evaluate(model, ids, at) / math.log(10.0)
            gained += np.where(known & (rank >= VOCABULARY), other[rank], 0.0)
            n, begin = len(chunk.sizes), chunk.begin
            inner = np.ones(len(at), bool)
            inner[np.cumsum(chunk.sizes + 1) - 1] = False  # words, not ends
            add = lambda w: np.bincount(number, weights=w, minlength=n)
            words, times = rare_words(chunk, known[inner])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(made, made + n) + (part << 33)), batch.column(0).slice(begin, n),
                 batch.column(1).slice(begin, n), pa.array(chunk.sizes + 1, pa.int64()),
                 pa.array(add((known & (lex.count[rank] > 0)).astype(float)).astype(np.int64)),
                 pa.array(add(np.where(known, base[rank], 0.0))), pa.array(add(gained)),
                 words, times],
                ["row", "id", "learn", "n", "known", "base", "score", "words", "times"])
            made += n

    narrow = docs.select(docs[id_col].alias("id"), learn.alias("learn"), text_of(docs, text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    rows = shared_table(narrow.mapInArrow(
        run, f"row long, id {kind}, learn boolean, n long, known long, base double, score double, "
             "words array<binary>, times array<bigint>"), "lm-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    looked = (rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((c + 0.5) / lex.base_scale)).alias("b"),
        F.sum(F.col("times") * F.log10((c + 0.5) / lex.other_scale)).alias("s")))
    zero = lambda name: F.coalesce(name, F.lit(0.0))
    return rows.join(looked, "row", "left").select(
        F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"), (F.col("base") + zero("b")).alias("base_score"),
        (F.col("score") + zero("s")).alias("score"))
