"""SentencePiece encoding and decoding with N-best segmentations.

A text's lattice has an edge for each vocabulary piece that matches at a
position; a character that no piece covers is spelt in byte pieces.  The
forward Viterbi pass gives the best score of every prefix.  These are the
exact remaining costs of a search from the end of the text backwards, so
A-star over partial segmentations yields the best, the second best, ...
without exploring anything that cannot be among them.

No piece has a space mark after another character, none covers certain
characters (a line end, say), and much punctuation never follows a letter
within a piece.  So the lattice of a text is a chain of the lattices of
its words, cut at those places, and only words have to be searched.
Viterbi runs once per distinct word that a worker holds in its table and
gives its best segmentation and the loss of its second best.  The best of
the text takes each word's best; any other of the N deviates only at
words among the N - 1 with the smallest loss.  A-star lists the N best of
those words, and again, with the best of the remaining words as its
heuristic, the N best of the text.

Decoding joins the pieces, turns marks into spaces and drops the mark
that encoding put in front; it gives back every text exactly.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pac
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import text_of

MARK = "▁"          # stands for a space
SCALE = 1_000_000        # scores are counted in millionths
UNKNOWN_PENALTY = 10     # an uncovered character scores this below the worst piece
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
CACHE_WORDS = 100_000    # words that a worker keeps when its table, twice as long, is full
CHUNK_WORDS = 2_000      # words searched together
CACHE_CHARS = 64         # longer words are segmented each time


@dataclass
class Vocabulary:
    """Pieces with their ids and scores; read once, on the driver."""

    ids: dict[str, int]
    scores: dict[str, int]     # in whole 1 / SCALE, so that sums are exact and ties are ties
    byte_ids: list[int]
    texts: list[bytes]         # what each id decodes to
    longest: int = 0
    unknown: int = 0
    words: re.Pattern = field(default=None, repr=False)
    single: frozenset[str] = frozenset()    # characters that are pieces
    digest: str = ""

    def __post_init__(self):
        self.digest = sha256(repr((self.ids, self.scores, self.byte_ids)).encode()).hexdigest()
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.scores.values(), default=0) - UNKNOWN_PENALTY * SCALE
        inside = {p[i - 1] for p in self.ids for i in range(1, len(p)) if p[i] == MARK} - {MARK}
        if inside:
            raise ValueError("a piece has a space mark after another character; words would not be independent")
        covered = {c for p in self.ids for c in p}
        self.single = frozenset(covered & set(self.ids))
        # Characters that no piece has after one outside the set: words end before them, too.
        opens = {c for c in covered if not (c.isalpha() or c.isdecimal())} - {MARK}
        while True:
            after = {p[i] for p in self.ids for i in range(1, len(p)) if p[i] in opens and p[i - 1] not in opens | {MARK}}
            if not after:
                break
            opens -= after
        sort = lambda chars: "".join(map(re.escape, sorted(chars)))
        rest = covered - opens - {MARK}
        first, letters = (f"[{sort(opens)}]" if opens else "(?!)"), (f"[{sort(rest)}]" if rest else "(?!)")
        # a word, a run of spaces before nothing, or one character that no piece has
        self.words = re.compile(f"{MARK}*(?:{first}*{letters}+|{first}+)|{MARK}+|[^{sort(covered)}{MARK}]")

    def finder(self):
        """Automaton that lists the pieces in a word; built per task."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            found.add_word(piece, (len(piece), score))
        found.make_automaton()
        return found


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file with byte pieces.

    Scores of a unigram model are log probabilities and used as they are.
    A merge (BPE) model has whole-numbered scores that only rank pieces;
    rank r then counts as the log probability of a Zipf law, 1 / (r + 2)
    divided by the sum over all ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    ids, scores, byte_ids, texts = {}, {}, [0] * 256, []
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            texts.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            texts.append(piece.replace(MARK, " ").encode())
    if len(set(byte_ids)) < 256:
        raise ValueError("the model has no byte pieces; texts could not be given back exactly")
    if all(s == int(s) for s in scores.values()):
        order = sorted(scores, key=lambda p: (-scores[p], ids[p]))
        total = math.log(math.fsum(1.0 / (2.0 + rank) for rank in range(len(order))))
        scores = {p: -math.log(2.0 + rank) - total for rank, p in enumerate(order)}
    return Vocabulary(ids, {p: round(s * SCALE) for p, s in scores.items()}, byte_ids, texts)


def edges_of(word: str, vocab: Vocabulary, finder) -> list[tuple[int, int, int]]:
    """(begin, end, score) of every edge, by end."""
    edges = [(at + 1 - length, at + 1, score) for at, (length, score) in finder.iter(word)]
    if not vocab.single.issuperset(word):
        edges += [(i, i + 1, vocab.unknown) for i, c in enumerate(word) if c not in vocab.single]
        edges.sort(key=lambda e: e[1])
    return edges


def ids_of(word: str, begin: int, end: int, vocab: Vocabulary) -> list[int]:
    piece = vocab.ids.get(word[begin:end])
    return [piece] if piece is not None else [vocab.byte_ids[b] for b in word[begin:end].encode()]


def n_best(word: str, vocab: Vocabulary, finder, n: int) -> list[tuple[int, list[int]]]:
    """The ``n`` best (score, ids) of one word, best first; all, if fewer.
    Equal scores come in the order the search completes them, which is the
    same every time."""
    ends: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
    best: list = [0] + [-math.inf] * len(word)
    for begin, end, score in edges_of(word, vocab, finder):
        ends[end].append((begin, score))
        best[end] = max(best[end], best[begin] + score)
    # agenda: (-(best of the prefix + score of the suffix), position, number, score of the suffix, path).
    # Of equal sums the one nearer to the start goes first, so a tie is completed, not fanned out.
    made, out = 0, []
    agenda = [(-best[-1], len(word), 0, 0, None)]
    while agenda and len(out) < n:
        _, at, _, tail, path = heapq.heappop(agenda)
        if at == 0:
            ids: list[int] = []
            begin = 0
            while path is not None:
                end, path = path
                ids += ids_of(word, begin, end, vocab)
                begin = end
            out.append((tail, ids))
            continue
        for begin, score in ends[at]:
            made += 1
            heapq.heappush(agenda, (-(best[begin] + tail + score), begin, made, tail + score, (at, path)))
    return out


def best_and_loss(word: str, vocab: Vocabulary, finder) -> tuple[int, list[int], float]:
    """Score and ids of a word's best segmentation, and how much the
    second best scores less (infinity if there is none).

    Any other segmentation joins the best path by another edge; with the
    best prefix before that edge it loses what the edge loses at the
    position where it joins.  So the loss is the smallest gap between the
    two best ways into a position of the best path."""
    size = len(word)
    fore, other, came = [0] + [-math.inf] * size, [-math.inf] * (size + 1), [0] * (size + 1)
    for begin, end, score in edges_of(word, vocab, finder):  # by end, so the scores of all begins are final
        score += fore[begin]
        if score > fore[end]:
            fore[end], other[end], came[end] = score, fore[end], begin
        elif score > other[end]:
            other[end] = score
    path, end, loss = [], size, math.inf
    while end:
        loss = min(loss, fore[end] - other[end])
        path.append((came[end], end))
        end = came[end]
    return fore[size], [i for begin, end in reversed(path) for i in ids_of(word, begin, end, vocab)], loss


class WordSearch:
    """:func:`best_and_loss` for many words at once: the Viterbi steps of
    all words run together, one end position after the other."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        self.vocab = vocab
        pieces = list(vocab.ids)
        self.id = np.array([vocab.ids[p] for p in pieces], np.int32)
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.score = np.array([vocab.scores[p] for p in pieces], np.int64)
        # Pieces of one character are looked up by its code; the automaton finds the longer ones.
        single = sorted((ord(p), i) for i, p in enumerate(pieces) if len(p) == 1)
        self.point, self.of_point = (np.array(x, np.int64) for x in (zip(*single) if single else ((), ())))
        self.finder = ahocorasick.Automaton()
        for i, piece in enumerate(pieces):
            if len(piece) > 1:
                self.finder.add_word(piece, i)
        self.longer = len(self.finder) > 0
        if self.longer:
            self.finder.make_automaton()

    def run(self, words: list[str]) -> list[tuple[int, bytes, float]]:
        """(score, ids, loss) of each word; all characters are pieces."""
        score, ids, count, loss = self.columns(words)
        stop = 4 * np.cumsum(count)
        flat = ids.tobytes()
        return [(s, flat[f:t], l) for s, f, t, l in zip(score.tolist(), (stop - 4 * count).tolist(), stop.tolist(), loss.tolist())]

    def columns(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores, the ids of all words one after the other, their numbers
        and the losses."""
        size = np.array([len(w) for w in words], np.int64)
        # no piece covers the line end that parts the words
        text = "\n".join(words)
        found = np.fromiter(chain.from_iterable(self.finder.iter(text)) if self.longer else (), np.int64).reshape(-1, 2)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        one = np.flatnonzero(points != 10)
        at = np.concatenate([found[:, 0], one])
        piece = np.concatenate([found[:, 1], self.of_point[np.searchsorted(self.point, points[one])]])
        order = np.argsort(at, kind="stable")  # at each character the longest piece first
        at, piece = at[order], piece[order]
        word = np.repeat(np.arange(len(words)), size + 1)[at]
        end = at + 1 - (np.cumsum(size + 1) - (size + 1))[word]
        order = np.argsort(end.astype(np.uint16), kind="stable")  # by end, then word
        word, end, piece = word[order], end[order], piece[order]
        begin, score = end - self.length[piece], self.score[piece]
        wide = int(size.max()) + 1
        low = np.iinfo(np.int64).min // 4
        fore, gap = np.full((len(words), wide), low), np.full((len(words), wide), math.inf)
        via = np.zeros((len(words), wide), np.int64)
        fore[:, 0] = 0
        cut = np.searchsorted(end, np.arange(1, wide + 1))
        for lo, hi in zip(cut[:-1], cut[1:]):
            if lo == hi:
                continue
            total = fore[word[lo:hi], begin[lo:hi]] + score[lo:hi]
            start = np.flatnonzero(np.r_[True, word[lo + 1:hi] != word[lo:hi - 1]])
            owner = word[lo:hi][start]
            top = np.maximum.reduceat(total, start)
            hit = np.flatnonzero(total == np.repeat(top, np.diff(np.r_[start, hi - lo])))
            _, one = np.unique(word[lo:hi][hit], return_index=True)  # of equal bests, the first
            hit = hit[one]
            total[hit] = low
            second = np.maximum.reduceat(total, start)
            fore[owner, end[lo]], via[owner, end[lo]] = top, hit + lo
            gap[owner, end[lo]] = np.where(second > low, top - second, math.inf)
        live, place = np.arange(len(words)), size.copy()
        loss = np.full(len(words), math.inf)
        steps = []
        while len(live):
            loss[live] = np.minimum(loss[live], gap[live, place[live]])
            edge = via[live, place[live]]
            steps.append((live, self.id[piece[edge]]))
            place[live] = begin[edge]
            live = live[place[live] > 0]
        owner = np.concatenate([w for w, _ in steps])
        turn = np.repeat(np.arange(len(steps)), [len(w) for w, _ in steps])
        ids = np.concatenate([i for _, i in steps])[np.lexsort((-turn, owner))]
        return fore[np.arange(len(words)), size], ids, np.bincount(owner, minlength=len(words)), loss


def gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``start``, one after the other."""
    shift = start - (np.cumsum(count) - count)
    return flat[np.repeat(shift, count) + np.arange(int(count.sum()))]


class Segmenter:
    """N-best segmentation of whole texts, with a bounded table of words:
    best score, loss of the second best, and where the ids of the best
    stand in ``flat``.  Row 0 is a mark that stands in a text itself."""

    def __init__(self, vocab: Vocabulary, n: int = N_BEST):
        self.vocab, self.n, self.finder = vocab, n, vocab.finder()
        self.search = WordSearch(vocab)
        self.lists: dict[str, list[tuple[int, np.ndarray]]] = {}
        forced = np.array([vocab.byte_ids[b] for b in MARK.encode()], np.int32)
        self.row: dict[str | None, int] = {None: 0}
        self.score, self.loss = np.array([3 * vocab.unknown], np.int64), np.array([math.inf])
        self.start, self.count, self.flat = np.array([0]), np.array([len(forced)]), forced
        self.hits = np.ones(1, np.int64)    # calls that met the word since the table was last thinned

    def learn(self, words: set[str]) -> list[str]:
        """Put words that are not in the table there; returns those that are
        too long to stay beyond the call."""
        single, plain, other = self.vocab.single, [], []
        for w in words:
            (plain if len(w) <= CACHE_CHARS and single.issuperset(w) else other).append(w)
        plain.sort(key=len)  # words of one length take the same steps
        parts = [self.search.columns(plain[at:at + CHUNK_WORDS]) for at in range(0, len(plain), CHUNK_WORDS)]
        for w in other:
            score, ids, loss = best_and_loss(w, self.vocab, self.finder)
            parts.append((np.array([score], np.int64), np.array(ids, np.int32), np.array([len(ids)]), np.array([loss])))
        score, flat, count, loss = (np.concatenate(x) for x in zip(*parts))
        self.row.update(zip(plain + other, range(len(self.score), len(self.score) + len(score))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
        self.score, self.flat = np.concatenate([self.score, score]), np.concatenate([self.flat, flat])
        self.count, self.loss = np.concatenate([self.count, count]), np.concatenate([self.loss, loss])
        self.hits = np.concatenate([self.hits, np.zeros(len(score), np.int64)])
        return [w for w in other if len(w) > CACHE_CHARS]

    def _thin(self) -> None:
        """Keep the words of a full table that were met in most calls, at
        most ``CACHE_WORDS`` and none that was met in one call only."""
        live = np.zeros(len(self.hits), bool)
        live[np.fromiter(self.row.values(), np.int64, len(self.row))] = True
        bar = 1
        while (keep := live & (self.hits > bar)).sum() > CACHE_WORDS:
            bar *= 2
        keep[0] = True
        place = np.cumsum(keep) - 1
        names, rows = list(self.row), np.fromiter(self.row.values(), np.int64, len(self.row))
        self.row = {names[i]: int(place[rows[i]]) for i in np.flatnonzero(keep[rows]).tolist()}
        self.flat = gather(self.flat, self.start[keep], self.count[keep])
        self.score, self.loss, self.count = self.score[keep], self.loss[keep], self.count[keep]
        self.start, self.hits = np.cumsum(self.count) - self.count, np.ones(len(self.count), np.int64)

    def rows_of(self, words: list[str | None]) -> np.ndarray:
        """Table rows of words, learnt where they are new; valid until the
        next call."""
        if len(self.hits) > 2 * CACHE_WORDS or len(self.flat) > CACHE_CHARS * CACHE_WORDS:
            self._thin()
        rows = np.fromiter(map(self.row.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0).tolist()
        if new:
            names = [words[i] for i in new]
            long = self.learn(set(names))
            rows[new] = np.fromiter(map(self.row.__getitem__, names), np.int64, len(names))
            for w in long:
                del self.row[w]
        met = np.zeros(len(self.hits), bool)
        met[rows] = True
        self.hits += met
        return rows

    def options(self, word: str) -> list[tuple[int, np.ndarray]]:
        """The N best (score, ids) of a word that may deviate."""
        found = self.lists.get(word)
        if found is None:
            found = [(s, np.array(ids, np.int32)) for s, ids in n_best(word, self.vocab, self.finder, self.n)]
            if len(word) <= CACHE_CHARS:
                if len(self.lists) >= CACHE_WORDS:
                    self.lists.clear()
                self.lists[word] = found
        return found

    def words(self, text: str) -> list[str | None]:
        """The words of a text.  A mark that stands in the text itself is not
        a space and is spelt in bytes; it is None."""
        find, parts = self.vocab.words.findall, text.split(MARK)
        out = find(MARK + parts[0].replace(" ", MARK))
        for part in parts[1:]:
            out.append(None)
            out += find(part.replace(" ", MARK))
        return out

    def segment_all(self, texts: list[str]) -> list[list[tuple[float, np.ndarray]]]:
        """The N best (score, ids) of each whole text, best first."""
        if not texts:
            return []
        split = list(map(self.words, texts))
        words = list(chain.from_iterable(split))
        rows = self.rows_of(words)
        stop = np.cumsum([len(w) for w in split])
        first = stop - [len(w) for w in split]
        base = np.add.reduceat(self.score[rows], first).tolist()    # every text has a word
        count, loss = self.count[rows], self.loss[rows]
        ids, at = gather(self.flat, self.start[rows], count), np.r_[0, np.cumsum(count)]
        return [self._best(b, words, loss, ids, at, f, t)
                for b, f, t in zip(base, first.tolist(), stop.tolist())]

    def segment(self, text: str) -> list[tuple[float, np.ndarray]]:
        return self.segment_all([text])[0]

    def _best(self, base: int, words: list, loss: np.ndarray, ids: np.ndarray, at_id: np.ndarray,
              first: int, stop: int) -> list[tuple[float, np.ndarray]]:
        """The N best of the chain of words from ``first`` to ``stop``;
        ``ids`` holds the best of every word, ``at_id`` where it begins."""
        near: list[int] = []
        if self.n > 1:
            loss = loss[first:stop]
            at = np.argsort(loss, kind="stable")[:self.n - 1] if len(loss) < 64 else self._smallest(loss)
            near = sorted(first + int(i) for i in at if math.isfinite(loss[i]))
        options = [self.options(words[i]) for i in near]
        cuts = [(int(at_id[i]), int(at_id[i + 1])) for i in near]

        def joined(choice: dict[int, int]) -> np.ndarray:
            """The best ids with the given options at the words ``near``."""
            parts, begin = [], int(at_id[first])
            for i, (lo, hi) in enumerate(cuts):
                parts += [ids[begin:lo], options[i][choice.get(i, 0)][1]]  # of equal bests, the one the list begins with
                begin = hi
            return np.concatenate([*parts, ids[begin:int(at_id[stop])]])

        out = [(base / SCALE, joined({}))]
        # A-star backwards over the words that may deviate, all others at their best
        agenda, made = [(0, len(near), 0, ())], 0
        found: list[tuple[int, tuple]] = []
        while agenda and len(found) < self.n:
            cost, at, _, picks = heapq.heappop(agenda)
            if at == 0:
                found.append((cost, picks))
                continue
            for r, (score, _) in enumerate(options[at - 1]):
                made += 1
                heapq.heappush(agenda, (cost + options[at - 1][0][0] - score, at - 1, made,
                                        ((at - 1, r),) + picks if r else picks))
        return out + [((base - cost) / SCALE, joined(dict(picks))) for cost, picks in found[1:]]

    def _smallest(self, loss: np.ndarray) -> np.ndarray:
        """Positions of the n - 1 smallest losses, ties to the front."""
        bar = np.partition(loss, self.n - 2)[self.n - 2]
        below = np.flatnonzero(loss < bar)
        return np.concatenate([below, np.flatnonzero(loss == bar)[:self.n - 1 - len(below)]])


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> str:
    return b"".join(map(vocab.texts.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


_in_worker: dict[tuple[str, int], Segmenter] = {}


def worker_segmenter(vocab: Vocabulary, n: int) -> Segmenter:
    """The segmenter of this Python worker; its table of words serves all
    tasks that run here with the same vocabulary."""
    key = (vocab.digest, n)
    if key not in _in_worker:
        _in_worker.clear()
        _in_worker[key] = Segmenter(vocab, n)
    return _in_worker[key]


def encode(docs: DataFrame, model: str = MODEL, n: int = N_BEST, id_col: str = "doc_id",
           text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the columns ``carry``,
    ``ids`` and ``score`` of the best segmentation, and ``nbest``: score
    and ids of the ``n`` best, the first included; fewer where the text has
    fewer.

    Null text is empty; an empty text is the single space mark.  Whole
    texts of any length; a word longer than the cache's limit is segmented
    anew each time.  Repeated rows give repeated result rows; other columns
    are ignored.  ``model`` is read on the driver."""
    vocab = load_vocabulary(model)

    def run(batches):
        segmenter = worker_segmenter(vocab, n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # ids of a few rows at a time
                part = batch.slice(at, 256)
                rows = segmenter.segment_all(part.column(0).to_pylist())
                pair = pa.StructArray.from_arrays([pa.array([s for r in rows for s, _ in r], pa.float64()),
                                                   _lists([ids for r in rows for _, ids in r])], ["score", "ids"])
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pair)],
                    [*part.schema.names[1:], "nbest"])

    kept = [f"k{i}" for i in range(1 + len(carry))]
    narrow = docs.select(text_of(docs, text_col).alias("text"),
                         *[docs[c].alias(k) for k, c in zip(kept, [id_col, *carry])])
    best = T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()),
                                     T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    out = narrow.mapInArrow(run, T.StructType([*narrow.schema.fields[1:], T.StructField("nbest", best)]))
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, [id_col, *carry])],
                      F.col("nbest")[0]["ids"].alias("ids"), F.col("nbest")[0]["score"].alias("score"), "nbest")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _decoded(lists: pa.ListArray, pieces: pa.LargeBinaryArray, vocab: Vocabulary) -> pa.Array:
    """Texts of lists of ids: the bytes of all pieces stand one after the
    other, a text begins after the mark in front of its first piece."""
    parts = pieces.take(lists.flatten())
    _, offsets, data = parts.buffers()
    begin = np.frombuffer(offsets, np.int64)[parts.offset:parts.offset + len(parts) + 1]
    size = pac.fill_null(pac.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    at_row = begin[np.r_[0, np.cumsum(size, dtype=np.int64)]]
    marks = at_row[:-1][np.diff(at_row) > 0]
    whole = np.delete(np.frombuffer(data, np.uint8), marks) if len(marks) else np.empty(0, np.uint8)
    at_row = at_row - np.searchsorted(marks, at_row)
    null = pac.is_null(lists).to_numpy(zero_copy_only=False)
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [
        pa.py_buffer(np.packbits(~null, bitorder="little")), pa.py_buffer(at_row), pa.py_buffer(whole)])
    try:
        return texts.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:     # bytes that are no text are replaced
        return pa.array([decode_ids(x.values.to_numpy(zero_copy_only=False), vocab) if x.is_valid else None for x in lists],
                        pa.string())


def decode(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids_col`` in ``out_col`` (replaced if
    there is such a column); null ids decode to null."""
    vocab = load_vocabulary(model)
    rest = encoded.drop(out_col)
    at = rest.columns.index(ids_col)
    schema = T.StructType([*rest.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        pieces = pa.array(vocab.texts, pa.large_binary())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(batch.column(at), pieces, vocab)],
                                             [*batch.schema.names, out_col])

    return rest.mapInArrow(run, schema)
