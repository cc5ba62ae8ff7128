"""Alignment of the tokens that two tokenizers make of the same texts.

A is a byte-level BPE of the ``tokenizers`` library, B a SentencePiece
model; both read a space and the text.  The spans that the libraries give
are coarse cuts: A's character offsets, mapped to bytes, and the spans of
B's proto (the immutable proto of older versions; versions without it call
the same spans ``proto``, in bytes of the text).  They are exact for tokens
of whole characters.  Tokens that hold parts of a character, and byte
pieces, carry their character's span; their ends are refined by the lengths
of their decoded bytes.  Where tokens of A and B end at the same byte, a
group ends and the two tokens are linked.

Both tokenizers work word by word where a text has a single space between
two other characters: A's pattern starts a match there, and no piece of B
has a space mark after another character.  A worker aligns each distinct
word once and keeps the recent ones; tokenizers for which that does not
hold get whole texts.

Links are counted over the corpus by (A id, B id).  Tokens that end
together are each other's suffixes, so there are no more pairs than the two
vocabularies have such suffixes: a bound that is computed before the counts
are handed to all tasks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import pack_steps, text_of, unpack_steps

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_WORDS = 250_000      # of each of the two generations a worker keeps
BLOCK_WORDS = 512          # new words that go through the tokenizers as one text
CACHE_CHARS = 64           # longer words are aligned each time
BATCH_CHARS = 1_000_000    # of texts aligned together
MAX_PAIRS = 4_000_000      # linked pairs that tasks may get; 13 bytes each

# Characters that some tokenizer may take for white space, or that mean a space to B.
_BLANK = {*range(0x21), *range(0x7F, 0xA1), 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2070), 0x3000, 0xFEFF,
          ord(MARK)}
_SOLID = np.array([i not in _BLANK and not chr(i).isspace() for i in range(1 << 16)])


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible
    Latin-1 characters stand for themselves, the other bytes, in order, are
    the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """Both models as read on the driver; small, and shipped to tasks."""

    byte_model: str
    piece_model: bytes

    @classmethod
    def read(cls, byte_path: str, piece_path: str) -> Tokenizers:
        with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
            return cls(a.read(), b.read())

    def load(self):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # Spark runs the tasks side by side
        a = Tokenizer.from_str(self.byte_model)
        a.encode_special_tokens = True
        return a, sentencepiece.SentencePieceProcessor(model_proto=self.piece_model)

    def token_bytes(self) -> tuple[list[bytes], list[bytes]]:
        """What each id of A and of B stands for."""
        a, b = self.load()
        letters = byte_alphabet()
        size = max(a.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        of_a = [b""] * size
        for token, i in a.get_vocab(with_added_tokens=False).items():
            of_a[i] = bytes(letters[c] for c in token)
        of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode()
                for i, p in enumerate(map(b.id_to_piece, range(b.get_piece_size())))]
        return of_a, of_b

    def by_word(self) -> bool:
        """Whether both work word by word."""
        from sentencepiece import sentencepiece_model_pb2

        a = json.loads(self.byte_model)
        before = a.get("pre_tokenizer") or {}
        if a.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
            return False
        b = sentencepiece_model_pb2.ModelProto.FromString(self.piece_model)
        rule = b.normalizer_spec
        inner = any(MARK in p.piece.lstrip(MARK) for p in b.pieces)
        return not inner and not rule.precompiled_charsmap and not rule.remove_extra_whitespaces and rule.add_dummy_prefix

    def most_pairs(self) -> int:
        """Pairs of ids of which one's bytes are a suffix of the other's."""
        of_a, of_b = self.token_bytes()
        count: dict[bytes, list[int]] = {}
        for side, tokens in enumerate((of_a, of_b)):
            for t in tokens:
                count.setdefault(t, [0, 0])[side] += 1
        none = [0, 0]
        return sum(sum(n[0] * count.get(t[k:], none)[1] for k in range(len(t)))
                   + sum(n[1] * count.get(t[k:], none)[0] for k in range(1, len(t))) for t, n in count.items())


class Aligner:
    """Both tokenizers in one worker, and its recent words."""

    def __init__(self, models: Tokenizers, cut: bool):
        self.a, self.b = models.load()
        self.bytes_a, self.bytes_b = models.token_bytes()
        self.cut = cut
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.whole_a, self.whole_b = (np.array([_whole(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        self.whole_b &= np.array([not self.b.is_byte(i) for i in range(len(self.bytes_b))], bool)
        # how a token is written: within its side's list, and as the last of it
        names = [f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
        names += [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"]
        self.names = np.array(names, object)
        self.code = np.uint32 if len(self.bytes_a) * len(self.bytes_b) < 1 << 32 else np.uint64
        self.some_bad = False      # whether any word's bytes did not come back so far
        self.recent: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    def words(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """The words of all texts, and how many of them each text has."""
        if not self.cut:
            return [t for t in texts if t], [int(bool(t)) for t in texts]
        joined = "\n".join(texts)     # no cut touches a line end
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        solid = _SOLID[np.minimum(points, 0xFFFF)]
        cut = np.flatnonzero((points[1:-1] == 32) & solid[:-2] & solid[2:]) + 1
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size + 1) - size - 1
        full = size > 0
        starts = np.sort(np.concatenate([begin[full], cut + 1]))
        ends = np.sort(np.concatenate([(begin + size)[full], cut]))
        count = np.searchsorted(starts, begin + size) - np.searchsorted(starts, begin)
        return [joined[i:j] for i, j in zip(starts.tolist(), ends.tolist())], count.tolist()

    def align(self, texts: list[str]) -> list[tuple[str, int, int, bytes] | None]:
        """(groups, tokens of A, tokens of B, linked pairs as codes) of each
        text; None where the joined bytes of either side differ from the
        text's."""
        words, count = self.words(texts)
        entries = list(map(self.recent.get, words))
        if None in entries:
            found = self._fetch({w for w, e in zip(words, entries) if e is None})
            entries = [found[w] if e is None else e for w, e in zip(words, entries)]
        out, at = [], 0
        for n in count:
            own = entries[at:at + n]
            at += n
            if not own or self.some_bad and any(e is _BAD for e in own):
                out.append(None)
                continue
            made = sum([e[1] for e in own])
            out.append(("".join([e[0] for e in own])[:-1], made >> 32, made & 0xFFFFFFFF, b"".join([e[2] for e in own])))
        return out

    def _fetch(self, words: set[str]) -> dict[str, tuple[str, int, bytes]]:
        """Entries of words that are not among the recent ones: groups, both
        numbers of tokens in one, codes of the linked pairs."""
        found = {w: e for w in words if (e := self.older.get(w)) is not None}
        new = [w for w in words if w not in found]
        # Words with solid ends don't touch each other behind single spaces, so many go through the tokenizers as one text.
        together = [w for w in new if self.cut and all(ord(c) > 0xFFFF or _SOLID[ord(c)] for c in (w[0], w[-1]))]
        alone = [[w] for w in set(new).difference(together)]
        blocks = [together[i:i + BLOCK_WORDS] for i in range(0, len(together), BLOCK_WORDS)]
        for block, entries in zip(blocks, self._entries(blocks)):
            if entries is None:
                alone += [[w] for w in block]
            else:
                found.update(zip(block, entries))
        for (w,), entries in zip(alone, self._entries(alone)):
            found[w] = entries[0] if entries else _BAD
            self.some_bad |= not entries
        if len(self.recent) + len(found) > CACHE_WORDS:
            self.older, self.recent = self.recent, {}
        self.recent.update((w, e) for w, e in found.items() if len(w) <= CACHE_CHARS)
        return found

    def _entries(self, blocks: list[list[str]]) -> list[list[tuple[str, int, bytes]] | None]:
        """Entries of the words of each block; None if the block's bytes
        don't come back, or its words are not apart."""
        if not blocks:
            return []
        texts = ["".join([f" {w}" for w in block]) for block in blocks]
        joined = "".join(texts)
        raw = joined.encode("utf-8", "surrogatepass")
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        char_at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        begin = place[char_at]     # byte at which each block starts; one more for the end
        word_begin = place[np.cumsum([0] + [len(w) + 1 for block in blocks for w in block])]
        word_at = np.cumsum([0] + [len(block) for block in blocks])

        made = self.a.encode_batch(texts, add_special_tokens=False)
        ids = [e.ids for e in made]
        n_a = np.array([len(i) for i in ids], np.int64)
        a = np.fromiter(chain.from_iterable(ids), np.int64, n_a.sum())
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in made)), np.int64, 2 * len(a))
        of_a = np.repeat(np.arange(len(blocks)), n_a)
        ok = _same(self.bytes_a, a, n_a, raw, begin)
        end_a = np.where(self.whole_a[a], place[char_at[of_a] + spans[1::2]], _decoded(self.size_a[a], of_a, n_a, begin))

        made = [p.pieces for p in self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1)]
        n_b = np.array([len(p) for p in made], np.int64)
        made = list(chain.from_iterable(made))
        b = np.fromiter(map(attrgetter("id"), made), np.int64, len(made))
        spans = np.fromiter(map(attrgetter("end"), made), np.int64, len(made))
        of_b = np.repeat(np.arange(len(blocks)), n_b)
        ok &= _same(self.bytes_b, b, n_b, raw, begin)
        end_b = np.where(self.whole_b[b], begin[of_b] + 1 + spans, _decoded(self.size_b[b], of_b, n_b, begin))

        if not ok.all():
            a, end_a, b, end_b = *(x[ok[of_a]] for x in (a, end_a)), *(x[ok[of_b]] for x in (b, end_b))
        meet_a, meet_b = _in(end_a, end_b), _in(end_b, end_a)
        cuts = end_a[meet_a]
        apart = _in(word_begin, np.concatenate([[0], cuts]))     # every word's start is where one before ended
        for k in np.flatnonzero(ok).tolist():
            ok[k] = apart[word_at[k] + 1:word_at[k + 1]].all() and (begin[k + 1] == cuts[np.searchsorted(cuts, begin[k + 1])])
        pairs = (a[meet_a] * len(self.bytes_b) + b[meet_b]).astype(self.code).tobytes()
        pair_at = (np.dtype(self.code).itemsize * np.searchsorted(cuts, word_begin, "right")).tolist()
        group = np.concatenate([2 * (np.cumsum(meet_a) - meet_a), 2 * (np.cumsum(meet_b) - meet_b) + 1])
        name = np.concatenate([2 * a + meet_a, 2 * (len(self.bytes_a) + b) + meet_b])
        written = self.names[name[np.argsort(group, kind="stable")]].tolist()
        upto_a, upto_b = np.searchsorted(end_a, word_begin, "right"), np.searchsorted(end_b, word_begin, "right")
        at = (upto_a + upto_b).tolist()
        both = ((np.diff(upto_a) << 32) + np.diff(upto_b)).tolist()
        return [[("".join(written[at[k]:at[k + 1]]), both[k], pairs[pair_at[k]:pair_at[k + 1]])
                 for k in range(word_at[i], word_at[i + 1])] if good else None for i, good in enumerate(ok.tolist())]


#: The entry of a word whose bytes do not come back.
_BAD = ("", 0, b"")


def _whole(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def _decoded(sizes: np.ndarray, owner: np.ndarray, n: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Ends of tokens by the lengths of their bytes, from their word's start."""
    total = np.cumsum(sizes)
    before = np.concatenate([[0], total])[np.cumsum(n) - n]
    return total - before[owner] + begin[owner]


def _same(table: list[bytes], ids: np.ndarray, n: np.ndarray, raw: bytes, begin: np.ndarray) -> np.ndarray:
    """Which words' tokens give their bytes back; none of a token without bytes."""
    parts = [table[i] for i in ids.tolist()]
    if b"".join(parts) == raw and all(parts):
        size = np.array([0, *map(len, parts)], np.int64).cumsum()
        if np.array_equal(size[np.concatenate([[0], np.cumsum(n)])], begin):
            return np.ones(len(n), bool)
    at = np.concatenate([[0], np.cumsum(n)]).tolist()
    place = begin.tolist()
    return np.array([b"".join(parts[at[k]:at[k + 1]]) == raw[place[k]:place[k + 1]] and all(parts[at[k]:at[k + 1]])
                     for k in range(len(n))], bool)


def _in(these: np.ndarray, those: np.ndarray) -> np.ndarray:
    """Which of ``these`` are among ``those``; both ascending."""
    if not len(those):
        return np.zeros(len(these), bool)
    at = np.minimum(np.searchsorted(those, these), len(those) - 1)
    return those[at] == these


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(models: Tokenizers, cut: bool) -> Aligner:
    """One per worker process; workers run many tasks."""
    key = hash((models.byte_model, models.piece_model, cut))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(models, cut)
    return _ALIGNERS[key]


def _portions(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about ``BATCH_CHARS`` characters, and their texts."""
    begin, held, many = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        held.append(text.as_py())
        many += len(held[-1])
        if many >= BATCH_CHARS:
            yield batch.slice(begin, len(held)), held
            begin, held, many = i + 1, [], 0
    if held:
        yield batch.slice(begin, len(held)), held


def alignments(docs: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_a`` and ``n_b`` tokens,
    ``n_groups``, ``groups`` (`a1,a2|b1;a3|b2,b3`: ids in order, groups cut
    where tokens of both end) and ``pairs`` (the linked ids, packed for
    :func:`link_counts`).

    Null and empty texts, and texts that the joined tokens of A or B do not
    give back after a space, have no tokens: zeros and an empty string.
    Whole texts of any length; repeated rows give repeated rows; other
    columns are ignored.  Both models are read on the driver."""
    models = Tokenizers.read(byte_model, piece_model)
    cut = models.by_word()
    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches):
        aligner = _aligner(models, cut)
        for batch in batches:
            for part, texts in _portions(batch, 1):
                rows = [r or ("", 0, 0, b"") for r in aligner.align(texts)]
                codes = [np.frombuffer(p, aligner.code) for *_, p in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([len(c) for c in codes], pa.int64()), pa.array([r[0] for r in rows], pa.string()),
                     pa.array([pack_steps(np.sort(c)) for c in codes], pa.binary())],
                    ["id", "n_a", "n_b", "n_groups", "groups", "pairs"])

    out = narrow.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, groups string, pairs binary")
    return out.withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """(code, n): links of the whole of ``aligned`` by pair of ids; a code
    is A's id times the size of B's vocabulary, plus B's id."""
    kind = _code(Tokenizers.read(byte_model, piece_model))[0]

    def run(batches):
        held, many = [], 0
        for batch in batches:
            for pairs in batch.column(0):
                held.append(unpack_steps(pairs.as_py(), kind))
                many += len(held[-1])
                if many >= 1 << 22:
                    yield _summed(held)
                    held, many = [], 0
        if held:
            yield _summed(held)

    return aligned.select("pairs").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _summed(held: Iterable[np.ndarray]) -> pa.RecordBatch:
    codes, n = np.unique(np.concatenate(list(held)), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], ["code", "n"])


def _code(models: Tokenizers) -> tuple[type, int]:
    of_a, of_b = models.token_bytes()
    return (np.uint32 if len(of_a) * len(of_b) < 1 << 32 else np.uint64), len(of_b)


def link_counts(aligned: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """``aligned`` (written or cheap to read twice) without ``pairs``, with
    ``n_links``, ``n_best`` (links whose corpus-wide count is the highest
    of their B id) and ``count_sum`` (of the counts over links)."""
    models = Tokenizers.read(byte_model, piece_model)
    most = models.most_pairs()
    if most > MAX_PAIRS:
        raise ValueError(f"these vocabularies could link {most} pairs, more than the {MAX_PAIRS} tasks may get")
    kind, size_b = _code(models)
    counted = pair_counts(aligned, byte_model, piece_model).toArrow()     # at most ``most`` rows
    codes, counts = (counted.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(codes)
    codes, counts = codes[order].astype(kind), counts[order].astype(np.int64)
    of_b = (codes % kind(size_b)).astype(np.int64)
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, of_b, counts)
    best = counts == highest[of_b]
    at = aligned.columns.index("pairs")
    rest = aligned.drop("pairs")
    names = [*rest.columns, "n_links", "n_best", "count_sum"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)

    def run(batches):
        for batch in batches:
            found = [np.searchsorted(codes, unpack_steps(p.as_py(), kind)) for p in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(batch.columns) if i != at), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([int(best[f].sum()) for f in found], pa.int64()),
                 pa.array([int(counts[f].sum()) for f in found], pa.int64())],
                names)

    return aligned.mapInArrow(run, f"{schema}, n_links long, n_best long, count_sum long")
