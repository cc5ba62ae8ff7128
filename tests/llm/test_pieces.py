"""N-best segmentation against brute force; exact round trips."""
import itertools
import math
import random

import numpy as np
import pytest

from starledger.llm import pieces as pc


@pytest.fixture(scope="module")
def vocab():
    return pc.load_vocabulary(pc.MODEL)


def small():
    rnd = random.Random(8)
    pool = [pc.MARK, "a", "b", "c", "ab", "bc", "abc", "ca", pc.MARK + "a", pc.MARK + "ab", "bca", pc.MARK * 2]
    scores = {p: -round((rnd.random() * 5 + 1) * 1000) * 1000 for p in pool}
    texts = [bytes([b]) for b in range(256)] + [p.replace(pc.MARK, " ").encode() for p in pool]
    return pc.Vocabulary({p: 256 + i for i, p in enumerate(pool)}, scores, list(range(256)), texts)


def brute(text, vocab):
    """All segmentations of the whole text: (score, ids)."""
    whole = [(pc.MARK if c == " " else c, c == pc.MARK) for c in " " + text]

    def rest(at):
        if at == len(whole):
            return [(0.0, ())]
        out = []
        for end in range(at + 1, min(len(whole), at + vocab.longest) + 1):
            piece = "".join(c for c, _ in whole[at:end])
            if not any(literal for _, literal in whole[at:end]) and piece in vocab.ids:
                out += [(vocab.scores[piece] + s, (vocab.ids[piece], *t)) for s, t in rest(end)]
        char, literal = whole[at]
        if literal or char not in vocab.ids:
            cost = vocab.unknown * (3 if literal else 1)
            out += [(cost + s, (*[vocab.byte_ids[b] for b in char.encode()], *t)) for s, t in rest(at + 1)]
        return out
    return sorted(rest(0), key=lambda x: -x[0])


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_n_best_matches_all_segmentations(n):
    vocab = small()
    rnd = random.Random(n)
    for _ in range(120):
        text = "".join(rnd.choice("abc  é" + pc.MARK) for _ in range(rnd.randrange(9)))
        got, want = pc.Segmenter(vocab, n).segment(text), brute(text, vocab)
        assert len(got) == min(n, len(want)), text
        assert [s for s, _ in got] == pytest.approx([s / pc.SCALE for s, _ in want[:n]]), text
        scores = dict((t, s / pc.SCALE) for s, t in want)
        assert len({tuple(i.tolist()) for _, i in got}) == len(got)
        for s, ids in got:
            assert scores[tuple(ids.tolist())] == pytest.approx(s)
            assert pc.decode_ids(ids, vocab) == text


TEXTS = ["", " ", "Hello  world\n", "tabs\tand\r\nlines", "ünïcödé ß 漢字 😀", pc.MARK, f"a{pc.MARK}b {pc.MARK}{pc.MARK} c",
         "a" * 5000, "x" * 70000, "ab" * 20000, " " * 1000, "\x00\x01", "<0x41><s></s><unk>", "x " * 5000, "٣‎⁠"]


def test_real_vocabulary_round_trips(vocab):
    segmenter = pc.Segmenter(vocab, 3)
    for text in TEXTS:
        got = segmenter.segment(text)
        assert all(pc.decode_ids(ids, vocab) == text for _, ids in got)
        assert all(a >= b - 1e-6 for (a, _), (b, _) in itertools.pairwise(got))


def test_cheap_words_are_not_split(vocab):
    (_, ids), *_ = pc.Segmenter(vocab, 1).segment("the house")
    assert [vocab.texts[i] for i in ids] == [b" the", b" house"]


def test_best_score_is_viterbi(vocab):
    for word in ["▁internationalisation", "▁zzxqj", "ааа"]:
        (score, ids), *_ = pc.n_best(word, vocab, vocab.finder(), 1)
        back = {i: p for p, i in vocab.ids.items()}
        assert "".join(back[i] for i in ids) == word
        assert score == sum(vocab.scores[back[i]] for i in ids)
        assert not math.isinf(score)


def test_loss_is_that_of_the_second_best():
    vocab, rnd = small(), random.Random(3)
    finder = vocab.finder()
    for _ in range(300):
        word = pc.MARK * rnd.randrange(3) + "".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 9)))
        score, ids, loss = pc.best_and_loss(word, vocab, finder)
        two = pc.n_best(word, vocab, finder, 2)
        assert score == pytest.approx(two[0][0]) and sum(len(vocab.texts[i]) for i in ids) == len(word.replace(pc.MARK, " ").encode())
        assert loss == (pytest.approx(two[0][0] - two[1][0]) if len(two) > 1 else math.inf)


def test_many_words_at_once_equal_one_by_one(vocab):
    rnd = random.Random(11)
    for v, letters in ((small(), "abc"), (vocab, "aeinrstho")):
        words = {pc.MARK * rnd.randrange(3) + "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 20))) for _ in range(500)}
        words = sorted(words)
        finder = v.finder()
        for w, (score, ids, loss) in zip(words, pc.WordSearch(v).run(words)):
            want = pc.best_and_loss(w, v, finder)
            assert (score, loss) == (want[0], want[2])
            assert b"".join(v.texts[i] for i in np.frombuffer(ids, np.int32)) == w.replace(pc.MARK, " ").encode()


def test_equal_scores_are_listed_once():
    pool = {p: -1_000_000 for p in ["a", "aa", "aaa", pc.MARK]}
    v = pc.Vocabulary({p: 256 + i for i, p in enumerate(pool)}, pool, list(range(256)),
                      [bytes([b]) for b in range(256)] + [p.replace(pc.MARK, " ").encode() for p in pool])
    got = pc.Segmenter(v, 6).segment("aaaa aaaa")
    assert len({tuple(i.tolist()) for _, i in got}) == 6
    assert [s for s, _ in got] == pytest.approx([s / pc.SCALE for s, _ in brute("aaaa aaaa", v)[:6]])


def test_spark_encode_decode_with_edge_rows(spark, vocab):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (5, None, "x", 1), (0, "", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, score int")
    enc = pc.encode(docs)
    got = pc.decode(enc).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t, *_ in rows)
    local = pc.Segmenter(vocab, 3)
    for r in got:
        want = local.segment(r.decoded)
        assert [list(x.ids) for x in r.nbest] == [i.tolist() for _, i in want] and list(r.ids) == want[0][1].tolist()
        assert np.allclose([x.score for x in r.nbest], [s for s, _ in want])
    assert pc.encode(docs.limit(0)).count() == 0
