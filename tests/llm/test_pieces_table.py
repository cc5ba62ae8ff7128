"""The bounded table of words, and decoding by blocks."""
import random

import numpy as np
import pyarrow as pa
import pytest

from starledger.llm import pieces as pc
from tests.llm.test_pieces import TEXTS, small


@pytest.mark.parametrize("limit", [1, 7, 100_000])
def test_results_do_not_depend_on_what_the_table_holds(monkeypatch, limit):
    monkeypatch.setattr(pc, "CACHE_WORDS", limit)
    vocab, rnd = small(), random.Random(limit)
    texts = [" ".join("".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 7))) for _ in range(rnd.randrange(12)))
             + rnd.choice(["", pc.MARK, "a" * 90]) for _ in range(150)]
    segmenter = pc.Segmenter(vocab, 3)
    for at in range(0, len(texts), 10):
        part = texts[at:at + 10] + texts[:3]
        for text, got in zip(part, segmenter.segment_all(part)):
            want = pc.Segmenter(vocab, 3).segment(text)
            assert [(s, i.tolist()) for s, i in got] == [(s, i.tolist()) for s, i in want]
        assert all(w is None or len(w) <= pc.CACHE_CHARS for w in segmenter.row)
        if limit < 10:
            assert len(segmenter.row) <= 2 * limit + 200     # what one call brings stays until the next
    assert segmenter.segment_all([]) == []


def test_blocks_decode_like_single_lists():
    vocab = pc.load_vocabulary(pc.MODEL)
    segmenter = pc.Segmenter(vocab, 1)
    lists = [segmenter.segment(t)[0][1].tolist() for t in TEXTS]
    pieces = pa.array(vocab.texts, pa.large_binary())
    mixed = pa.array([None, [], *lists, [], None], pa.list_(pa.int32()))
    want = [None, "", *TEXTS, "", None]
    assert pc._decoded(mixed, pieces, vocab).to_pylist() == want
    assert pc._decoded(mixed.slice(3, 4), pieces, vocab).to_pylist() == want[3:7]
    assert pc._decoded(mixed.slice(0, 0), pieces, vocab).to_pylist() == []
    assert pc._decoded(mixed.slice(0, 2), pieces, vocab).to_pylist() == [None, ""]
    broken = [vocab.byte_ids[32], vocab.byte_ids[0xC3], vocab.byte_ids[65]]     # bytes that are no text
    got = pc._decoded(pa.array([lists[2], broken], pa.list_(pa.int32())), pieces, vocab).to_pylist()
    assert got == [TEXTS[2], pc.decode_ids(np.array(broken), vocab)]


def test_a_worker_keeps_one_table():
    one, two = small(), small()
    two.scores = {p: s - 1 for p, s in two.scores.items()}
    two.__post_init__()
    first = pc.worker_segmenter(one, 3)
    assert pc.worker_segmenter(small(), 3) is first and one.digest == small().digest
    assert pc.worker_segmenter(two, 3) is not first and len(pc._in_worker) == 1
