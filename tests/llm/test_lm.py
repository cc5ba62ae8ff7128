"""Base score against brute force, the model against its definition."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import lm
from starledger.llm.common import crc_mod

SCHEMA = "doc_id long, text string, score string, held_out int"


def corpus(n=150):
    rnd = random.Random(6)
    tongues = [[f"{x}{i}" for i in range(40)] for x in "ab"]
    rows = []
    for i in range(n):
        words = rnd.choice(tongues)
        rows.append((i, " ".join(rnd.choice(words) if rnd.random() < 0.95 else f"rare{rnd.randrange(10**6)}"
                                 for _ in range(rnd.choice([5, 60, 200])))))
    return rows


EDGE = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "THE Straße É"), (None, "a1 a2"), (1004, "x" * 40000 + " y" * 30000), (3, "a1"), (3, "a1")]


def brute_base(rows):
    learns = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1
    c = Counter()
    for i, t in rows:
        if learns(i):
            c.update(lm.tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        words = lm.tokens(t)
        out.append((str(i), not learns(i), len(words), sum(c[w] > 0 for w in words), n,
                    sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)))
    return sorted(out)


@pytest.mark.parametrize("lookup", [lm.LOOKUP, 50])
def test_base_matches_brute_force_with_and_without_the_join(spark, lookup):
    rows = corpus(60) + EDGE
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = lm.score_texts(docs, crc_mod(docs["doc_id"], 5) != 1, lookup=lookup).collect()
    want = brute_base(rows)
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert [h[5] for h in have] == pytest.approx([w[5] for w in want])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_model_beats_counts_on_held_out_texts(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in corpus(400)], SCHEMA)
    got = lm.score_texts(docs, crc_mod(docs["doc_id"], 5) != 1).collect()
    held = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score - r.base_score for r in held) / tokens > 0.05  # knows which tongue a text is in


def test_chances_add_up_to_one_over_the_whole_vocabulary():
    words = [lm.END, *(f"w{i}".encode() for i in range(1500))]
    count = np.arange(1501, 0, -1)
    lex = lm.Lexicon(lm.Ranks(zip(words, range(1501))), count, int(count.sum()), 1501)
    model = lm.Model(lex)
    rng = np.random.default_rng(0)
    model.classes += rng.normal(size=model.classes.shape).astype(np.float32)
    model.words += rng.normal(size=model.words.shape).astype(np.float32)
    context = [3, 1200, lm.BOS]
    total = 0.0
    for w in [*range(lm.VOCABULARY), lm.VOCABULARY]:
        ids = np.array([*context, w], np.int64)
        total += math.exp(lm.evaluate(model, ids, np.array([3]))[0])
    assert total == pytest.approx(1.0, abs=1e-4)
    # within the class of other words: the counted ones and one unseen word
    other = (count[lm.VOCABULARY:] + 0.5).sum() / lex.other_scale + 0.5 / lex.other_scale
    assert other == pytest.approx(1.0)


def test_gradient_is_that_of_the_log_likelihood():
    words = [lm.END, *(f"w{i}".encode() for i in range(40))]
    lex = lm.Lexicon(lm.Ranks(zip(words, range(41))), np.arange(41, 0, -1), 861, 41)
    ids = np.array([lm.BOS] * 3 + [5, 1, 5, 9, 33, 0], np.int64)
    at = np.arange(3, 9)
    trainer = lm.Trainer(lm.Model(lex), 1.0)
    got = {}
    trainer._apply = lambda w, scale, use, rows, grad: got.update({w.shape[0]: (rows, grad)})
    trainer.step(ids, at)
    rows, grad = got[lm.ROWS_CLASS]
    loss = lambda m: -lm.evaluate(m, ids, at).sum()
    base = loss(trainer.model)
    for k, c in ((0, 0), (3, 1), (5, 0)):
        model = lm.Model(lex)
        model.classes[rows[1][k], c] += 1e-2
        same = rows == rows[1][k]
        want = sum(grad[j, c] for f in same for j in np.flatnonzero(f))
        assert (loss(model) - base) / 1e-2 == pytest.approx(want, abs=2e-2)


def test_empty_table_and_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = lm.score_texts(docs, F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known, r.base_score) for r in got] == [(0, 0, 0.0)] * 2
    assert lm.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_score_does_not_depend_on_partitions(spark):
    rows = corpus(200) + EDGE
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    scores = []
    for n in (1, 7):
        part = docs.repartition(n, F.rand(n))
        got = lm.score_texts(part, crc_mod(part["doc_id"], 5) != 1).collect()
        scores.append(sorted((str(r.doc_id), r.n_tokens, r.score) for r in got))
    assert [s[:2] for s in scores[0]] == [s[:2] for s in scores[1]]
    assert [s[2] for s in scores[0]] == pytest.approx([s[2] for s in scores[1]], rel=1e-12)


def test_several_shards_are_the_same_over_partitions(spark):
    docs = spark.createDataFrame([(i, t) for i, t in corpus(120)], "doc_id long, text string")
    lex = lm.lexicon(lm.count_tokens(docs))
    one, two = (lm.train(docs.repartition(n, F.rand(n)), lex, shard_tokens=1500, id_col="doc_id") for n in (2, 9))
    assert np.array_equal(one.classes, two.classes) and np.array_equal(one.words, two.words) and one.classes.any()


@pytest.mark.parametrize("distinct", [40, 41, 300])
def test_lexicon_is_filled_from_the_last_cell(spark, distinct):
    docs = spark.createDataFrame([(i, f"w{i} w{i}") for i in range(distinct)], "doc_id long, text string")
    lex = lm.lexicon(lm.count_tokens(docs), 41)
    assert len(lex.count) == 41 and lex.distinct == distinct + 1


def test_long_words_take_the_join(spark):
    docs = spark.createDataFrame([(1, "x" * 70 + " y"), (2, "x" * 70), (3, "é" * 33)], "doc_id long, text string")
    lex = lm.lexicon(lm.count_tokens(docs))
    assert set(lex.rank) == {lm.END, b"y"} and lex.distinct == 4
    rows = {r.doc_id: r for r in lm.score_texts(docs, F.lit(True)).collect()}
    assert rows[1].n_known == 3 and rows[3].n_known == 2
