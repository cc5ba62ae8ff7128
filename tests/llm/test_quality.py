"""The classifier on made labels, its parts, and edge cases."""
import random

import numpy as np
from pyspark.sql import functions as F

from starledger.llm import quality as q
from starledger.llm.common import crc_mod

SCHEMA = "doc_id long, text string, label string, score string, x int"


def corpus(n=400):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.choice([30, 200]))]
        good = i % 3 > 0
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w + rnd.choice(["%%%", "&&&"]) for w in words]
        docs.append((i, " ".join(words), "z", "z", i))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus()
    extra = [(1000, None, "z", "z", 0), (1001, "", "z", "z", 0), (None, "plain words here", "z", "z", 0),
             (1002, "long " * 100000, "z", "z", 0), (0, docs[0][1], "z", "z", 9)]
    frame = spark.createDataFrame(docs + extra, SCHEMA)
    marks = spark.createDataFrame(labels + [(7, None), (8, 5), (None, 1)], "doc_id long, quality int")
    got = q.classify(frame, marks, held_out=crc_mod(F.col("id"), 5) == 0).collect()
    assert len(got) == len(docs) + len(extra)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    kept = q.drop_rejected(frame, marks)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert all((i in ids) == bool(y) for i, y in labels)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(120)
    frame = spark.createDataFrame(docs, SCHEMA)
    held = crc_mod(F.col("id"), 5) == 0
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    flipped = marks.withColumn("quality", F.when(crc_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in q.classify(frame, marks, held_out=held).collect()}
    b = {r.doc_id: r.score for r in q.classify(frame, flipped, held_out=held).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_no_labels_one_class_and_empty_table(spark):
    docs, labels = corpus(30)
    frame = spark.createDataFrame(docs, SCHEMA)
    one = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    assert {r.score for r in q.classify(frame, one).collect()} == {0.5}
    assert q.drop_rejected(frame, one.limit(0)).count() == 30
    assert q.classify(frame.limit(0), one).count() == 0


def test_density_difference_matches_direct_formula():
    rng = np.random.default_rng(2)
    x = [rng.normal(size=(500, 4)) @ rng.normal(size=(4, 4)) + k for k in (0, 1)]
    mean, cov = [v.mean(axis=0) for v in x], [np.cov(v.T, bias=True) for v in x]
    s = [q.shrunk(c, (cov[0] + cov[1]) / 2, 500) for c in cov]
    w = [np.linalg.inv(np.linalg.cholesky(c)) for c in s]
    model = q.Model(mean, w, [np.linalg.slogdet(c)[1] for c in s], [np.log(0.5)] * 2)
    at = rng.normal(size=(20, 4))

    def log_density(k):
        d = at - mean[k]
        return -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(s[k]), d) + np.linalg.slogdet(s[k])[1])
    assert np.allclose(model.difference(at), np.clip(log_density(1) - log_density(0), -q.CLIP, q.CLIP))
