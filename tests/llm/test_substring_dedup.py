"""Removal of repeated passages against a loop over all windows."""
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starledger.llm import substring_dedup as sd
from starledger.llm.common import pack_steps, unpack_steps


def brute(docs, width):
    """Sorted (id, words, removed, kept text); null ids first, equal (id, start) never remove each other."""
    key = lambda d: (d is not None, d or 0)
    first = {}
    for doc, text in docs:
        w = (text or "").encode().split()
        for s in range(len(w) - width + 1):
            at = (key(doc), s)
            g = tuple(w[s:s + width])
            first[g] = min(first.get(g, at), at)
    out = []
    for doc, text in docs:
        w = (text or "").encode().split()
        gone = {p for s in range(len(w) - width + 1) if first[tuple(w[s:s + width])] != (key(doc), s) for p in range(s, s + width)}
        out.append((str(doc), len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


def run(spark, docs, width, **sizes):
    df = spark.createDataFrame([(d, t, 1, "b") for d, t in docs], "doc_id long, text string, bucket int, body string").repartition(3)
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in sd.substring_dedup(df, width, **sizes).collect())


P = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, P[0]), (5, "x " + P[0] + " y"), (6, P[0] + "\n" + P[1]), (7, P[1].replace(" ", "  ")), (8, "same " * 100),
       (9, "same " * 3), (None, P[2]), (10, P[2] + " é日本"), (None, P[2]), (11, P[1]), (11, P[1]), (11, P[0] + " " + P[2]), (-5, "z " + P[1]),
       (12, "w" * 100_000 + " " + P[0]), (13, " ".join(["q", "r"] * 60)), (14, P[0] + " " + P[0])]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 20])
def test_odd_rows(spark, width):
    assert run(spark, ODD, width) == brute(ODD, width)


def test_any_sizes_of_groups_and_buckets(spark):
    want = brute(ODD * 3, 5)
    assert run(spark, ODD * 3, 5, bucket_bytes=500, group_windows=10) == want
    assert run(spark, ODD * 3, 5, group_windows=300) == want


def test_a_passage_that_all_texts_share(spark):
    docs = [(i, f"u{i} " * 3 + P[0] + f" v{i}") for i in range(400)]
    got = run(spark, docs, 20, group_windows=50)
    assert got == brute(docs, 20) and sum(r[2] for r in got) == 399 * 40


def test_empty_table(spark):
    assert sd.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_removed_intervals_are_maximal(spark):
    df = spark.createDataFrame([(1, P[0]), (2, "x " + P[0] + " y " + P[0])], "doc_id long, text string")
    rows = {r.doc_id: r.removed for r in sd.substring_dedup(df).collect()}
    assert rows[1] == [] and [tuple(r) for r in rows[2]] == [(1, 41), (42, 82)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 25))
def test_window_hashes_equal_the_rolling_form(words, width):
    base, mod = sd._BASES[0], 1 << 64
    want, h = [], 0
    for i, w in enumerate(words):
        if i >= width:
            h = (h - words[i - width] * pow(base, width - 1, mod)) % mod
        h = (h * base + w) % mod
        if i >= width - 1:
            want.append(h)
    assert sd.window_hashes(np.array(words, np.uint64), width, base).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=40))
def test_packed_arrays_come_back(values):
    a = np.array(values, np.int64)
    assert unpack_steps(pack_steps(a), np.int64).tolist() == values
