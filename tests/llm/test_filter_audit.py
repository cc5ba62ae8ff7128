"""The filter audit against a loop over documents and orders."""
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from starledger.llm import filter_audit as fa
from starledger.llm.queries import op12_filter_audit


def brute(docs, labels):
    """Rows of the contract by applying every order to every document."""
    ones = {k: {d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1)}
    fails = []
    for doc, text, part in docs:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        out = set()
        if len(words) < 200:
            out.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            out.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            out.add("C")
        if any(c in "#$%&*|" for c in text):
            out.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in docs):
            out.add("E")
        fails.append((part or "", out, doc in ones[0], doc in ones[1]))
    rows = []
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        made, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = list(mine), []
            for step, letter in enumerate(order, 1):
                now = [f for f in left if letter in f[1]]
                rest = [f for f in left if letter not in f[1]]
                made.append((part, "".join(order), step, len(rest), len(now), sum(letter in f[1] for f in gone),
                             sum(f[1] == {letter} for f in mine), sum(f[2] for f in now), sum(f[3] for f in now), letter))
                total[letter] += len(now)
                left, gone = rest, gone + now
        rows += [(*m[:-1], total[m[-1]]) for m in made]
    return sorted(rows)


LONG = " ".join(f"w{i}" for i in range(220))


def write(spark, path, docs, labels):
    spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, lang string, mask string, good int").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_equals_brute_force(spark, tmp_path):
    docs = [(1, LONG, "en"), (2, LONG, "en"), (3, LONG + " x#", "en"), (4, "UP " * 230, "de"), (5, "", "de"), (6, None, None),
            (7, "a b", None), (8, "a b", "en"), (8, "a b", "en"), (None, "a b", "en"), (None, LONG, "fr"), (9, "x\ty\x0bz" * 90, "en"),
            (10, LONG.upper(), "en"), (11, " \n ", ""), (12, "é$" * 5000, "de"), (13, LONG, "fr")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (8, 1, 1), (12, None, 1), (None, 1, 1), (99, 1, 1), (13, 1, 0)]
    write(spark, tmp_path, docs, labels)
    got = op12_filter_audit(spark, str(tmp_path)).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_empty_table_has_no_parts(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert op12_filter_audit(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("k", [1, 3, 5])
def test_path_counts(k):
    reach, leave = fa.path_counts(k)
    assert all(reach[s] == factorial(s.bit_count()) and leave[s] == factorial(k - s.bit_count()) for s in range(1 << k))


def test_other_filters_without_a_copy_filter(spark):
    docs = spark.createDataFrame([(1, "a", "p"), (2, "ab", "p"), (3, "b", "q")], "doc_id long, text string, kind string")
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    masks = fa.failure_masks(docs, labels, {"x": docs["text"].contains("a"), "y": F.when(docs["text"] == "ab", True)}, None, docs["kind"])
    rows = {(r.part, r.filter_order, r.step): r for r in fa.audit_filters(masks, "xy").collect()}
    assert len(rows) == 8
    assert rows["p", "yx", 1].removed == 1 and rows["p", "yx", 2].removed == 1 and rows["p", "yx", 2].redundant == 1
    assert rows["p", "xy", 1].shapley == 3 and rows["p", "xy", 1].good_lost == 1 and rows["q", "xy", 2].kept == 1
    with pytest.raises(ValueError):
        fa.audit_filters(masks, "xx")
