"""Token alignment against whole-text encodings and plain loops."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from starledger.llm import align as al
from starledger.llm.queries import op11_token_alignment

ODD = [None, "", " ", "  ", "a  b", "héllo 日本 🙂x", "𝼀𝼁 x", "<|endoftext|> <s>", "x▁y z", "a\n\nb c", "tab\tx y", "　x y",
       "é́a b", " lead", "trail ", "\"It's\" they'll go", "ﷺ ½", "\x00 \x01", "日本語テキスト" * 20, "a" * 5000,
       "x  y z", "1234 567.89 $5", "﻿a b", "word " * 3000, "same text", "same text"]


@pytest.fixture(scope="module")
def models():
    return al.Tokenizers.read(al.BYTE_MODEL, al.PIECE_MODEL)


def brute(texts, models):
    """The contract's columns by whole-text encodings and set intersection."""
    a, b = models.load()
    of_a, of_b = models.token_bytes()
    rows, count = [], Counter()
    for t in texts:
        ids = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        raw = (" " + t).encode() if t else b""
        if any(b"".join(table[i] for i in side) != raw for table, side in zip((of_a, of_b), ids)):
            ids = ([], [])
        ends = [np.cumsum([len(table[i]) for i in side]).astype(int).tolist() for table, side in zip((of_a, of_b), ids)]
        groups, links, at = [], [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = (ends[0].index(end) + 1, ends[1].index(end) + 1)
            own = [ids[k][at[k]:to[k]] for k in (0, 1)]
            groups.append("|".join(",".join(map(str, o)) for o in own))
            links.append((own[0][-1], own[1][-1]))
            at = to
        count.update(links)
        rows.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    return [(x, y, g, len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls), d) for x, y, g, ls, d in rows]


def test_odd_texts_and_clashing_columns(spark, tmp_path, models):
    rows = [(i, t, "p", 1) for i, t in enumerate(ODD)] + [(None, "null id", "q", 2), (5, "repeated id", "r", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, pairs string, n_a int").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_token_alignment(spark, str(tmp_path)).collect()
    want = brute([r[1] for r in rows], models)
    assert sorted(map(str, map(tuple, got))) == sorted(str((r[0], *w)) for r, w in zip(rows, want))


def test_documents_equal_brute_force(spark, models):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], models)))
    got = {r.doc_id: tuple(r)[1:] for r in op11_token_alignment(spark, sf).collect()}
    assert got == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_token_alignment(spark, str(tmp_path)).collect() == []


def test_whole_texts_and_words_agree(models):
    assert models.by_word()
    by_word, whole = al.Aligner(models, True), al.Aligner(models, False)
    texts = [t or "" for t in ODD]
    assert by_word.align(texts) == whole.align(texts)
    assert by_word.align(texts) == whole.align(texts)     # from the caches


def test_pairs_stay_within_the_bound(models):
    of_a, of_b = models.token_bytes()
    assert models.most_pairs() < al.MAX_PAIRS
    aligner = al.Aligner(models, True)
    codes = np.unique(np.concatenate([np.frombuffer(r[3], aligner.code) for r in aligner.align([t for t in ODD if t]) if r]))
    for code in codes.tolist():
        x, y = of_a[code // len(of_b)], of_b[code % len(of_b)]
        assert x.endswith(y) or y.endswith(x)
