"""Exact and SimHash deduplication against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from starledger.llm import exact_dedup as xd
from starledger.llm import simhash as sh
from starledger.llm.components import connected_components, local_forest

SCHEMA = "doc_id long, text string, lang string, kept string, SHA string, component_id int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", 7) for i, t in rows], SCHEMA)


ROWS = [(5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (4, None), (2, ""), (8, " "), (7, "x" * 50000), (6, "x" * 50000),
        (1, "x" * 49999 + "y"), (10, "x" * 300 + "q"), (11, "x" * 300 + "r"), (3, "a b c"), (None, "a\n\nb c"),
        (None, "lonely"), (12, "é b")]


def brute_exact(rows):
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        real = [j for j in ids if j is not None]
        out.append((i, min(real) if real else None, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_matches_brute_force(spark):
    docs = docs_of(spark, ROWS)
    got = xd.exact_dedup(docs, digest_all=True).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute_exact(ROWS)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)
    lazy = {(r.doc_id, r.text_sha256 is None) for r in xd.exact_dedup(docs).collect()}
    assert (10, False) in lazy and (12, True) in lazy  # same prefix and length: hashed; alone: not hashed


def test_drop_copies_keeps_one_row_per_text_with_all_columns(spark):
    docs = docs_of(spark, ROWS)
    kept = xd.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = [re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in rows]
    assert len(texts) == len(set(texts)) == len({e[3] for e in brute_exact(ROWS)})
    empty = docs.limit(0)
    assert xd.drop_copies(empty).count() == 0 and xd.exact_dedup(empty).count() == 0


def brute_fp(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    n, root = len(fps), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = []
    for i in range(n):
        real = [ids[j] for j in range(n) if find(j) == find(i) and ids[j] is not None]
        out.append(min(real) if real else None)
    return out


def test_spark_xxhash_is_the_contract_hash(spark):
    row = spark.sql("select xxhash64('ab cd ef') h").first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"ab cd ef", 42)


def test_near_dedup_matches_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(200)] + ["É", "Straße", "NUL\x00", "nb sp"]
    rows = [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "ONE"), (1005, "two words"), (1003, "one"),
            (None, "a null id here now"), (1006, "A null  ID here now")]
    for i in range(60):
        text = [rnd.choice(words) for _ in range(rnd.choice([3, 40, 400]))]
        rows.append((i, " ".join(text)))
        for k in range(rnd.choice([0, 0, 3])):
            text = list(text)
            text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((2000 + 10 * i + k, "  ".join(text)))
    got = sh.near_dedup(docs_of(spark, rows)).collect()
    fps = [brute_fp(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], fps)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == sorted(
        [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want)], key=str)
    kept = sh.drop_near_copies(docs_of(spark, rows)).collect()
    roots = {str(c) for c in want}
    assert sorted(str(r.doc_id) for r in kept) == sorted(roots)
    assert sh.near_dedup(docs_of(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_ball_links_connect_exactly_the_brute_force_components(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = [0, 2**64 - 1]
    for b in base.tolist():
        for _ in range(15):
            x = b
            for bit in rng.choice(64 if seed else 16, rng.integers(0, 7), replace=False).tolist():
                x ^= 1 << bit
            fps.append(x)
    fps = sorted(set(fps))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    comp = connected_components(sh.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long")))
    label = {r.node: r.comp for r in comp.collect()}
    got = {}
    for i, f in enumerate(signed):
        got.setdefault(label.get(f, f), set()).add(i)
    want = {}
    for i, c in enumerate(brute_components(list(range(len(fps))), fps)):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_local_forest_and_long_chain(spark):
    src, dst = np.arange(50), np.arange(1, 51)
    a, b = local_forest(src, dst)
    assert len(a) == 50 and set(b) == {0}
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(7, 7), (900, 901)], "a long, b long").repartition(7)
    comp = connected_components(edges)
    assert comp.select("comp").distinct().count() == 2 and comp.count() == 303
    assert connected_components(edges.limit(0)).count() == 0
