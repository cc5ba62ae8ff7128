"""The whole pipeline on the small tables, stage by stage."""
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from starledger.llm import exact_dedup, mixing, pieces, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(cp.shared_table(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark, stages):
    docs, good, single, apart, mixed, coded = stages
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece"]
    for x in (good, single, apart, mixed):
        assert x.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = good.join(labels, "doc_id").agg(F.avg("quality")).first()[0]
    assert kept > 0.97 and good.count() < docs.count()
    clean = docs.join(labels, "doc_id").where("quality = 1").select("doc_id")
    assert clean.join(good, "doc_id", "left_anti").count() <= 0.02 * clean.count()

    rows = {r.doc_id: r.text for r in good.collect()}
    first = {}
    for i in sorted(rows):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", rows[i] or ""), i)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    fps = [(i, simhash.fingerprint(rows[i]) % 2**64) for i in sorted(first.values())]
    root = {i: i for i, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, f) in enumerate(fps):
        for j, g in fps[:k]:
            if (f ^ g).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(r.doc_id for r in apart.collect()) == sorted({find(i) for i, _ in fps})

    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in apart.collect())
    vocab = pieces.load_vocabulary(pieces.MODEL)
    import numpy as np
    got = coded.collect()
    assert {r.doc_id: pieces.decode_ids(np.array(r.ids), vocab) for r in got} == {r.doc_id: r.text or "" for r in mixed.collect()}


def test_run_equals_the_stages(spark, stages):
    have = sorted((r.doc_id, tuple(r.ids)) for r in cp.run(spark, SF).collect())
    assert have == sorted((r.doc_id, tuple(r.ids)) for r in stages[-1].collect())


def test_position_gives_the_order_of_the_mixture(spark, stages):
    apart = stages[3]
    mixed, (_, place, slot, _, _) = mixing.interleave(apart, queries.SOURCE_WEIGHTS)
    want = [r.doc_id for r in mixed.orderBy(slot, place).collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = cp.shared_table(cp.mix_sources(spark, apart, SF), "order")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files.inputFiles()) > 1
    clashing = files.withColumn("position", F.lit("clash"))
    for docs in (files, clashing):
        assert [r.doc_id for r in cp.sentencepiece(spark, docs, SF).orderBy("position").collect()] == want
    assert [r.doc_id for r in cp.run(spark, SF).orderBy("position").collect()] == want


def test_empty_documents_with_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, slot int, key string, kept boolean, fp long"
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(sf + "/labels.parquet")
    rows = [(1, "a b c", "en", "s", 5, 1, "k", True, 7), (1, "a b c", "en", "s", 5, 1, "k", True, 7), (None, None, None, None, None, None, None, None, None),
            (2, "a  b c", "en", "src0", 6, 1, "k", True, 7), (3, "", "", "", 0, 0, "", False, 0), (4, "x" * 70000, "en", "src1", 70000, 1, "k", True, 7)]
    for data, want in (([], 0), (rows, 3)):
        docs = spark.createDataFrame(data, schema)
        for _, stage in cp.STAGES:
            docs = cp.shared_table(stage(spark, docs, sf), "edge")
        assert docs.count() == want


def test_op4_round_trips_every_text(spark):
    got = queries.op4_sentencepiece(spark, SF)
    assert got.where("not round_trip or round_trip is null").count() == 0
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
