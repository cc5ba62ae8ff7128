"""The broadcast bitmap, and what relies on it, with and without collisions."""
import pytest
from pyspark.sql import functions as F

from starledger.llm import components as cc
from starledger.llm import exact_dedup as xd
from starledger.llm import simhash as sh
from starledger.llm.common import shared_table, with_bitmap


@pytest.mark.parametrize("members", [0, 1, 5000, 70_000])
def test_bitmap_never_misses_and_seldom_errs(spark, members):
    hashed = shared_table(spark.range(members).select(F.xxhash64("id").alias("h")), "test-places")
    rows = spark.range(100_000).withColumn("at", F.lit("own"))
    marked = with_bitmap(rows, F.xxhash64("id"), hashed, "found")
    assert marked.columns == ["id", "at", "found"] and marked.schema["found"].dataType.simpleString() == "boolean"
    inside, outside = (marked.where(c).agg(F.count_if("found")).first()[0] for c in (f"id < {members}", f"id >= {members}"))
    assert inside == members
    assert outside <= 0.08 * (100_000 - members)


def test_bitmap_of_a_fixed_size_only_adds_collisions(spark):
    hashed = shared_table(spark.range(500).select(F.xxhash64("id").alias("h")), "test-places")
    got = with_bitmap(spark.range(600), F.xxhash64("id"), hashed, "found", max_bits=3)
    assert got.where("found").count() == 600  # 8 bits, all set


@pytest.mark.parametrize("bits", [0, 2, 27])
def test_exact_dedup_is_the_same_whatever_collides(spark, bits):
    rows = [(i, f"text {i % 40}" + " x" * (i % 7), "other") for i in range(300)] + [(None, None, "a"), (7, "", "b"), (7, "lone", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, raw string")
    kept = xd.drop_copies(docs, bitmap_bits=bits)
    assert kept.columns == docs.columns
    best = {}
    for i, t, raw in rows:
        best.setdefault(t or "", []).append((i is None, i or 0, raw))
    assert sorted((r.text or "", r.doc_id or 0) for r in kept.collect()) == sorted((t, min(v)[1]) for t, v in best.items())
    plain = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in xd.exact_dedup(docs, bitmap_bits=bits).collect())
    whole = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in xd.exact_dedup(docs, digest_all=True).collect())
    assert plain == whole and len(plain) == len(rows)


def test_cells_are_dealt_by_the_number_of_variants(spark, monkeypatch):
    monkeypatch.setattr(sh, "TASK_VARIANTS", 1000)
    fps = spark.range(60).select(F.xxhash64("id").alias("fp")).unionByName(
        spark.range(60).select(F.xxhash64("id").bitwiseXOR(F.lit(5)).alias("fp")))
    links = sh.fingerprint_links(fps)
    assert links.rdd.getNumPartitions() == -(-120 * sh.VARIANTS // 1000)
    assert {frozenset((r.a, r.b)) for r in links.collect()} == {
        frozenset((r.a, r.b)) for r in spark.range(60).select(F.xxhash64("id").alias("a"), F.xxhash64("id").bitwiseXOR(F.lit(5)).alias("b")).collect()}


def test_components_from_forests_of_few_edges(spark, monkeypatch):
    monkeypatch.setattr(cc, "FOREST_EDGES", 3)
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 2).alias("b"))
    comp = {}
    for r in cc.connected_components(chain).collect():
        comp.setdefault(r.comp, set()).add(r.node)
    assert sorted(map(sorted, comp.values())) == [list(range(0, 202, 2)), list(range(1, 203, 2))][0:2]
