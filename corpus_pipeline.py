"""The training-data pipeline: documents in, token ids out.

Each stage calls one operator of ``starledger.llm`` on all rows its
predecessor kept, and its result is written as Parquet and read again as
the next stage's documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starledger.llm.common import fresh, shared_table, table  # noqa: E402
from starledger.llm.exact_dedup import drop_copies  # noqa: E402
from starledger.llm.mixing import in_mixed_order  # noqa: E402
from starledger.llm.pieces import encode  # noqa: E402
from starledger.llm.quality import THRESHOLD, drop_rejected  # noqa: E402
from starledger.llm.queries import SOURCE_WEIGHTS  # noqa: E402
from starledger.llm.simhash import drop_near_copies  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by ``labels.quality``, rejects go."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"), threshold=THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest doc_id stays."""
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: 3-word shingles,
    fingerprints at most 3 bits apart."""
    return drop_near_copies(docs, shingle=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixture of their sources."""
    return in_mixed_order(docs, SOURCE_WEIGHTS)


def stored_order(docs: DataFrame) -> Column:
    """Where a row of ``docs``, Parquet files that one Spark write made, lies
    in them: number of the task, of the task's file, and of the row in it.
    A scan packs files by size, so its rows come in any order; sorting by
    this gives the order in which they were written."""
    stored = docs.metadataColumn("_metadata")
    numbers = [F.regexp_extract(stored["file_name"], r"^part-(\d+)-.*-c(\d+)\.", g).cast("int") for g in (1, 2)]
    return F.struct(numbers[0].alias("part"), numbers[1].alias("file"), stored["row_index"].alias("row"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document's best segmentation, with the scores of
    the N best.  Rows come in any order; sorting by ``position`` gives the
    order of the mixture, in which the stage before wrote its files."""
    position, = fresh(docs, "position")
    coded = encode(docs.withColumn(position, stored_order(docs)), carry=["source", position])
    return coded.select("doc_id", "source", F.size("ids").alias("n_ids"), "ids", "score",
                        F.transform("nbest", lambda b: b["score"]).alias("nbest_scores"),
                        F.col(position).alias("position"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: The classifier's scores and the lattice search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
