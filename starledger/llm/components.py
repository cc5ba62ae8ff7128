"""Connected components of a graph given as an edge table.

Randomised contraction: in each round every node points to the neighbour
(or itself) with the smallest hash under a round-specific seed, and the
edges are rewritten to the pointed-to nodes.  The expected number of
nodes left falls by a constant factor per round whatever the shape of the
graph (long chains included), so the rounds grow with the logarithm of
the graph.  Each round is one aggregation with partial minima (a hub of
any degree costs one row per task) and two equi-joins whose skewed
partitions AQE splits; each result is a table in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import shared_table

FOREST_EDGES = 1 << 21
MAX_ROUNDS = 200  # far beyond any expected number; a guard against a bug, not a limit


def local_forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect exactly what the given edges
    connect; one edge for each node that is not its component's root."""
    nodes, idx = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = idx[:len(src)], idx[len(src):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contract_batches(batches):
    """Forests of about ``FOREST_EDGES`` edges each, so a task's memory is bounded."""
    def forest():
        src, dst = local_forest(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["a", "b"])

    parts, held = [], 0
    for b in batches:
        if b.num_rows:
            parts.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
            held += b.num_rows
        if held >= FOREST_EDGES:
            yield forest()
            parts, held = [], 0
    if parts:
        yield forest()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` has two long columns without nulls; returns (node, comp)
    for every node that has an edge to another node, where ``comp`` is one
    node of the component, the same for all its nodes.  Self loops and
    repeated edges are harmless; no edges give an empty table."""
    left, right = edges.columns[:2]
    todo = (edges.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b"))
            .where("a <> b"))
    todo = shared_table(todo.mapInArrow(_contract_batches, "a long, b long"), "cc-edges")
    comp = None
    for turn in range(MAX_ROUNDS):
        if todo.isEmpty():
            break
        both = todo.unionByName(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("v"))
        point = both.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a")))["v"].alias("to"))
        point = shared_table(point, "cc-point")
        if comp is None:
            comp = point.select(F.col("a").alias("node"), F.col("to").alias("comp"))
        else:
            comp = shared_table(
                comp.join(point, comp["comp"] == point["a"], "left")
                .select("node", F.coalesce("to", "comp").alias("comp")), "cc-comp")
        pa_, pb = point.toDF("a", "ra"), point.toDF("b", "rb")
        todo = (todo.join(pa_, "a").join(pb, "b").where("ra <> rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        todo = shared_table(todo.mapInArrow(_contract_batches, "a long, b long"), "cc-edges")
    else:
        raise RuntimeError("connected components did not settle")
    if comp is None:
        return edges.sparkSession.createDataFrame([], "node long, comp long")
    return comp
