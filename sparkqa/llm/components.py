"""Connected components of an edge table that never leaves the cluster.

Alternating large-star and small-star steps on DataFrames: every round hangs each node's larger
neighbours (then its smaller ones and itself) below the smallest node it knows.  The rounds grow
with the logarithm of the longest path.  Each round is written to the shared folder, so lineage stays
short and a lost executor costs one step.  A hub's edges are split: the per-node minimum is a
partial aggregate, and the joins read plain tables, whose skewed partitions Spark splits.
Up to ``FEW`` edges are one task's work, without rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize, parallel

ROWS_A_PART, FEW = 50_000, 100_000


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _save(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Write a step in as many parts as its rows ask for; a small graph is no work for hundreds of tasks."""
    return materialize(df.coalesce(max(1, min(parallel(df.sparkSession), -(-rows // ROWS_A_PART)))), name)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node with an edge to another node."""
    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u != v").distinct()
    e = materialize(e, "cc-edges")
    before = _state(e)
    if before[0] <= FEW and {t for _, t in e.dtypes} == {"bigint"}:
        return e.coalesce(1).mapInArrow(_whole, "node long, component long")
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), 2 * before[0], "cc-min")
        # e holds each edge once, larger end first: hang the larger end below the smaller end's least.
        large = e.select(F.col("v").alias("k"), F.col("u").alias("w")).join(least.select(F.col("u").alias("k"), "m"), "k") \
            .select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = _save(large.distinct(), before[0], "cc-large")
        least = _save(large.groupBy("u").agg(F.min("v").alias("m")), before[0], "cc-min")
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
        e = _save(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), before[0], "cc-edges")
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _whole(batches):
    """Nodes and components of all edges of a task."""
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*[(np.zeros(0, np.int64),) * 2, *((np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches)]))
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    low = node[local_components(len(node), at[:len(u)], at[len(u):])]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], ["node", "component"])


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and the edges of one block, the smallest node of each node's component."""
    label = np.arange(n)
    while len(a):
        new = label.copy()
        for x, y in ((a, b), (b, a)):
            np.minimum.at(new, x, label[y])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
        open_ = label[a] != label[b]
        if not open_.any():
            # settled edges agree; nodes may still point to a label that has moved on
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
    return label
