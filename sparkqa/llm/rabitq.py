"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector minus the mean of all vectors is padded with zeros to ``bits`` components, rotated at
random and kept as its signs.  With the vector's length and the inner product of its code with
itself (the correction scalars) the code gives an estimate of any inner product and a bound on its
error.  Vectors whose upper bound reaches a query's k-th largest lower bound are reranked on the
original vectors in double precision.

Queries meet all rows in blocks: rows and queries are hashed into blocks of a bounded size and each
task holds one block of either.  Only each block's k best rows of a query leave a task.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components neither query
nor are found; a query does not find its own row; equal scores go to the smaller id; with fewer than k
candidates all are returned; no usable vectors give an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.llm.vectors import dimension, dots, matrix, usable

QUERY_ROWS, CODE_ROWS, TILE = 4096, 16384, 128
EPSILON = 3.0  # standard deviations of the estimate's error that the bounds hold


def rotation(dim: int, bits: int, seed: int = 11) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix of size ``bits`` (the rest meet zeros)."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return np.ascontiguousarray(q.T)


def encode(x: np.ndarray, mean: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, the length of each centred vector, and its inner product with its own code."""
    bits = rot.shape[1]
    r = x - mean
    length = np.sqrt((r * r).sum(1))
    unit = r / np.where(length > 0, length, 1)[:, None]
    turned = unit @ rot
    own = np.abs(turned).sum(1) / np.sqrt(bits)
    return np.packbits(turned > 0, axis=1), length.astype(np.float32), np.where(own > 0, own, 1).astype(np.float32)


def search_block(q_ids, q, c_ids, c, codes, length, own, mean, rot, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest rows of the block for each query: bounds from the codes, then exact scores."""
    dim, bits = rot.shape
    signs = (np.unpackbits(codes, axis=1)[:, :bits].astype(np.float32) * 2 - 1).T / np.float32(np.sqrt(bits))
    scale = length / own
    slack = length * np.sqrt(np.maximum(1 - own * own, 0)) / own * np.float32(EPSILON / np.sqrt(max(bits - 1, 1)))
    out_q, out_c, out_s = [], [], []
    for i in range(0, len(q), TILE):
        part, ids = q[i:i + TILE], q_ids[i:i + TILE]
        turned = (part @ rot).astype(np.float32)
        norm = np.sqrt((part * part).sum(1)).astype(np.float32)
        est = (turned @ signs) * scale + (part @ mean).astype(np.float32)[:, None]
        err = norm[:, None] * slack
        low = est - err
        low[ids[:, None] == c_ids[None, :]] = -np.inf
        n = min(k, low.shape[1])
        kth = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n]
        # the k-th lower bound may be the query's own -inf where there are few rows
        a, b = np.nonzero(est + err >= kth[:, None])
        fit = ids[a] != c_ids[b]
        a, b = a[fit], b[fit]
        for j in range(0, len(a), 1 << 18):  # exact scores in slices of bounded memory
            s = dots(part[a[j:j + (1 << 18)]], c[b[j:j + (1 << 18)]])
            out_q.append(ids[a[j:j + (1 << 18)]]), out_c.append(c_ids[b[j:j + (1 << 18)]]), out_s.append(s)
        if len(out_q) > 64:
            out_q, out_c, out_s = ([x] for x in best(out_q, out_c, out_s, k))
    return best(out_q, out_c, out_s, k)


def best(qs, cs, ss, k: int):
    """The k largest scores of each query, ties to the smaller id."""
    q = np.concatenate(qs) if qs else np.zeros(0, np.int64)
    c = np.concatenate(cs) if cs else np.zeros(0, np.int64)
    s = np.concatenate(ss) if ss else np.zeros(0)
    o = np.lexsort((c, -s, q))
    q, c, s = q[o], c[o], s[o]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = rank < k
    return q[keep], c[keep], s[keep]


def codes(vectors: DataFrame, mean: np.ndarray, rot: np.ndarray) -> DataFrame:
    """The index: vec_id, packed code, the two correction scalars, and the original vector."""
    dim = len(mean)

    def run(batches):
        for b in batches:
            bits, length, own = encode(matrix(b.column(1), dim), mean, rot)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in bits], pa.binary()),
                                              pa.array(length), pa.array(own)], ["vec_id", "vector", "code", "length", "own"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, code binary, length float, own float")


def search(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           bits_per_component: int = 8, query_rows: int = QUERY_ROWS, code_rows: int = CODE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the largest inner product for each query row.

    The code has ``bits_per_component`` signs for each component (longer codes, smaller errors).
    """
    v = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("q")) \
        .filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("nq")).first()
    out = "query_id long, vec_id long, score double"
    if not stats["n"]:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = dimension(v, "vector")
    sums = v.select(*[F.avg(F.get("vector", F.lit(i))).alias(f"m{i}") for i in range(dim)]).first()
    mean, rot = np.array([sums[i] for i in range(dim)]), rotation(dim, dim * bits_per_component)
    n_q, n_c = -(-max(stats["nq"], 1) // query_rows), -(-stats["n"] // code_rows)
    index = codes(v.select("vec_id", "vector"), mean, rot)
    block = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = v.filter("q").select("vec_id", "vector", block(n_q, 1).alias("qb"),
                                F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("cb"))
    right = index.select("*", block(n_c, 2).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            q = c = np.zeros(0, np.int64)
            s = np.zeros(0)
        else:
            packed = np.frombuffer(b"".join(b["code"].to_pylist()), np.uint8).reshape(b.num_rows, -1)
            q, c, s = search_block(np.asarray(a["vec_id"]), matrix(a["vector"], dim), np.asarray(b["vec_id"]), matrix(b["vector"], dim),
                                   packed, np.asarray(b["length"]), np.asarray(b["own"]), mean, rot, k)
        return pa.table({"query_id": q, "vec_id": c, "score": s})

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(run, out)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
