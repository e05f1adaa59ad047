"""Near-duplicate embeddings over an inverted multi-index.

Unit vectors are cut into halves, each half with a codebook of its own; the two codebooks span a
product grid of cells.  From a vector the grid is walked by multi-sequence traversal: codewords of
either half are sorted by how far the vector is from their region, and cells are visited in that
order until the sum passes a stop radius, which is set so that the wanted share of true links is
reached.  Every visited cell's vectors are then verified by exact cosine.

Exact copies are one class from the start.  Cells and their visitors are cut into blocks of
bounded size; a task holds one block of either and hands back, for each class, how many vectors it
links with and one edge to the smallest member of its local component - never the pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors
without a label, link with nothing; every row is a vector of its own and comes back, also those that share an id or have a
null one (a component's id is its smallest id, null if it has none, and a null id is never kept); an empty table gives an
empty result; other columns are not read.  Classes of equal vectors are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize
from sparkqa.llm.components import components, local_components
from sparkqa.llm.vectors import dimension, dots, matrix, usable

SAMPLE_ROWS, CODEWORDS, MOST_CODEWORDS, BLOCK_ROWS = 20_000, 16, 256, 2048
BINS, MOST_RADIUS = 1 << 16, 8.0  # squared distances between unit vectors are 4 at most


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = distances(x, c).argmin(1)
        for j in range(len(c)):
            own = near == j
            c[j] = x[own].mean(0) if own.any() else x[rng.integers(len(x))]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


def entry_costs(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The own codeword of each row, and its squared distance to the border of every other region."""
    d = distances(x, c)
    own = d.argmin(1)
    gap = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(2), 1e-30))
    h = (d - d[np.arange(len(x)), own][:, None]) / (2 * gap[own])
    h[np.arange(len(x)), own] = 0
    return own, np.maximum(h, 0) ** 2


def visit(cost1: np.ndarray, cost2: np.ndarray, radius2: float) -> tuple[np.ndarray, np.ndarray]:
    """Multi-sequence traversal of the grid for all rows at once: (row, cell) pairs in the order of
    the sorted codewords, until the summed cost passes ``radius2``."""
    o1, o2 = np.argsort(cost1, 1, kind="stable"), np.argsort(cost2, 1, kind="stable")
    s1, s2 = np.take_along_axis(cost1, o1, 1), np.take_along_axis(cost2, o2, 1)
    rows, cells = [], []
    for i in range(cost1.shape[1]):
        live = np.flatnonzero(s1[:, i] <= radius2)
        if not len(live):
            break
        for j in range(cost2.shape[1]):
            live = live[s1[live, i] + s2[live, j] <= radius2]
            if not len(live):
                break
            rows.append(live)
            cells.append(o1[live, i] * cost2.shape[1] + o2[live, j])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(cells)


def stop_radius(x: np.ndarray, labels: np.ndarray, books, threshold: float, recall: float) -> float:
    """The squared stop radius: what the wanted share of the sample's true links needs, and at least
    three standard deviations of what a link at the threshold needs if it points anywhere."""
    half = x.shape[1] // 2
    (a, c1), (b, c2) = entry_costs(x[:, :half], books[0]), entry_costs(x[:, half:], books[1])
    counts = np.zeros(BINS, np.int64)  # of the radii that links need: bounded, however many links there are
    for lab in np.unique(labels):
        own = np.flatnonzero(labels == lab)
        for i in range(0, len(own), 512):
            p, q = np.nonzero(x[own[i:i + 512]] @ x[own].T >= threshold)
            p, q = own[i:i + 512][p], own[q]
            fit = p != q
            need = c1[p[fit], a[q[fit]]] + c2[p[fit], b[q[fit]]]
            counts += np.bincount(np.minimum((need * (BINS / MOST_RADIUS)).astype(np.int64), BINS - 1), minlength=BINS)
    least = 9 * (2 - 2 * threshold) / x.shape[1]
    total = counts.sum()
    bin_ = int(np.searchsorted(np.cumsum(counts), recall * total)) if total else -1
    return float(max(least, (bin_ + 1) * MOST_RADIUS / BINS)) + 1e-12


def fit(v: DataFrame, dim: int, threshold: float, recall: float, codewords: int, sample_rows: int):
    """Codebooks and the stop radius, from the ``sample_rows`` rows of smallest hash (a bounded sample)."""
    s = v.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("label", "vector").toArrow()
    x = unit(matrix(s["vector"], dim))
    half = dim // 2
    books = [kmeans(x[:, :half], codewords), kmeans(x[:, half:], codewords)]
    labels = np.unique(np.asarray(s["label"].cast(pa.string()).to_pylist()), return_inverse=True)[1]
    return books, stop_radius(x, labels, books, threshold, recall)


def unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, initial=0)
    x = x / np.where(big > 0, big, 1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def link_block(a_id, a_cell, a_n, a, b_id, b_cell, b_n, b, threshold: float):
    """Classes of the block with links: class, vectors of other classes it links with, smallest
    class of its component within the block."""
    near, far = [], []
    for i in range(0, len(a), 512):
        s = a[i:i + 512] @ b.T
        p, q = np.nonzero(s >= threshold - 1e-9)
        exact = dots(a[i:i + 512][p], b[q])
        fit = (exact >= threshold) & ((a_cell[i:i + 512][p] < b_cell[q]) | ((a_cell[i:i + 512][p] == b_cell[q]) & (a_id[i:i + 512][p] < b_id[q])))
        near.append(p[fit] + i)
        far.append(q[fit])
    p, q = np.concatenate(near), np.concatenate(far)
    ids, back = np.unique(np.concatenate([a_id, b_id]), return_inverse=True)
    p, q = back[:len(a)][p], back[len(a):][q]
    size = np.zeros(len(ids), np.int64)
    size[back[:len(a)]], size[back[len(a):]] = a_n, b_n
    links = np.bincount(p, size[q], len(ids)) + np.bincount(q, size[p], len(ids))
    low = ids[local_components(len(ids), p, q)]
    has = links > 0
    return ids[has], links[has].astype(np.int64), low[has]


def duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
               recall: float = 0.999, codewords: int | None = None, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Without ``codewords`` a half gets as many as make a cell of the grid hold some ``block_rows`` classes, from CODEWORDS to MOST_CODEWORDS.
    """
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                     F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("takes_part", usable(F.col("vector")) & F.col("label").isNotNull())
    keyed = rows.withColumn("k1", F.when(F.col("takes_part"), F.xxhash64("label", "vector"))) \
        .withColumn("k2", F.when(F.col("takes_part"), F.xxhash64(F.lit(77), "vector", "label")))
    members = materialize(keyed.select("vec_id", "k1", "k2"), "imi-members")
    reps = materialize(keyed.filter("takes_part").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("lowest"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")).withColumn("rep", F.col("k1")), "imi-classes")
    dim = dimension(reps, "vector")
    if not dim:
        return members.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if codewords is None:
        codewords = min(max(int(np.ceil(np.sqrt(reps.count() / block_rows))), CODEWORDS), MOST_CODEWORDS)
    books, radius2 = fit(reps, dim, threshold, recall, codewords, sample_rows)
    half, grid = dim // 2, len(books[1])

    def assign(batches):
        for t in batches:
            x = unit(matrix(t.column(3), dim))
            (a, c1), (b, c2) = entry_costs(x[:, :half], books[0]), entry_costs(x[:, half:], books[1])
            own = a * grid + b
            row, cell = visit(c1, c2, radius2)
            keep = cell >= own[row]  # the pair of two cells is looked at once, from the smaller cell
            row, cell = row[keep], cell[keep]
            order = np.argsort(row, kind="stable")
            starts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(x)))))
            visited = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(cell[order], pa.int32()))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), t.column(2), flat, pa.array(own, pa.int32()), visited],
                                             ["rep", "copies", "label", "unit", "cell", "visited"])

    kind = dict(reps.dtypes)["label"]
    placed = materialize(reps.select("rep", "copies", "label", "vector").mapInArrow(
        assign, f"rep long, copies long, label {kind}, unit array<double>, cell int, visited array<int>"), "imi-cells")
    there = materialize(placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("nb"))
                        .join(placed.select("label", F.explode("visited").alias("cell")).groupBy("label", "cell")
                              .agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("np")), ["label", "cell"]), "imi-blocks")
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = placed.select("rep", "copies", "label", "unit", "cell").join(there, ["label", "cell"]) \
        .select("label", "cell", F.col("cell").alias("own"), "rep", "copies", "unit", part("nb").alias("b"), span("np").alias("p")) \
        .toDF("label", "cell", "own", "rep", "copies", "unit", "b", "p")
    probes = placed.select("rep", "copies", "label", "unit", F.col("cell").alias("own"), F.explode("visited").alias("cell")) \
        .join(there, ["label", "cell"]).select("label", "cell", "own", "rep", "copies", "unit", part("np").alias("p"), span("nb").alias("b"))

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            got = (np.zeros(0, np.int64),) * 3
        else:
            side = lambda t: (np.asarray(t["rep"]), np.asarray(t["own"]), np.asarray(t["copies"]), matrix(t["unit"], dim))
            got = link_block(*side(x), *side(y), threshold)
        return pa.table(dict(zip(("rep", "links", "low"), got)))

    keys = ["label", "cell", "b", "p"]
    found = materialize(probes.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(run, "rep long, links long, low long"), "imi-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    answer = reps.select("k1", "k2", "rep", "copies", "lowest").join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    answer = materialize(answer.withColumn("component", F.coalesce("component", "rep")), "imi-answer")
    low = answer.groupBy("component").agg(F.min("lowest").alias("low"))
    own = members.join(answer.join(low, "component"), ["k1", "k2"], "left")
    cid = F.coalesce("low", "vec_id")
    return own.select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
                      cid.alias("component_id"), F.coalesce(cid == F.col("vec_id"), F.lit(False)).alias("kept"))
