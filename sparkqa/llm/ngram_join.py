"""Exact n-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

The columns (n-grams, as 64-bit hashes) are cut into blocks of the hash range.  The size-derived
bound says in how many n-grams two documents of given sizes may differ and still link; with one
block more than that, linked documents have at least one block in which their rows are equal.  Pairs
without an equal block - almost all - cannot reach the bound and are discarded before any product:
rows meet by the fingerprints of their blocks.  A block of few n-grams is equal by chance in a large table, so blocks
of fewer n-grams than ``least`` allows are left out: the many blocks of large rows make it sure (but for a chance under
``MISS`` a linked pair at the bound, as with the 64-bit hashes) that linked rows have an equal block with that many.  Small rows keep all
their blocks; there the parities of the n-grams, in 56 counters, tell most of the rest apart.  Each row is multiplied with the first row it
meets; rows that this leaves apart form groups, and inside a group the product of the incidence
rows is accumulated over slices of columns and blocks of rows.  Pairs whose sizes rule a link out are
dropped, the rest link by exact overlap; only edges that join linked documents leave a task.

Texts are not moved: the sets of those that meet others are made where their texts are read, by a list of eight bytes a text
(up to ``FEW`` texts; with more, the texts are joined).

Equal n-gram sets are one class throughout.  Edge cases: a null or empty text has no n-grams and
links with nothing; fewer than n words count as one n-gram; a null id takes no part (null
component); rows that share an id are one document in the result's ids; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import chunks, materialize, mix64, word_hashes
from sparkqa.llm.components import components
from sparkqa.llm.groups import SKETCH, packed, settle, stars

WORDS, PERCENT, FEW = 3, 90, 8_000_000
MISS, MOST_GRAMS, MOST_BLOCKS = 1e-11, 4, 200
_K = np.random.default_rng(99).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngram_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of every text, ascending inside a text, and their offsets."""
    h, _, _, at = word_hashes(data, offs, lower=True)
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    grams, owner = [], []
    if len(h) >= words:
        g = np.zeros(len(h) - words + 1, np.uint64)
        for j in range(words):
            g += mix64(h[j:len(h) - words + 1 + j] + _K[j]) * _K[j + 8]
        whole = doc[:len(g)] == doc[words - 1:]
        grams.append(mix64(g)[whole])
        owner.append(doc[:len(g)][whole])
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for j in range(words - 1):
            has = n[short] > j
            s[has] += mix64(h[at[short[has]] + j] + _K[j + 24]) * _K[j + 32]
        grams.append(mix64(s + n[short].astype(np.uint64)))
        owner.append(short)
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    g, d = np.concatenate(grams), np.concatenate(owner)
    o = np.lexsort((g, d))
    g, d = g[o], d[o]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[new], np.searchsorted(d[new], np.arange(len(offs)))


def sums(x: np.ndarray, offs: np.ndarray) -> np.ndarray:
    run = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=run[1:])
    return run[offs[1:]] - run[offs[:-1]]


def size_classes(percent: int, most: int) -> np.ndarray:
    """Upper ends of size classes; sizes that may link lie in one class or in neighbours."""
    ends = [1]
    while ends[-1] < most:
        ends.append(ends[-1] * 100 // percent + 1)
    return np.array(ends, np.int64)


def missed(size: int, blocks: int, percent: int, grams: int) -> float:
    """A bound on the chance that rows that just link, the smaller of ``size`` n-grams, have no equal block of ``grams`` or more.

    The n-grams in which they differ fall to blocks as balls to boxes; any number of boxes may stay free.  The n-grams they share, fewest
    when both have as many of their own, fall to all blocks; given that few of them fall to one free block, no more fall to others.
    """
    free = np.zeros(blocks + 1)
    free[blocks] = 1
    for _ in range(size * (100 - percent) // percent):
        hit = free * np.arange(blocks + 1) / blocks
        free -= hit
        free[:-1] += hit[1:]
    shared = -(-2 * percent * size // (100 + percent))
    few = sum(comb(shared, k) * (1 / blocks) ** k * (1 - 1 / blocks) ** (shared - k) for k in range(min(grams, shared + 1)))
    return float((free * few ** np.arange(blocks + 1)).sum())


@lru_cache(None)
def least(percent: int) -> np.ndarray:
    """By size class, the n-grams that a block must have to count; 0 where even the empty ones do."""
    out, ends = [0, 0], size_classes(percent, 1 << 31).tolist()
    for low, high in zip(ends[1:], ends[2:]):
        blocks = high * (100 - percent) // percent + 1
        if blocks > MOST_BLOCKS:  # the chance only falls
            break
        sizes = {low + 1, (3 * low + high) // 4 + 1, (low + high) // 2 + 1, (low + 3 * high) // 4 + 1, high}
        out.append(max((k for k in range(1, MOST_GRAMS + 1) if max(missed(x, blocks, percent, k) for x in sizes if low < x <= high) <= MISS), default=0))
    return np.array(out + [out[-1]] * (len(ends) - len(out)), np.int64)


def fingerprints(g: np.ndarray, offs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of every text's column blocks, the text of each, and in how many n-grams texts that link by it differ at most.

    Sizes s <= t link only if they differ in at most s * (100 - percent) / percent n-grams.  A text
    meets its own size class and, as the larger one, the class below.
    """
    n = np.diff(offs)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(g):
        return none
    ends = size_classes(percent, int(n.max()))
    own = np.searchsorted(ends, n)
    doc_of = np.repeat(np.arange(len(n)), n)
    out, owner, most = [], [], []
    for down in (0, 1):
        c = np.maximum(own - down, 0)
        blocks = ends[c] * (100 - percent) // percent + 1
        blocks = np.where((n > 0) & (own >= down) & (blocks > 1), blocks, 0)  # one block: only equal sets link
        start = np.concatenate(([0], np.cumsum(blocks)))
        if not start[-1]:
            continue
        # the product of a 32-bit hash and the block count puts ascending hashes into ascending blocks
        pos = start[doc_of] + ((g >> np.uint64(32)) * blocks[doc_of].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        live = blocks[doc_of] > 0
        cut = np.searchsorted(pos[live], np.arange(start[-1] + 1))
        inside = mix64(g[live] + _K[50])
        doc = np.repeat(np.arange(len(n)), blocks)
        place = np.arange(start[-1]) - start[doc]
        tag = mix64(c[doc].astype(np.uint64) * _K[51] + place.astype(np.uint64) * _K[52])
        need = least(percent)[c[doc]]
        full = np.diff(cut) >= np.maximum(need, 1)
        out.append(mix64(sums(inside, cut) + tag)[full])
        owner.append(doc[full])
        most.append(blocks[doc[full]] - 1)
        # An empty block says little alone: there the rows must also share one of the first n-grams
        # that the size bound leaves.
        lone = np.flatnonzero(~full & (need == 0))
        if len(lone):
            d = doc[lone]
            first = n[d] + (-n[d] * percent // 100) + 1
            row = np.repeat(np.arange(len(lone)), first)
            x = g[np.repeat(offs[d], first) + np.arange(len(row)) - np.repeat(np.cumsum(first) - first, first)]
            out.append(mix64(mix64(x + _K[53]) + tag[lone][row]))
            owner.append(d[row])
            most.append(blocks[d[row]] - 1)
    return (np.concatenate(out), np.concatenate(owner), np.concatenate(most)) if out else none


def sketches(g: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """For every text, whether the n-grams that fall to each of ``SKETCH`` counters are odd in number."""
    run = np.zeros(len(g) + 1, np.int64)
    np.bitwise_xor.accumulate(np.int64(1) << ((mix64(g + _K[54]) >> np.uint64(32)) * np.uint64(SKETCH) >> np.uint64(32)).astype(np.int64), out=run[1:])
    return run[offs[1:]] ^ run[offs[:-1]]


def link_rows(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked sets: the blocked product of their incidence rows, over slices of columns."""
    rows = a if b is None else np.concatenate([a, b])
    n = np.array([len(sets[i]) for i in rows], np.int64)
    lo, hi = (0, len(a)) if b is None else (len(a), len(rows))
    low, high = np.minimum(n[:len(a), None], n[None, lo:hi]), np.maximum(n[:len(a), None], n[None, lo:hi])
    may = (low > 0) & (100 * low >= percent * high)  # the size bound
    if b is None:
        may &= np.arange(len(a))[:, None] < np.arange(len(a))[None, :]
    if not may.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.concatenate([sets[i] for i in rows])
    of = np.repeat(np.arange(len(rows)), n)
    o = np.argsort(flat, kind="stable")
    flat, of = flat[o], of[o]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    col = np.cumsum(new) - 1
    shared = np.bincount(col)[col] > 1  # a column of one row adds to no pair
    of, col = of[shared], col[shared]
    overlap = np.zeros(may.shape, np.float32)
    width = max(1, (1 << 22) // max(len(rows), 1))
    if len(col):
        _, col = np.unique(col, return_inverse=True)
        edges = np.searchsorted(col, np.arange(0, col[-1] + 1 + width, width))
        for k, (s, e) in enumerate(zip(edges[:-1], edges[1:])):
            if s < e:
                dense = np.zeros((len(rows), int(col[e - 1]) - k * width + 1), np.float32)
                dense[of[s:e], col[s:e] - k * width] = 1
                overlap += dense[:len(a)] @ dense[lo:hi].T
    inter = np.rint(overlap).astype(np.int64)
    union = n[:len(a), None] + n[None, lo:hi] - inter
    p, q = np.nonzero(may & (100 * inter >= percent * union))
    return a[p], (a if b is None else b)[q]


def join(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row a document: doc_id, text_hash, n_shingles, component_id."""
    src = df.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def describe(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                g, at = ngram_sets(data, offs, words)
                k1, k2 = sums(mix64(g + _K[60]), at), sums(mix64(g + _K[61]), at)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(at)),
                                                  pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))],
                                                 ["doc_id", "text_hash", "n", "k1", "k2"])

    def meet(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                g, at = ngram_sets(data, offs, words)
                k1 = sums(mix64(g + _K[60]), at).view(np.int64)
                # copies inside the chunk meet once
                _, first = np.unique(k1, return_index=True)
                sig, doc, most = fingerprints(g, at, percent)
                keep = np.zeros(len(at), bool)
                keep[first] = True
                keep = keep[doc]
                sig, doc, most = sig[keep], doc[keep], most[keep]
                own = packed(np.zeros(len(doc), np.int64), most, np.where(most < SKETCH, sketches(g, at)[doc], 0))
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(k1[doc]), pa.array(own)], ["sig", "ref", "own"])

    docs = materialize(src.mapInArrow(describe, "doc_id long, text_hash long, n long, k1 long, k2 long"), "ng-docs")
    met = materialize(stars(src.filter("doc_id is not null").mapInArrow(meet, "sig long, ref long, own long")), "ng-met", free=True)

    classes = materialize(docs.filter("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("n").alias("n")), "ng-classes")
    nodes = met.select(F.col("ref").alias("k1")).union(met.select("lead")).distinct()
    tag = lambda d, h: F.xxhash64(d, h)
    wanted = materialize(classes.join(nodes, "k1", "left_semi").select(tag(F.col("rep.doc_id"), F.col("rep.text_hash")).alias("_tag")), "ng-wanted")
    tagged = src.filter("doc_id is not null").select(tag("doc_id", "text_hash").alias("tag"), "text")
    if wanted.count() <= FEW:  # eight bytes a text that meets another: texts stay where they are
        tags = np.sort(np.asarray(wanted.toArrow().column(0).combine_chunks()))
        shared = df.sparkSession.sparkContext.broadcast(tags)

        def own(batches):
            for batch in batches:
                x = np.asarray(batch.column(0))
                at = np.minimum(np.searchsorted(shared.value, x), max(len(shared.value) - 1, 0))
                yield batch.filter(pa.array(shared.value[at] == x if len(shared.value) else np.zeros(len(x), bool)))
        texts = tagged
    else:
        own, texts = iter, tagged.join(wanted, F.col("tag") == F.col("_tag")).select("tag", "text")

    def rows(batches):
        for batch in own(batches):
            for part, data, offs in chunks(batch):
                g, at = ngram_sets(data, offs, words)
                k1 = sums(mix64(g + _K[60]), at).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array([g[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())],
                                                 ["node", "data"])

    grams = texts.mapInArrow(rows, "node long, data binary")
    if not docs.filter("doc_id is not null").groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():
        grams = grams.groupBy("node").agg(F.first("data").alias("data"))  # rows that repeat id and text
    grams = materialize(grams, "ng-grams")

    def verify(x: list[bytes], y: list[bytes]) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for i, (p, q) in enumerate(zip(x, y)):
            if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                inter = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                out[i] = 100 * inter >= percent * (len(p) + len(q) - inter)
        return out

    def link(t: pa.Table, a: np.ndarray, b: np.ndarray | None):
        if _last[0] is not t:
            _last[:] = [t, [np.frombuffer(x, np.uint64) for x in t["data"].to_pylist()]]
        return link_rows(_last[1], a, b, percent)

    def slices(data):  # the size class of the fingerprints: linked sizes lie in one or in neighbours
        ends = size_classes(percent, 1 << 31).tolist()
        own = F.size(F.filter(F.array(*[F.lit(x) for x in ends]), lambda x: x < F.octet_length(data) / 8))
        return F.array(own, own - 1)

    edges = settle(met, grams, verify, link, slices)
    ids = classes.select("k1", F.col("rep.doc_id").alias("rep")).groupBy("k1").agg(F.min("rep").alias("rep"))
    named = edges.join(ids.select(F.col("k1").alias("u"), F.col("rep").alias("a")), "u").join(ids.select(F.col("k1").alias("v"), F.col("rep").alias("b")), "v")
    comp = components(materialize(named.select("a", "b"), "ng-edges"), "a", "b")
    answer = materialize(classes.select("k1", "k2", F.col("rep.doc_id").alias("rep")).join(
        comp, F.col("rep") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "rep").alias("component")), "ng-answer")
    return docs.join(answer, ["k1", "k2"], "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))).otherwise(F.col("doc_id")).alias("component_id"))


_last: list = [None, None]  # a task asks for the sets of one table group by group
