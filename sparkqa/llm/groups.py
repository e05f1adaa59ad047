"""From equal signatures to linked nodes, without ever listing the pairs of a group.

A signature says little in a large table: unrelated nodes share it by chance, the more of them the more there are.  So a row
has a sketch too, bits that two linked nodes differ in at most in a given number; ``stars`` splits the
rows of a signature into those that sketches join, and only these meet.

``settle`` verifies every node against its lead, which is linear in the meetings, and
goes through all nodes only of what those links leave open, in blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize, mix64, parallel
from sparkqa.llm.components import components, local_components

BLOCK_ROWS = 512
SKETCH, SMALL, MOST = 56, 64, 1 << 18  # bits of a sketch; rows of a signature that are paired at once, and that a task holds
_BITS = np.int64((1 << SKETCH) - 1)


def packed(order: np.ndarray, may: np.ndarray | int, sketch: np.ndarray) -> np.ndarray:
    """What a row brings besides signature and ref: its order (0 index, 1 probe), in how many bits the sketches of linked
    nodes may differ (the same in all rows of a signature), and its sketch."""
    return order.astype(np.int64) << 62 | np.minimum(may, SKETCH).astype(np.int64) << SKETCH | sketch.astype(np.int64) & _BITS


def spread(own: np.ndarray) -> np.ndarray:
    """The first row that sketches join each row of one signature to, directly or through others."""
    label, left, may = np.arange(len(own)), np.arange(len(own)), own[0] >> SKETCH & 63
    index, x = own >> 62 == 0, own & _BITS
    while len(left) and index[left[0]]:  # rows are in order; what is left of probes alone meets nothing
        seed, left = left[0], left[1:]
        todo = [seed]
        while todo and len(left):
            t = todo.pop()
            near = np.bitwise_count(x[left] ^ x[t]) <= may
            if not index[t]:
                near &= index[left]
            if near.any():
                label[left[near]] = seed
                todo.extend(left[near])
                left = left[~near]
    return label


def meetings(sig: np.ndarray, ref: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, ref and lead of the rows of whole signatures, in order, that sketches join to a lead."""
    more = np.zeros(len(sig) + 1, bool)
    more[1:-1] = sig[1:] == sig[:-1]
    more = more[1:] | more[:-1]
    sig, ref, own = sig[more], ref[more], own[more]
    start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate((start, [len(sig)])))
    end, us, vs = np.repeat(start + size, size), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    i, step = np.flatnonzero((np.repeat(size, size) <= SMALL) & (own >> 62 == 0)), 1
    while len(i := i[i + step < end[i]]):
        j = i + step
        near = np.bitwise_count((own[i] ^ own[j]) & _BITS) <= (own[i] >> SKETCH & 63)
        us.append(i[near])
        vs.append(j[near])
        step += 1
    at = local_components(len(sig), np.concatenate(us), np.concatenate(vs))
    for s, n in zip(start[size > SMALL], size[size > SMALL]):
        at[s:s + n] = s + spread(own[s:s + n])
    lead = ref[at]
    meet = ref != lead
    sig, ref, lead = sig[meet], ref[meet], lead[meet]
    return mix64(sig.view(np.uint64) + mix64(lead.view(np.uint64))).view(np.int64), ref, lead


def stars(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``sig, ref, lead`` for every row that shares its signature with others whose sketches join it to them; lead is the first
    ref of these by (order, sketch, ref), and only those with a lead of order 0 count.  Rows (sig, ref, own: see ``packed``) are
    dealt and sorted by signature and streamed, so a task holds one batch and the rows of one signature.  Beyond ``most`` rows of
    one signature sketches are not compared: all its rows meet its first.
    """

    def run(batches):
        held, wide = [np.zeros(0, np.int64)] * 3, None
        for b in batches:
            now = [np.concatenate((x, np.asarray(b.column(i)))) for i, x in enumerate(held)]
            if wide is not None:  # rows of a signature over ``most`` go on
                n = int(np.searchsorted(now[0] != wide[0], True))
                if wide[2] >> 62 == 0:
                    yield batch(*star([x[:n] for x in now], wide))
                if n == len(now[0]):
                    held = [x[:0] for x in now]
                    continue
                now, wide = [x[n:] for x in now], None
            if not len(now[0]):
                continue
            new = np.ones(len(now[0]), bool)  # a ref comes once from each chunk of texts
            new[1:] = np.any([x[1:] != x[:-1] for x in now], axis=0)
            now = [x[new] for x in now]
            cut = int(np.flatnonzero(np.concatenate(([True], now[0][1:] != now[0][:-1])))[-1])
            yield batch(*meetings(*(x[:cut] for x in now)))
            held = [x[cut:] for x in now]
            if len(held[0]) > most:
                wide = [x[0] for x in held]
                if wide[2] >> 62 == 0:
                    yield batch(*star(held, wide))
                held = [x[:0] for x in held]
        yield batch(*meetings(*held))

    def star(now, first):
        lead = np.full(len(now[0]), first[1])
        meet = now[1] != lead
        return mix64(now[0].view(np.uint64) + mix64(lead.view(np.uint64))).view(np.int64)[meet], now[1][meet], lead[meet]

    def batch(*columns):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["sig", "ref", "lead"])

    n = parallel(rows.sparkSession)
    dealt = rows.select("sig", "ref", "own").repartition(n, "sig").sortWithinPartitions("sig", "own", "ref")
    return dealt.mapInArrow(run, "sig long, ref long, lead long")


def linked(members: DataFrame, link: Callable, block_rows: int = BLOCK_ROWS, *, sure: Callable | None = None) -> DataFrame:
    """Edges ``u, v`` that join the linked nodes inside each group (not all its links).

    ``members`` has grp, node and what ``link`` needs; ``link(table, a, b)`` returns index pairs of
    linked rows between rows a and rows b (b None: among a).  With ``sure``, these only may link; ``sure(table, p, q)`` tells
    which do, once for all groups of a task.  Groups over ``block_rows`` are cut into
    blocks by the hash of the node and each task holds two blocks; small groups share tasks.
    """
    kept = materialize(members, "group-members")
    sizes = kept.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).withColumn("_nb", F.ceil(F.col("_n") / block_rows).cast("int"))
    sizes = materialize(sizes, "group-sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    bins = max(1, -(-total // (2 * block_rows)))
    one = F.col("_nb") == 1
    d = kept.join(sizes, "grp") \
        .withColumn("_b", F.pmod(F.xxhash64("node"), F.col("_nb")).cast("int")) \
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))) \
        .withColumn("_key", F.when(one, F.pmod(F.xxhash64("grp", F.lit(5)), F.lit(bins))).otherwise(F.col("grp").cast("long"))) \
        .withColumn("_big", ~one).withColumn("_lo", F.least("_b", "_o")).withColumn("_hi", F.greatest("_b", "_o")).drop("_n", "_nb", "_o")

    def run(t: pa.Table) -> pa.Table:
        grp, node, blk = np.asarray(t["grp"]), np.asarray(t["node"]), np.asarray(t["_b"])
        us, vs, ps, qs = [], [], [], []

        def take(p, q, found=False):
            if sure and not found:
                ps.append(p)
                qs.append(q)
                return
            nodes = np.unique(np.concatenate([p, q])) if len(p) else np.zeros(0, np.int64)
            low = nodes[local_components(len(nodes), np.searchsorted(nodes, p), np.searchsorted(nodes, q))] if len(nodes) else nodes
            us.append(node[nodes[nodes != low]])
            vs.append(node[low[nodes != low]])

        if t["_big"][0].as_py() and t["_lo"][0] != t["_hi"][0]:
            lo = t["_lo"][0].as_py()
            take(*link(t, np.flatnonzero(blk == lo), np.flatnonzero(blk != lo)))
        else:
            o = np.argsort(grp, kind="stable")
            cuts = np.flatnonzero(np.diff(grp[o])) + 1
            for part in np.split(o, cuts):
                if len(part) > 1:
                    take(*link(t, part, None))
        if ps:
            p, q = np.concatenate(ps), np.concatenate(qs)
            ok = sure(t, p, q)
            take(p[ok], q[ok], True)
        empty = np.zeros(0, np.int64)
        return pa.table({"u": np.concatenate(us or [empty]), "v": np.concatenate(vs or [empty])})

    return d.groupBy("_big", "_key", "_lo", "_hi").applyInArrow(run, "u long, v long")


def settle(met: DataFrame, payload: DataFrame, verify: Callable, link: Callable, slices: Callable, sure: Callable | None = None, at_once: int = 256
           ) -> DataFrame:
    """Edges ``u, v`` that join all linked nodes among those that share a signature.

    ``met`` is the output of ``stars``; ``payload`` (node, data) has the data of every node in it.
    ``verify(data, data)`` tells which pairs of two lists (of up to ``at_once``) link; ``link`` and ``sure`` are for ``linked``;
    ``slices(data column)`` is an array of slice numbers such that linked nodes share one.
    """
    def check(batches):
        for b in (whole.slice(i, at_once) for whole in batches for i in range(0, whole.num_rows, at_once)):
            ok = pa.array(verify(b.column(2).to_pylist(), b.column(3).to_pylist()), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["u", "v"])

    pairs = met.select("ref", "lead").distinct()
    side = lambda n: payload.select(F.col("node").alias(n), F.col("data").alias(f"{n}_data"))
    near = pairs.join(side("ref"), "ref").join(side("lead"), "lead").select("ref", "lead", "ref_data", "lead_data")
    near = materialize(near.mapInArrow(check, "u long, v long"), "settle-near")
    comp = materialize(components(near), "settle-first")
    name = lambda d, c: d.join(comp.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")), c, "left") \
        .withColumn(f"{c}_in", F.coalesce(f"{c}_in", c))
    both = materialize(name(name(met, "ref"), "lead"), "settle-meetings")
    # A signature is settled when its nodes are one component, or all but the lead are.
    open_ = both.groupBy("sig").agg(F.count_if(F.col("ref_in") != F.col("lead_in")).alias("out"), F.min("ref_in").alias("lo"),
                                    F.max("ref_in").alias("hi")).filter("out > 0 and lo != hi").select("sig")
    held = materialize(both.join(open_, "sig", "left_semi"), "settle-open")
    group = components(held, "ref_in", "lead_in").select(F.col("node").alias("in"), F.col("component").alias("grp"))
    nodes = held.select(F.col("ref").alias("node"), F.col("ref_in").alias("in")).union(held.select("lead", "lead_in")).distinct()
    members = nodes.join(group, "in").join(payload, "node")
    members = members.select("node", "data", "grp", F.explode(slices(F.col("data"))).alias("slice")) \
        .select(F.xxhash64("grp", "slice").alias("grp"), "node", "data")
    return near.unionByName(materialize(linked(members, link, sure=sure), "settle-rest"))
