"""BM25 postings in blocks that carry their largest impact, and a top-k that skips what cannot reach it.

The impact of a posting is what its term's idf is multiplied with; it needs no query.  A block holds the
postings of one term in ``BLOCK_ROWS`` consecutive corpus rows; a term carries the largest impact of all
its blocks.  A ranking goes in two passes.  The first one scores documents by each question's most
selective terms only, some ``SEED_FACTOR`` x k postings; the k-th best of these partial scores is a threshold that at least k documents
reach.  In the second pass, a question's terms are taken from the largest bound (weight x largest impact) down,
until the bounds of those left sum to less than the threshold: a document that holds none of the terms taken
cannot be among the best k.  Documents that do are scored by them; the blocks of the terms left are read only
where a document found so far could still reach the threshold with the largest impacts of its own blocks.
The ranking is that of ``bm25_topk``, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.operators.index import Bm25Index
from sparkqa.operators.retrieve import TIE_DECIMALS, _rank, bm25_query_terms
from sparkqa.operators.util import DEFAULT_BROADCAST_ROWS, materialize

BLOCK_ROWS = 4096
SEED_FACTOR = 20
MARGIN = 1e-7  # over the rounding of compared scores and the order of their sums


@dataclass
class BlockIndex:
    blocks: DataFrame     # term, block, n, most (largest impact), postings array<struct<row_no,id,impact>>
    terms: DataFrame      # term, df, idf, most (largest impact of all blocks)
    block_rows: int = BLOCK_ROWS


def impact(tf: Column, dl: Column, k1: float, b: float, avgdl: float) -> Column:
    return (tf * (k1 + 1.0)) / (tf + k1 * (1.0 - b + b * (dl / F.lit(avgdl))))


def build_blocks(index: Bm25Index, block_rows: int = BLOCK_ROWS) -> BlockIndex:
    """The pruned vocabulary's postings in blocks: one shuffle by (term, block), so a frequent term is many groups."""
    st = index.stats.first()  # one row
    avgdl = float(st["avgdl"]) if st["avgdl"] > 0 else 1.0
    value = impact(F.col("tf"), F.col("dl"), float(st["k1"]), float(st["b"]), avgdl)
    p = index.postings.join(index.vocab.select("term"), "term", "left_semi") \
        .select("term", F.floor(F.col("row_no") / block_rows).alias("block"), F.struct("row_no", "id", value.alias("impact")).alias("p"))
    blocks = p.groupBy("term", "block").agg(F.count(F.lit(1)).alias("n"), F.max("p.impact").alias("most"), F.collect_list("p").alias("postings"))
    blocks = materialize(blocks, "bm25-blocks")
    most = blocks.groupBy("term").agg(F.max("most").alias("most"))
    return BlockIndex(blocks, materialize(index.vocab.select("term", "df", "idf").join(most, "term"), "bm25-block-terms"), block_rows)


def query_bounds(questions: DataFrame, index: BlockIndex) -> DataFrame:
    """``qid, term, min_pos, weight, df, bound``: a question's kept terms, each with the most it can add to a score."""
    q = bm25_query_terms(questions).join(index.terms, "term")
    w = F.col("qtf") * F.col("idf")
    return q.select("qid", "term", "min_pos", w.alias("weight"), "df", (w * F.col("most")).alias("bound"))


def _postings(terms: DataFrame, blocks: DataFrame, small: bool) -> DataFrame:
    """``qid, row_no, id, part`` (what the posting adds), ``min_pos`` of the questions' ``terms``."""
    t = F.broadcast(terms) if small else terms
    d = blocks.join(t, "term").select("qid", "weight", "min_pos", F.explode("postings").alias("p"))
    return d.select("qid", "p.row_no", "p.id", (F.col("weight") * F.col("p.impact")).alias("part"), "min_pos")


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("qid", "row_no", "id").agg(F.sum("part").alias("score"), F.min("min_pos").alias("first_pos"))


def thresholds(bounds: DataFrame, index: BlockIndex, topk: int, small: bool, seed_factor: int = SEED_FACTOR) -> DataFrame:
    """``qid, least``: a score that at least ``topk`` documents reach, from a question's most selective terms (their postings
    up to ``seed_factor * topk``); 0 when these hold fewer documents."""
    by_use = Window.partitionBy("qid").orderBy((F.col("bound") / F.col("df")).desc(), "term")
    seed = bounds.withColumn("_before", F.coalesce(F.sum("df").over(by_use.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .filter(F.col("_before") < seed_factor * topk)
    scored = _summed(_postings(seed.select("qid", "term", "weight", "min_pos"), index.blocks, small)).select("qid", "row_no", "score")
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "row_no"))).filter(F.col("r") <= topk)
    kth = best.groupBy("qid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    return kth.select("qid", F.when(F.col("n") >= topk, F.col("least") - MARGIN).otherwise(F.lit(0.0)).alias("least"))


def split_terms(bounds: DataFrame, least: DataFrame) -> DataFrame:
    """``bounds`` with ``least``, ``needed`` (a document without a needed term cannot reach it) and ``rest``, the
    bounds of the question's other terms in sum."""
    d = bounds.join(least, "qid", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    up = Window.partitionBy("qid").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("needed", F.sum("bound").over(up) >= F.col("least"))
    every = Window.partitionBy("qid")
    return d.withColumn("rest", F.sum(F.when(~F.col("needed"), F.col("bound")).otherwise(0.0)).over(every))


def bm25_topk_blocks(questions: DataFrame, index: BlockIndex, topk: int = 100, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                     seed_factor: int = SEED_FACTOR, counts: dict | None = None) -> DataFrame:
    """X1 over blocks: the rows of ``bm25_topk``.  ``counts``, if given, gets how many postings each pass joined and how many a
    plain ranking would (three extra counts)."""
    bounds = materialize(query_bounds(questions, index), "bm25-bounds")
    small = bounds.count() <= broadcast_rows  # the question side only
    least = thresholds(bounds, index, topk, small, seed_factor)
    terms = materialize(split_terms(bounds, least), "bm25-split-terms")
    needed = terms.filter("needed").select("qid", "term", "weight", "min_pos")
    others = terms.filter(~F.col("needed")).select("qid", "term", "weight", "min_pos")
    limits = terms.groupBy("qid").agg(F.first("least").alias("least"), F.first("rest").alias("rest"))
    some = _summed(_postings(needed, index.blocks, small))
    some = some.join(limits, "qid").filter(F.col("score") + F.col("rest") >= F.col("least")).drop("rest")
    if others.isEmpty():
        scored, extra = some.drop("least"), None
    else:
        some = materialize(some.withColumn("block", F.floor(F.col("row_no") / index.block_rows)), "bm25-candidates")
        # the blocks of the other terms that hold documents found, with their own largest impacts
        met = some.select("qid", "block").distinct()
        heads = index.blocks.select("term", "block", "most").join(F.broadcast(others) if small else others, "term") \
            .join(met, ["qid", "block"]).select("qid", "block", "term", "weight", "min_pos", (F.col("weight") * F.col("most")).alias("bound"))
        heads = materialize(heads, "bm25-block-heads")
        room = heads.groupBy("qid", "block").agg(F.sum("bound").alias("room"))
        some = some.join(room, ["qid", "block"], "left").filter(F.col("score") + F.coalesce("room", F.lit(0.0)) >= F.col("least"))
        some = materialize(some.select("qid", "block", "row_no", "id", "score", "first_pos"), "bm25-open")
        live = heads.join(some.select("qid", "block").distinct(), ["qid", "block"], "left_semi")
        posts = index.blocks.select("term", "block", "postings").join(live.select("qid", "block", "term", "weight", "min_pos"), ["term", "block"]) \
            .select("qid", "weight", "min_pos", F.explode("postings").alias("p"))
        extra = posts.select("qid", "p.row_no", "p.id", (F.col("weight") * F.col("p.impact")).alias("part"), "min_pos") \
            .join(some.select("qid", "row_no"), ["qid", "row_no"], "left_semi")
        own = some.select("qid", "row_no", "id", F.col("score").alias("part"), F.col("first_pos").alias("min_pos"))
        scored = _summed(own.unionByName(extra))
    if counts is not None:
        every = index.blocks.select("term", "n").join(bounds.select("qid", "term"), "term").agg(F.sum("n")).first()[0] or 0
        counts["plain"] = int(every)
        counts["needed"] = int(index.blocks.select("term", "n").join(needed.select("term"), "term").agg(F.sum("n")).first()[0] or 0)
        counts["rest"] = int(posts.count()) if extra is not None else 0
    ranked = _rank(scored, topk, [F.round("score", TIE_DECIMALS).desc(), F.col("first_pos"), F.col("row_no")])
    return ranked.select("qid", "rank", F.col("id").alias("doc_id"), "score")
