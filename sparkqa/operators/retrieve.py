"""Ranking: BM25 and TF-IDF top-k, id normalisation and passage lookup.

Ranked results are long-form ``qid BIGINT, rank BIGINT, doc_id STRING, score DOUBLE``
(rank 1-based).  Every top-k is ``row_number() <= k`` over ``partition by qid``, which
Spark plans as a ``WindowGroupLimit`` on both sides of the shuffle, so no task holds more
than k candidates per question.

Postings of the asked terms are dealt out by document; a task adds up the scores of its documents and keeps the best k a
question, so (question, document) pairs, which grow with the product of both, are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.functions.stopwords import ENGLISH_STOP_WORDS
from sparkqa.functions.text import tokenize_alnum
from sparkqa.operators.index import Bm25Index, TfidfIndex, tfidf_doc_terms
from sparkqa.operators.util import DEFAULT_BROADCAST_ROWS

# Scores are compared after rounding to this many decimals, so summation order (which differs
# between runs and engines) cannot reorder ties.
TIE_DECIMALS = 9


def _rank(scored: DataFrame, topk: int, order) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= topk)


# (question, posting) pairs that a task adds up at once
SCORE_PAIRS = 2_000_000


def _best(held: list, topk: int, n_q: int) -> tuple[list, np.ndarray]:
    """The first ``topk`` candidates of each question, by rounded score, first position and row; and the score a new one must reach."""
    q, r, first, row = (np.concatenate([h[i] for h in held]) for i in range(4))
    o = np.lexsort((row, first, -r, q))
    starts = np.searchsorted(q[o], np.arange(n_q))
    o = o[np.arange(len(o)) - starts[q[o]] < topk]
    full = np.bincount(q[o], minlength=n_q) >= topk
    last = np.cumsum(np.bincount(q[o], minlength=n_q)) - 1
    least = np.where(full, r[o][np.maximum(last, 0)] if len(o) else 0.0, -np.inf)
    score = np.concatenate([h[4] for h in held])
    ids = pa.concat_arrays([h[5] for h in held]).take(pa.array(o))
    return [(q[o], r[o], first[o], row[o], score[o], ids)], least


def _top_rows(it, shared, topk: int):
    """Batches of postings (row_no, id, t, v), sorted by row_no, to the best ``topk`` documents a question among them."""
    qids, begin, of, weight, place = shared.value
    n_q, many = len(qids), np.diff(begin)
    held, waiting, least = [], 0, np.full(n_q, -np.inf)

    def add(rows: pa.RecordBatch):
        nonlocal held, waiting, least
        row, t, v = (np.asarray(rows.column(c)) for c in ("row_no", "t", "v"))
        edge = np.flatnonzero(np.diff(row, prepend=row[0] - 1))           # the first posting of each document
        pairs = np.cumsum(many[t])
        i = 0
        while i < len(edge):                                              # whole documents, SCORE_PAIRS pairs at once
            a = edge[i]
            j = max(int(np.searchsorted(pairs[np.append(edge[1:], len(row)) - 1], (pairs[a - 1] if a else 0) + SCORE_PAIRS, "right")), i + 1)
            b = edge[j] if j < len(edge) else len(row)
            n = many[t[a:b]]
            at = np.repeat(begin[t[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            doc = np.repeat(np.searchsorted(edge[i:j], np.arange(a, b), "right") - 1, n)
            key, part = doc * n_q + of[at], weight[at] * np.repeat(v[a:b], n)
            cells = (j - i) * n_q
            if cells > 4 * len(key):                                      # few questions ask for a document: number its pairs
                found, key = np.unique(key, return_inverse=True)
            else:
                there = np.zeros(cells, bool)
                there[key] = True
                found = np.flatnonzero(there)
                there = np.cumsum(there)
                key = there[key] - 1
            total = np.bincount(key, part, len(found))
            r = np.round(total, TIE_DECIMALS)
            near = r >= least[found % n_q]
            spot = np.where(near, np.cumsum(near) - 1, -1)[key]
            own = np.flatnonzero(spot >= 0)
            found, total, r = found[near], total[near], r[near]
            first = np.full(len(found), np.iinfo(np.int64).max)
            np.minimum.at(first, spot[own], place[at[own]])
            which = edge[i + found // n_q]
            held.append((found % n_q, r, first, row[which], total, rows.column("id").take(pa.array(which))))
            waiting += len(found)
            if waiting > max(SCORE_PAIRS // 4, n_q * topk):
                held, least = _best(held, topk, n_q)
                waiting = 0
            i = j

    rest = None
    for batch in it:
        if not batch.num_rows:
            continue
        whole = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        row = np.asarray(whole.column("row_no"))
        cut = int(np.searchsorted(row, row[-1]))                          # the last document may go on
        if cut:
            add(whole.slice(0, cut))
        rest = whole.slice(cut)
    if rest is not None:
        add(rest)
    if held:
        (q, r, first, row, score, ids), = _best(held, topk, n_q)[0]
        yield pa.RecordBatch.from_arrays([qids.take(pa.array(q)), pa.array(row), ids, pa.array(score), pa.array(r), pa.array(first)],
                                         ["qid", "row_no", "id", "score", "_r", "first_pos"])


def _asked(queries: DataFrame) -> tuple[DataFrame, tuple]:
    """Query terms (qid, term, wq, pos and columns of the term) that a count proved few: a row a term with its number ``t`` and its columns,
    and the questions of each term as arrays."""
    got = queries.toArrow()
    got = got.set_column(got.schema.get_field_index("term"), "term", got.column("term").cast(pa.string()))
    qid = got.column("qid").combine_chunks().dictionary_encode(null_encoding="encode")
    coded = got.column("term").combine_chunks().dictionary_encode()
    number = np.empty(len(coded.dictionary), np.int64)  # by term, so that a sum's order is always the same
    number[np.asarray(pc.sort_indices(coded.dictionary))] = np.arange(len(number))
    t = number[np.asarray(coded.indices)]
    o = np.argsort(t, kind="stable")
    begin = np.searchsorted(t[o], np.arange(len(coded.dictionary) + 1))
    one = got.take(pa.array(o[begin[:-1]])).drop_columns(["qid", "wq", "pos"]).append_column("t", pa.array(np.arange(len(begin) - 1)))
    arrays = (qid.dictionary, begin, np.asarray(qid.indices).astype(np.int64)[o], np.asarray(got.column("wq")).astype(np.float64)[o],
              np.asarray(got.column("pos")).astype(np.int64)[o])
    return queries.sparkSession.createDataFrame(one), arrays


def _scored_top(postings: DataFrame, value, queries: DataFrame, keys: list[str], topk: int, live: DataFrame | None = None) -> DataFrame:
    """``qid, row_no, id, score, _r, first_pos``: of the documents of each task, the best ``topk`` of each question.

    ``postings`` (row_no, id and ``keys``) meet the asked terms as a broadcast, ``value`` is a posting's share of a score; postings of
    asked terms are dealt out by document, once, whatever the number of questions.  With ``live`` (doc, row_no, id), ``row_no`` of the postings is a
    document's number, and documents that it does not list have no row any more."""
    terms, arrays = _asked(queries)
    shared = queries.sparkSession.sparkContext.broadcast(arrays)
    met = postings.join(F.broadcast(terms), keys).select("row_no", "id", "t", value.cast("double").alias("v"))
    if live is not None:
        met = met.select(F.col("row_no").alias("doc"), "t", "v").join(live, "doc").select("row_no", "id", "t", "v")
    n_parts = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = met.repartition(n_parts, "row_no").sortWithinPartitions("row_no", "t")
    kinds = dict(queries.dtypes)["qid"], dict(postings.dtypes)["id"]
    return met.mapInArrow(lambda it: _top_rows(it, shared, topk),
                          f"qid {kinds[0]}, row_no bigint, id {kinds[1]}, score double, _r double, first_pos bigint")


# --- X1 ------------------------------------------------------------------------------------------
def bm25_query_terms(questions: DataFrame) -> DataFrame:
    """Query side of X1: ``(qid, term, qtf, min_pos)``; repeated words count once each."""
    qt = questions.select("qid", F.posexplode(tokenize_alnum("question")).alias("pos", "term"))
    return qt.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"), F.min("pos").alias("min_pos"))


def bm25_topk(questions: DataFrame, index: Bm25Index, topk: int = 100,
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Top-``topk`` BM25 passages per question.

    score = sum over query-token occurrences of idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)).
    Only documents sharing a kept term appear; ties keep the order of the first matching query
    position, then corpus order.  The query terms (joined to the pruned vocabulary and the
    one-row statistics) are broadcast when a count proves them small, and the postings of asked terms
    are dealt out by document, so what moves grows with the postings, not with questions times
    documents.  Above the bound the join is a shuffle join salted ``salts``
    ways, so a term held by a large share of all documents is split over that many tasks.
    """
    q = bm25_query_terms(questions)
    # the size check counts the question side only (never the index); joining the vocabulary
    # can only shrink it
    small = q.count() <= broadcast_rows
    st = index.stats.first()                      # one row: read as scalars
    avgdl = float(st["avgdl"]) if st["avgdl"] > 0 else 1.0
    qv = q.join(index.vocab.select("term", "idf"), "term").select(
        "*", F.lit(avgdl).alias("avgdl"), F.lit(float(st["k1"])).alias("k1"), F.lit(float(st["b"])).alias("b"))
    keys, postings = ["term"], index.postings
    if index.n_buckets and "term_bucket" in postings.columns:
        # a saved index is partitioned by term bucket: read only the buckets of the query terms
        # (at most n_buckets small integers reach the driver) - partition pruning at the scan
        bucket = F.pmod(F.xxhash64("term"), F.lit(index.n_buckets)).cast("int")
        wanted = [r[0] for r in q.select(bucket.alias("b")).distinct().collect()]
        postings = postings.filter(F.col("term_bucket").isin(wanted))
        qv = qv.withColumn("term_bucket", bucket)
        keys = ["term_bucket", "term"]
    w = F.col("idf") * (F.col("tf") * (F.col("k1") + 1.0)) / (
        F.col("tf") + F.col("k1") * (1.0 - F.col("b") + F.col("b") * (F.col("dl") / F.col("avgdl"))))
    if small:
        scored = _scored_top(postings, w, qv.withColumnsRenamed({"qtf": "wq", "min_pos": "pos"}), keys, topk, index.live)
    else:
        # shuffle join: a kept term may hold up to max_df_ratio of all documents, so spread
        # every term's postings over `salts` partitions and replicate the query terms to match
        salt = F.pmod(F.xxhash64("row_no"), F.lit(salts)).cast("int")
        qs_ = qv.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cand = postings.withColumn("_salt", salt).join(qs_, keys + ["_salt"]).drop("_salt")
        scored = cand.groupBy("qid", "row_no", "id").agg(F.sum(F.col("qtf") * w).alias("score"),
                                                          F.min("min_pos").alias("first_pos"))
        if index.live is not None:
            scored = scored.select("qid", F.col("row_no").alias("doc"), "score", "first_pos").join(index.live, "doc")
        scored = scored.withColumn("_r", F.round("score", TIE_DECIMALS))
    ranked = _rank(scored, topk, [F.col("_r").desc(), F.col("first_pos"), F.col("row_no")])
    return ranked.select("qid", "rank", F.col("id").alias("doc_id"), "score")


# --- X2 ------------------------------------------------------------------------------------------
def normalize_doc_ids(results: DataFrame, corpus: DataFrame, max_results: int | None = None) -> DataFrame:
    """Keep ids found in the corpus; map integer ids 0 <= i < n to the id of corpus row i;
    drop the rest.  Order is kept and ranks are renumbered; scores become strings.

    ``corpus.row_no`` must be the 0-based file position.  Both lookups are equi-joins, the id
    side de-duplicated first so a result row never multiplies.  With a bound on result rows
    (``max_results``, e.g. k x questions) the corpus is first filtered map-side by a broadcast
    of the result ids, so only matching ids are de-duplicated or joined.
    """
    ids = corpus.select(F.col("id").alias("_kid"))
    by_pos = corpus.select(F.col("row_no").alias("_pos"), F.col("id").alias("_pid"))
    if max_results is not None and max_results <= DEFAULT_BROADCAST_ROWS:
        wanted = F.broadcast(results.select(F.col("doc_id").alias("_kid")).distinct())
        ids = ids.join(wanted, "_kid", "left_semi")
        wanted_pos = F.broadcast(results.select(F.expr("try_cast(doc_id as bigint)").alias("_pos"))
                                 .filter(F.col("_pos").isNotNull()).distinct())
        by_pos = by_pos.join(wanted_pos, "_pos", "left_semi")
    ids = ids.distinct().withColumn("_known", F.lit(True))
    r = results.join(ids, results["doc_id"] == ids["_kid"], "left")
    r = r.withColumn("_asint", F.when(F.col("_known").isNull(), F.expr("try_cast(doc_id as bigint)")))
    r = r.join(by_pos, r["_asint"] == by_pos["_pos"], "left")
    r = r.withColumn("_new", F.when(F.col("_known"), F.col("doc_id")).otherwise(F.col("_pid")))
    r = r.filter(F.col("_new").isNotNull())
    w = Window.partitionBy("qid").orderBy("rank")
    return r.select("qid", F.row_number().over(w).cast("bigint").alias("rank"),
                    F.col("_new").alias("doc_id"), F.col("score").cast("string").alias("score"))


# --- X3 ------------------------------------------------------------------------------------------
def tfidf_query_vectors(questions: DataFrame, index: TfidfIndex, stop_words=ENGLISH_STOP_WORDS,
                        ngram_max: int = 2) -> DataFrame:
    """Query side of X3: ``(qid, term, wq)``, same weighting as documents, L2-normalised;
    terms outside the vocabulary are ignored."""
    qt = tfidf_doc_terms(questions.select("qid", "question"), "qid", F.col("question"), stop_words, ngram_max)
    raw = qt.join(index.vocab.select("term", "idf"), "term").select(
        "qid", "term", (F.col("tf") * F.col("idf")).alias("raw"))
    norm = raw.groupBy("qid").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norm, "qid").select("qid", "term", (F.col("raw") / F.col("norm")).cast("float").alias("wq"))


def tfidf_topk(questions: DataFrame, index: TfidfIndex, corpus: DataFrame, topk: int = 100,
               pad: bool = True, stop_words=ENGLISH_STOP_WORDS, ngram_max: int = 2,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Top-``topk`` cosine (dot product of L2-normalised vectors) per question.

    With ``pad`` every question gets exactly min(topk, n_docs) rows: questions with m < k
    matching documents are filled with score-0 documents in corpus order, taken from the
    first k corpus rows (those hold at least k - m unmatched documents); those k ids are
    expanded per short question, never joined against the corpus.
    """
    qt = tfidf_doc_terms(questions.select("qid", "question"), "qid", F.col("question"), stop_words, ngram_max)
    small = qt.count() <= broadcast_rows
    qv = tfidf_query_vectors(questions, index, stop_words, ngram_max)
    if small:
        scored = _scored_top(index.weights.withColumn("id", F.lit(None).cast("string")), F.col("w"),
                             qv.withColumn("pos", F.lit(0)), ["term"], topk)
    else:
        # TF-IDF keeps common terms, so the shuffle join is salted like BM25's
        salt = F.pmod(F.xxhash64("row_no"), F.lit(salts)).cast("int")
        qs_ = qv.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cand = index.weights.withColumn("_salt", salt).join(qs_, ["term", "_salt"]).drop("_salt")
        scored = cand.groupBy("qid", "row_no").agg(
            F.sum(F.col("wq").cast("double") * F.col("w").cast("double")).alias("score")) \
            .withColumn("_r", F.round("score", TIE_DECIMALS))
    order = [F.col("_r").desc(), F.col("row_no")]
    ranked = _rank(scored, topk, order).select("qid", "rank", "row_no", "score")
    # ids for the ranked rows only: at most topk per question, so that side is broadcast and
    # the corpus id column is streamed
    n_q = questions.count()
    ranked_b = F.broadcast(ranked) if topk * n_q <= broadcast_rows else ranked
    ranked = corpus.select("row_no", F.col("id").alias("doc_id")).join(ranked_b, "row_no") \
        .select("qid", "rank", "row_no", "doc_id", "score")
    if not pad:
        return ranked.drop("row_no")
    # the first k corpus rows (k rows reach the driver: a proven bound) become a literal array;
    # each short question expands it, drops the documents it already has and keeps the first
    # k - m, so no join pairs questions with corpus rows
    first_k = corpus.select("row_no", F.col("id").alias("doc_id")).orderBy("row_no").limit(int(topk)).collect()
    cands = F.array(*[F.struct(F.lit(r["row_no"]).cast("bigint").alias("row_no"), F.lit(r["doc_id"]).alias("doc_id"))
                      for r in first_k]) if first_k else F.array().cast("array<struct<row_no:bigint,doc_id:string>>")
    got = ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("_m"))
    short = questions.select("qid").join(got, "qid", "left") \
        .select("qid", F.coalesce("_m", F.lit(0)).alias("_m")).filter(F.col("_m") < topk)
    fill = short.select("qid", "_m", F.explode(cands).alias("_c")).select("qid", "_m", "_c.row_no", "_c.doc_id") \
        .join(ranked.select("qid", "row_no"), ["qid", "row_no"], "left_anti")
    wf = Window.partitionBy("qid").orderBy("row_no")
    fill = fill.withColumn("_r", F.row_number().over(wf)).filter(F.col("_r") + F.col("_m") <= topk) \
        .select("qid", (F.col("_r") + F.col("_m")).cast("bigint").alias("rank"), "row_no", "doc_id",
                F.lit(0.0).alias("score"))
    return ranked.unionByName(fill).drop("row_no")


# --- X4 / X5 -------------------------------------------------------------------------------------
def passages_last_wins(corpus: DataFrame) -> DataFrame:
    """Evaluation view of the corpus: one row per id, the last duplicate (highest row_no) wins.

    An aggregate (partial on the map side) rather than a window, so an id repeated on a
    third of all rows still never gathers into one task.
    """
    last = corpus.groupBy("id").agg(F.max_by(F.struct("text", "title", "row_no"), F.col("row_no")).alias("_p"))
    return last.select("id", "_p.text", "_p.title", "_p.row_no")


def retrieved_passages(results: DataFrame, corpus: DataFrame, max_results: int | None = None) -> DataFrame:
    """The corpus rows whose id appears in ``results``, last duplicate winning.

    The corpus is filtered *before* the dedupe.  When the number of result rows has a proven
    bound (``max_results`` = k x number of questions) under the broadcast limit, the distinct
    result ids are broadcast and the corpus is filtered map-side: no passage text is shuffled.
    Without a bound the semi-join is a shuffle join (AQE may still broadcast it at run time).
    """
    ids = results.select(F.col("doc_id").alias("id")).distinct()
    if max_results is not None and max_results <= DEFAULT_BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return passages_last_wins(corpus.join(ids, "id", "left_semi"))


def result_bound(questions: DataFrame, max_k: int | None) -> int | None:
    """Upper bound on result rows: k per question (one cheap count of the question table)."""
    return None if max_k is None else int(max_k) * questions.count()


def passage_lookup(results: DataFrame, corpus: DataFrame, max_results: int | None = None) -> DataFrame:
    """Results with ``text`` and ``title`` (left join; unknown ids keep null text and are
    flagged with ``found = false`` instead of failing the job)."""
    p = retrieved_passages(results, corpus, max_results).select(
        F.col("id").alias("doc_id"), "text", "title", F.lit(True).alias("found"))
    out = results.join(p, "doc_id", "left")
    return out.withColumn("found", F.coalesce("found", F.lit(False)))


def lookup_by_question(left: DataFrame, right: DataFrame, key: str = "question") -> DataFrame:
    """Left join on the question text (the right side must have distinct keys)."""
    return left.join(right, key, "left")
