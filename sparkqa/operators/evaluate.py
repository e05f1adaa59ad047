"""Answer matching and Hit@K evaluation.

Hits are ``qid, rank, doc_id, has_answer``.  Each distinct passage in the results is
tokenised once, before it is joined back to the (question, rank) rows; the corpus is
semi-joined to the result ids first so only passages that were retrieved are read past the
scan.  No passage dictionary is broadcast.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkqa.functions.text import match_key, normalize_answer, normalize_nfd, tokenize_unicode
from sparkqa.functions.unicode import nfd_array
from sparkqa.operators.retrieve import result_bound, retrieved_passages


def _answer_keys(answers_col) -> F.Column:
    """Each answer as ``struct(n, key)``: its token count and the framed token string."""
    toks = F.transform(nfd_array(answers_col), lambda a: tokenize_unicode(a))
    return F.transform(toks, lambda t: F.struct(F.size(t).alias("n"), match_key(t).alias("key")))


def has_answer_string(text_key, ans_keys) -> F.Column:
    """True if any answer's tokens are a contiguous run of the passage tokens; an answer with
    no tokens matches every passage (kept from the reference)."""
    return F.exists(ans_keys, lambda a: (a["n"] == 0) | (F.instr(text_key, a["key"]) > 0))


def _retrieved_passages(results: DataFrame, corpus: DataFrame, questions: DataFrame, max_k: int | None):
    return retrieved_passages(results, corpus, result_bound(questions, max_k))


# --- E1 / E2 / E3 --------------------------------------------------------------------------------
def match_string(results: DataFrame, corpus: DataFrame, questions: DataFrame, max_k: int | None = None
                 ) -> DataFrame:
    """Token-run answer match (NFD, Unicode tokens, lower-cased).  ``max_k`` (results per
    question) lets the retrieved ids be broadcast so the corpus is never shuffled."""
    texts = _retrieved_passages(results, corpus, questions, max_k).select(
        F.col("id").alias("doc_id"), F.col("text").isNull().alias("_null"),
        match_key(tokenize_unicode(normalize_nfd("text"))).alias("_tkey"))
    ans = questions.select("qid", _answer_keys(F.coalesce("answers", F.array().cast("array<string>"))).alias("_ak"))
    j = results.join(ans, "qid", "left").join(texts, "doc_id", "left")  # answers first: a text moves once, not with every result
    hit = F.when(F.col("_tkey").isNull() | F.col("_null"), F.lit(False)) \
        .otherwise(F.coalesce(has_answer_string(F.col("_tkey"), F.col("_ak")), F.lit(False)))
    return j.select("qid", "rank", "doc_id", hit.alias("has_answer"))


def _regex_hits(pdf_iter, text_col: str, answers_col: str):
    import unicodedata
    cache: dict = {}

    def compiled(p):
        if p not in cache:
            try:
                cache[p] = regex.compile(unicodedata.normalize("NFD", p),
                                         flags=regex.IGNORECASE + regex.UNICODE + regex.MULTILINE)
            except Exception:  # an invalid pattern is no match
                cache[p] = None
        return cache[p]

    for pdf in pdf_iter:
        out = []
        for text, answers in zip(pdf[text_col], pdf[answers_col]):
            if not isinstance(text, str) or answers is None:
                out.append(False)
                continue
            t = unicodedata.normalize("NFD", text)
            out.append(any((c := compiled(a)) is not None and c.search(t) is not None
                           for a in answers if a is not None))
        yield pd.DataFrame({"qid": pdf["qid"], "rank": pdf["rank"], "doc_id": pdf["doc_id"], "has_answer": out})


def match_regex_constant(results: DataFrame, corpus: DataFrame, questions: DataFrame, patterns: list[str],
                         max_k: int | None = None) -> DataFrame:
    """E2 when every question has the same pattern list: patterns that do not compile are
    dropped on the driver (as the reference treats them: no match), the rest run natively as
    ``rlike`` with ignore-case, Unicode case folding and multi-line flags on the NFD text."""
    import unicodedata
    ok = []
    for p in patterns:
        try:
            regex.compile(p, flags=regex.IGNORECASE + regex.UNICODE + regex.MULTILINE)
            ok.append("(?imu)" + unicodedata.normalize("NFD", p))
        except Exception:  # noqa: BLE001 - an invalid pattern is no match
            continue
    texts = _retrieved_passages(results, corpus, questions, max_k).select(
        F.col("id").alias("doc_id"), normalize_nfd("text").alias("_t"))
    hit = F.lit(False)
    for p in ok:
        hit = hit | F.coalesce(F.col("_t").rlike(p), F.lit(False))
    return results.select("qid", "rank", "doc_id").join(texts, "doc_id", "left") \
        .select("qid", "rank", "doc_id", hit.alias("has_answer"))


def match_regex(results: DataFrame, corpus: DataFrame, questions: DataFrame, max_k: int | None = None
                ) -> DataFrame:
    """Each answer is a pattern searched anywhere (ignore-case, multi-line) in the NFD text;
    an invalid pattern is no match.  Runs in ``mapInPandas`` with a per-batch pattern cache
    because column patterns that fail to compile would fail a native ``rlike``."""
    texts = _retrieved_passages(results, corpus, questions, max_k).select(F.col("id").alias("doc_id"), "text")
    j = results.select("qid", "rank", "doc_id").join(texts, "doc_id", "left") \
        .join(questions.select("qid", "answers"), "qid", "left")
    schema = "qid bigint, rank bigint, doc_id string, has_answer boolean"
    return j.mapInPandas(lambda it: _regex_hits(it, "text", "answers"), schema)


def match_kilt(results: DataFrame, corpus: DataFrame, questions: DataFrame, max_k: int | None = None
               ) -> DataFrame:
    """Normalised answer is a plain substring of the normalised passage."""
    texts = _retrieved_passages(results, corpus, questions, max_k).select(
        F.col("id").alias("doc_id"), normalize_answer("text").alias("_nt"))
    ans = questions.select("qid", F.transform(F.coalesce("answers", F.array().cast("array<string>")),
                                              lambda a: normalize_answer(a)).alias("_na"))
    j = results.join(ans, "qid", "left").join(texts, "doc_id", "left")
    hit = F.coalesce(F.exists("_na", lambda a: F.instr(F.col("_nt"), a) > 0), F.lit(False))
    return j.select("qid", "rank", "doc_id", hit.alias("has_answer"))


MATCHERS = {"string": match_string, "regex": match_regex, "kilt": match_kilt}


# --- E4 ------------------------------------------------------------------------------------------
def match_from_meta(results_with_text: DataFrame, questions: DataFrame, match_type: str = "string",
                    use_title: bool = False, compressed: bool = False) -> DataFrame:
    """Like E1/E2 on text carried in the result rows (``text``, ``title``, zlib bytes with
    ``compressed``); ``kilt`` is not available here and gives no hits."""
    from sparkqa.functions.text import meta_text
    r = results_with_text.withColumn("_mt", meta_text("text", "title", use_title, compressed))
    if match_type == "string":
        ans = questions.select("qid", _answer_keys(F.coalesce("answers", F.array().cast("array<string>"))).alias("_ak"))
        j = r.withColumn("_tkey", match_key(tokenize_unicode(normalize_nfd("_mt")))).join(ans, "qid", "left")
        hit = F.coalesce(has_answer_string(F.col("_tkey"), F.col("_ak")), F.lit(False))
        return j.select("qid", "rank", "doc_id", hit.alias("has_answer"))
    if match_type == "regex":
        j = r.select("qid", "rank", "doc_id", F.col("_mt")).join(questions.select("qid", "answers"), "qid", "left")
        schema = "qid bigint, rank bigint, doc_id string, has_answer boolean"
        return j.mapInPandas(lambda it: _regex_hits(it, "_mt", "answers"), schema)
    return r.select("qid", "rank", "doc_id", F.lit(False).alias("has_answer"))


# --- E5 ------------------------------------------------------------------------------------------
def first_hits(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question (all of them, also those with no results): 1-based rank of the first hit."""
    fh = hits.groupBy("qid").agg(F.min(F.when(F.col("has_answer"), F.col("rank"))).alias("first_hit"))
    return questions.select("qid").join(fh, "qid", "left")


def hit_at_k(hits: DataFrame, questions: DataFrame, max_k: int | None = None) -> DataFrame:
    """E5: ``k, hits, recall`` for k = 1..max_k; recall = questions whose first hit is at rank
    <= k over all questions.  ``max_k`` defaults to the longest result list (not the first
    question's, which may be empty).  The per-rank counts and the k grid are at most max_k rows."""
    spark: SparkSession = hits.sparkSession
    if max_k is None:
        max_k = int(hits.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0])
    fh = first_hits(hits, questions)
    per_rank = fh.filter(F.col("first_hit").isNotNull()).groupBy(F.col("first_hit").alias("k")) \
        .agg(F.count(F.lit(1)).alias("n"))
    n_q = questions.count()
    grid = spark.range(1, int(max_k) + 1).select(F.col("id").cast("bigint").alias("k"))
    # max_k rows on both sides: an equi-join on k and a running sum over the k grid
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    acc = grid.join(F.broadcast(per_rank), "k", "left") \
        .select("k", F.sum(F.coalesce("n", F.lit(0))).over(w).cast("bigint").alias("hits"))
    return acc.select("k", "hits", (F.col("hits") / F.lit(n_q) if n_q > 0 else F.lit(None).cast("double"))
                      .alias("recall"))


# --- E6 / E8 -------------------------------------------------------------------------------------
def validate(results: DataFrame, corpus: DataFrame, questions: DataFrame, match_type: str = "string",
             max_k: int = 100) -> tuple[DataFrame, DataFrame]:
    """(hits, recall-at-k) for one ranked result set."""
    hits = MATCHERS[match_type](results, corpus, questions, max_k)
    return hits, hit_at_k(hits, questions, max_k)


def compare_models(recalls: dict, ks=(1, 10, 20, 50, 100)) -> DataFrame:
    """Hit@k per model side by side (one row per k, one column per model)."""
    frames = [df.filter(F.col("k").isin(list(ks))).select("k", F.lit(name).alias("model"), "recall")
              for name, df in recalls.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("k").pivot("model", list(recalls)).agg(F.first("recall"))


# --- E7 ------------------------------------------------------------------------------------------
def match_table_chunks(results: DataFrame, chunks: DataFrame, questions: DataFrame, max_k: int
                       ) -> tuple[DataFrame, DataFrame]:
    """Chunk-level and table-level Hit@k.

    ``chunks(id, text, title, table_id)``.  Chunk hit = E1 on the chunk text; table hit = E1
    on any chunk of the same table (the per-chunk hits are aggregated per (question, table)).
    ``max_k`` is how far the report goes; ``results`` may be longer.
    """
    corpus = chunks.select("id", "text", "title", F.lit(0).cast("bigint").alias("row_no"))
    chunk_hits = match_string(results, corpus, questions)
    tbl = chunks.select(F.col("id").alias("_cid"), "table_id")
    # every chunk of every table that appears in a question's results
    r_tables = results.join(tbl, results["doc_id"] == tbl["_cid"]).select("qid", "rank", "table_id")
    all_chunks = r_tables.select("qid", "table_id").distinct().join(tbl, "table_id") \
        .select("qid", "table_id", F.col("_cid").alias("doc_id"), F.lit(0).cast("bigint").alias("rank"))
    any_hit = match_string(all_chunks, corpus, questions).join(
        all_chunks.select("qid", "doc_id", "table_id"), ["qid", "doc_id"]) \
        .groupBy("qid", "table_id").agg(F.max(F.col("has_answer").cast("int")).alias("_t"))
    table_hits = r_tables.join(any_hit, ["qid", "table_id"], "left") \
        .select("qid", "rank", F.col("table_id").cast("string").alias("doc_id"),
                (F.coalesce("_t", F.lit(0)) == 1).alias("has_answer"))
    return hit_at_k(chunk_hits, questions, max_k), hit_at_k(table_hits, questions, max_k)
