"""Sinks (K1-K9): result reports, recall CSV, result and index persistence, table passages,
QA TSV, context-match shards, KILT provenance and reader sample parts.

Writers are plain ``DataFrameWriter`` calls (JSON lines, CSV, Parquet); nothing is gathered on
the driver.  A saved BM25 index stores postings partitioned by a term-hash bucket, so a later
query reads only the buckets of its terms.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.functions.stopwords import ENGLISH_STOP_WORDS
from sparkqa.operators.index import Bm25Index
from sparkqa.operators.util import global_row_number
from sparkqa.sources.files import TSV_OPTIONS


def write_tsv(df: DataFrame, path: str, header: bool = False, sep: str = "\t", mode: str = "overwrite") -> None:
    """Tab CSV with standard quoting (doubled quotes), readable by ``read_tsv``."""
    df.write.mode(mode).options(**{**TSV_OPTIONS, "sep": sep, "header": str(header).lower(),
                                   "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                                   "quoteAll": "false"}).csv(path)


def write_json_arrays(df: DataFrame, path: str, member: str | None = None) -> None:
    """One JSON array file per partition (the layout of JSON-array inputs), written as one line a
    record, so no task holds more than a batch.  With ``member`` the file is an object with the array as its member."""
    start, end = (json.dumps({member: []})[:-2], "]}") if member else ("[", "]")

    def lines(batches):
        import pyarrow as pa
        lead = start
        for b in batches:
            out = []
            for x in b.column(0).to_pylist():
                out.append(lead + x)
                lead = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([end if lead == "," else start + end])], ["value"])

    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias("value"))
    rows.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def py_list_literal(c) -> F.Column:
    """A Python list literal of strings (``str(list)``), e.g. ``['a', "b's"]``."""
    col = F.col(c) if isinstance(c, str) else c

    def one(s):
        esc = F.replace(F.replace(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")),
                                  F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
        dq = F.contains(esc, F.lit("'")) & ~F.contains(esc, F.lit('"'))
        return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))) \
            .otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(col, one), ", "), F.lit("]"))


# --- K1 ------------------------------------------------------------------------------------------
def result_report(results: DataFrame, questions: DataFrame, corpus: DataFrame, hits: DataFrame,
                  no_text: bool = False, max_k: int | None = None) -> DataFrame:
    """K1: per question ``question, answers, hit_min_rank, all_hits, ctxs[]`` in rank order.

    ``ctxs`` = {id, rank, title, text (or "" with ``no_text``), score as string, has_answer}.
    Each question's list is bounded by k, so the ordered ``collect_list`` is bounded.
    """
    from sparkqa.operators.retrieve import result_bound, retrieved_passages
    p = retrieved_passages(results, corpus, result_bound(questions, max_k)).select(
        F.col("id").alias("doc_id"), "text", "title")
    r = results.join(hits.select("qid", "rank", "has_answer"), ["qid", "rank"], "left") \
        .join(p, "doc_id", "left")
    ctx = F.struct(F.col("rank").alias("rank"), F.col("doc_id").alias("id"), F.col("title"),
                   (F.lit("") if no_text else F.coalesce("text", F.lit(""))).alias("text"),
                   F.col("score").cast("string").alias("score"),
                   F.coalesce("has_answer", F.lit(False)).alias("has_answer"))
    per_q = r.groupBy("qid").agg(
        F.min(F.when(F.col("has_answer"), F.col("rank"))).alias("hit_min_rank"),
        F.array_sort(F.collect_list(F.when(F.col("has_answer"), F.col("rank")))).alias("all_hits"),
        F.array_sort(F.collect_list(ctx)).alias("ctxs"))
    out = questions.select("qid", "question", "answers").join(per_q, "qid", "left")
    return out.select("qid", "question", "answers", "hit_min_rank",
                      F.coalesce("all_hits", F.array().cast("array<bigint>")).alias("all_hits"),
                      F.coalesce("ctxs", F.array().cast(per_q.schema["ctxs"].dataType)).alias("ctxs"))


def write_result_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


# --- K2 ------------------------------------------------------------------------------------------
def write_recall(recall: DataFrame, path: str) -> None:
    """K2: ``k,recall`` lines, k from 1 (one small file: at most max_k rows)."""
    recall.select("k", "recall").coalesce(1).sortWithinPartitions("k").write.mode("overwrite").csv(path)


# --- K3 ------------------------------------------------------------------------------------------
def save_results(results: DataFrame, path: str) -> None:
    """K3: the long result table as Parquet (never pickle)."""
    results.write.mode("overwrite").parquet(path)


def load_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def term_bucket(term, n_buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


# --- K4 ------------------------------------------------------------------------------------------
def index_path(root: str, model: str, params: dict, corpus_id: str) -> str:
    """Model, parameters and corpus identity in the path, so two models never share a path."""
    p = "-".join(f"{k}={params[k]}" for k in sorted(params))
    return f"{root.rstrip('/')}/{model}/{p}/{corpus_id}"


def save_bm25_index(index: Bm25Index, path: str, n_buckets: int = 64) -> None:
    """K4: postings pruned to the vocabulary, stored partitioned by ``term_bucket`` (a hash of
    the term) and sorted by (term, row_no) inside each bucket; vocab and the one-row stats
    beside them.

    A query filters ``term_bucket`` to the buckets of its terms (partition pruning at the scan)
    and joins on (term_bucket, term); a hot term's postings stay in one bucket folder but are
    split across files by the range sort on (term, row_no).
    """
    post = index.postings.join(index.vocab.select("term"), "term", "left_semi") \
        .withColumn("term_bucket", term_bucket(F.col("term"), n_buckets))
    post.repartitionByRange("term_bucket", "term", "row_no").sortWithinPartitions("term", "row_no") \
        .write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/postings")
    index.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    index.stats.withColumn("n_buckets", F.lit(n_buckets)).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def load_bm25_index(spark: SparkSession, path: str) -> Bm25Index:
    # the schema is given: an index whose vocabulary is empty has no files
    post = spark.read.schema("row_no bigint, id string, dl int, term string, tf bigint, term_bucket int").parquet(f"{path}/postings")
    return Bm25Index(post, spark.read.parquet(f"{path}/vocab"),
                     spark.read.parquet(f"{path}/stats"), n_buckets=_bucket_count(spark, path))


def _bucket_count(spark: SparkSession, path: str) -> int | None:
    st = spark.read.parquet(f"{path}/stats")
    return int(st.first()["n_buckets"]) if "n_buckets" in st.columns else None


def corpus_fingerprint(corpus: DataFrame, columns: tuple) -> str:
    """Row count and an order-free hash sum of what an index reads."""
    r = corpus.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0))).first()
    return f"{r[0]}:{r[1]}"


def _reusable(spark: SparkSession, path: str, identity: dict) -> bool:
    """Whether the index at ``path`` was built with these parameters from this corpus.  Only a missing
    path means no; any other error is raised, and the saved index stays as it is."""
    from pyspark.errors import AnalysisException
    try:
        saved = spark.read.schema("identity string").json(f"{path}/identity").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return saved is not None and saved["identity"] == json.dumps(identity, sort_keys=True)


def _save_identity(spark: SparkSession, path: str, identity: dict) -> None:
    """Written last, so a broken save is never taken for an index."""
    spark.createDataFrame([(json.dumps(identity, sort_keys=True),)], "identity string").coalesce(1) \
        .write.mode("overwrite").json(f"{path}/identity")


def load_or_build_bm25(spark: SparkSession, corpus: DataFrame, path: str, force_rebuild: bool = False,
                       k1: float = 1.2, b: float = 0.75, min_df: int = 2, max_df_ratio: float = 0.3) -> Bm25Index:
    """K4: reuse a saved index unless forced, when every parameter and the corpus are the same."""
    from sparkqa.operators.index import build_bm25_index
    params = {"k1": float(k1), "b": float(b), "min_df": int(min_df), "max_df_ratio": float(max_df_ratio)}
    identity = {"model": "bm25", "corpus": corpus_fingerprint(corpus, ("row_no", "id", "text"))} | params
    if force_rebuild or not _reusable(spark, path, identity):
        save_bm25_index(build_bm25_index(corpus, **params), path)
        _save_identity(spark, path, identity)
    return load_bm25_index(spark, path)


# --- K5 ------------------------------------------------------------------------------------------
def table_passages(tables: DataFrame) -> DataFrame:
    """K5 rows: ``[1-based id, T5 text, caption]`` in table order (``tables`` from T2/T5)."""
    return tables.select((F.col("table_no") + 1).cast("bigint").alias("id"), "table_text", "caption")


# --- K6 ------------------------------------------------------------------------------------------
def qa_jsonl_to_tsv(qa: DataFrame) -> DataFrame:
    """K6 rows: question + ``short_answers`` (default ``[]``) as a Python list literal."""
    return qa.select("question", py_list_literal(F.coalesce("short_answers", F.array().cast("array<string>")))
                     .alias("answers"))


# --- K7 ------------------------------------------------------------------------------------------
def ctx_match_shards(training: DataFrame, shard_size: int = 3000) -> DataFrame:
    """K7: samples with positives; first positive rendered as ``caption . `` + rows (cells joined
    by `` . ``, rows appended with no separator) + `` . ``; id = running index over samples in
    order; shard = id // shard_size.  Write with ``.write.partitionBy('shard')``."""
    has = training.filter(F.size("positive_ctxs") > 0)
    first = F.get(F.col("positive_ctxs"), 0)
    rows_txt = F.array_join(F.transform(F.array_sort(first["rows"]),
                                        lambda r: F.array_join(F.transform(F.array_sort(r["columns"]),
                                                                           lambda c: c["value"]), " . ")), "")
    text = F.concat(first["caption"], F.lit(" . "), rows_txt, F.lit(" . "))
    numbered = global_row_number(has.select("sample_no", "question", text.alias("text")), ["sample_no"], "id")
    return numbered.select("id", (F.col("id") / shard_size).cast("bigint").alias("shard"), "question", "text")


# --- K8 ------------------------------------------------------------------------------------------
def to_kilt_provenance(results: DataFrame, mapping: DataFrame, gold: DataFrame) -> DataFrame:
    """K8: per question (aligned by ``qid``) id and input from gold, ``provenance[]`` of
    (wikipedia_id, end_paragraph_id) for each ranked context via ``mapping(ctx_id, ...)``.
    ``missing`` counts contexts absent from the mapping (the reference fails on them)."""
    m = mapping.select(F.col("ctx_id").cast("bigint").alias("_cid"), "wikipedia_id", "end_paragraph_id")
    r = results.withColumn("_cid", F.expr("try_cast(doc_id as bigint)")).join(m, "_cid", "left")
    prov = r.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "wikipedia_id", "end_paragraph_id"))).alias("_p"),
        F.sum(F.when(F.col("wikipedia_id").isNull(), 1).otherwise(0)).cast("bigint").alias("missing"))
    out = gold.select("qid", "id", "input").join(prov, "qid", "left")
    return out.select("qid", "id", "input",
                      F.transform(F.coalesce("_p", F.array().cast(prov.schema["_p"].dataType)),
                                  lambda x: F.struct(x["wikipedia_id"].alias("wikipedia_id"),
                                                     x["end_paragraph_id"].alias("end_paragraph_id")))
                      .alias("provenance"),
                      F.coalesce("missing", F.lit(0)).alias("missing"))


# --- K9 ------------------------------------------------------------------------------------------
def write_reader_samples(samples: DataFrame, path: str, n_parts: int | None = None) -> None:
    """K9: prepared reader samples as numbered Parquet part files."""
    (samples.repartition(n_parts) if n_parts else samples).write.mode("overwrite").parquet(path)


def read_reader_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_tfidf_index(index, path: str) -> None:
    """K4 for TF-IDF: weights sorted by (term, row_no), vocabulary and the one-row stats."""
    index.weights.repartitionByRange("term", "row_no").sortWithinPartitions("term", "row_no") \
        .write.mode("overwrite").parquet(f"{path}/weights")
    index.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    index.stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def load_tfidf_index(spark: SparkSession, path: str):
    from sparkqa.operators.index import TfidfIndex
    return TfidfIndex(spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/vocab"),
                      spark.read.parquet(f"{path}/stats"))


def load_or_build_tfidf(spark: SparkSession, corpus: DataFrame, path: str, force_rebuild: bool = False,
                        max_features: int = 200_000, ngram_max: int = 2, stop_words=ENGLISH_STOP_WORDS):
    """K4 for TF-IDF: reuse a saved index unless forced, when every parameter and the corpus are the same."""
    from sparkqa.operators.index import build_tfidf_index
    identity = {"model": "tfidf", "corpus": corpus_fingerprint(corpus, ("row_no", "id", "text", "title")), "max_features": int(max_features),
                "ngram_max": int(ngram_max), "stop_words": sorted(stop_words or ())}
    if force_rebuild or not _reusable(spark, path, identity):
        save_tfidf_index(build_tfidf_index(corpus, max_features=max_features, ngram_max=ngram_max, stop_words=stop_words), path)
        _save_identity(spark, path, identity)
    return load_tfidf_index(spark, path)
