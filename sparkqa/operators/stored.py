"""Evaluation over stored tables that lie in the same buckets: passages by id, results by document id.

The passages are stored once with their answer-matching tokens; every evaluation then joins results to them bucket by bucket, so neither
side moves and no passage is tokenised again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.functions.text import match_key, normalize_nfd, tokenize_unicode
from sparkqa.operators.evaluate import _answer_keys, has_answer_string
from sparkqa.operators.retrieve import passages_last_wins
from sparkqa.session import scratch_path


def store_passages(corpus: DataFrame, table: str, n_buckets: int = 64) -> None:
    """``id, text, title, tokens`` of the evaluation view (the last row of an id wins), bucketed and sorted by id.  The texts are
    dealt to their buckets first and move once: the last row of an id is found where its bucket is written."""
    p = passages_last_wins(corpus.repartition(n_buckets, "id")).select("id", "text", "title", match_key(tokenize_unicode(normalize_nfd("text"))).alias("tokens"))
    _store(p, "id", table, n_buckets)


def _store(dealt: DataFrame, key: str, table: str, n_buckets: int) -> None:
    """A table in the shared folder of rows dealt out by ``key``, one file a bucket, sorted."""
    dealt.write.mode("overwrite").option("path", scratch_path(dealt.sparkSession, table)) \
        .bucketBy(n_buckets, key).sortBy(key).saveAsTable(table)


def store_results(results: DataFrame, table: str, n_buckets: int = 64) -> None:
    """Ranked results, bucketed and sorted by document id."""
    _store(results.repartition(n_buckets, "doc_id"), "doc_id", table, n_buckets)


def lookup(spark: SparkSession, results_table: str, passages_table: str) -> DataFrame:
    """X4 over stored tables: results with ``text``, ``title`` and ``found``."""
    r, p = spark.table(results_table), spark.table(passages_table)
    p = p.select(F.col("id").alias("_id"), "text", "title").hint("merge")
    return r.join(p, F.col("doc_id") == F.col("_id"), "left").withColumn("found", F.col("_id").isNotNull()).drop("_id")


def match_string(spark: SparkSession, results_table: str, passages_table: str, questions: DataFrame) -> DataFrame:
    """E1 over stored tables: ``qid, rank, doc_id, has_answer``."""
    r = spark.table(results_table).select("qid", "rank", "doc_id")
    p = spark.table(passages_table).select(F.col("id").alias("_id"), F.col("text").isNotNull().alias("_there"), "tokens").hint("merge")
    j = r.join(p, F.col("doc_id") == F.col("_id"), "left")
    a = questions.select("qid", _answer_keys(F.coalesce("answers", F.array().cast("array<string>"))).alias("_ak"))
    hit = F.coalesce(F.col("_there") & has_answer_string(F.col("tokens"), F.col("_ak")), F.lit(False))
    return j.join(a, "qid", "left").select("qid", "rank", "doc_id", hit.alias("has_answer"))
