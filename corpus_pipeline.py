"""The corpus pipeline: quality, line dedup, near-duplicate documents, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
back as the next one's ``docs``.  All but the last keep the columns of ``documents`` (extra columns
pass through).  A document is known by its id and its text's hash, so null and repeated ids are told
apart where their texts differ; rows equal in both share their fate, except that the near-duplicate
stage goes by rows and keeps one.

SQL cannot express the classifier, the near-duplicate lines and the tokenizer; the tests hold the
stages against brute-force versions.

A stage's output is written and read again before the next stage starts, so what a stage has written on its way (the classifier's
counts, say) goes when the next one starts: no more than one stage's tables are there at a time.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.llm import kneser_ney, line_dedup, mixing, ngram_join, packing
from sparkqa.llm.common import materialize, table
from sparkqa.llm.queries import tokenizer_path
from sparkqa.operators.util import discard, recorded
from sparkqa.session import ship_package


def _decided(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Join documents with one decision row for each (id, text hash); new columns start with ``__``."""
    d = decisions.withColumnRenamed("doc_id", "__id").withColumnRenamed("text_hash", "__hash")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__hash"))
    return docs.join(d, same, how)


_BEFORE: dict[str, list[str]] = {}  # by application: the tables that the last stage wrote on its way


def _tidy(stage):
    """Start a stage by discarding what the one before wrote on its way; its output is not among that."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _BEFORE.setdefault(spark.sparkContext.applicationId, [])
        discard(spark, before)
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        before += paths
        return out
    return run


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go; those without words or without a model stay."""
    ship_package(spark)
    judged = kneser_ney.classify(docs, table(spark, sf_dir, "labels"))
    return _decided(docs, judged.filter(~F.col("kept")).select("doc_id", "text_hash").distinct(), "left_anti")


@_tidy
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line but the first of its class goes; a document that loses all its lines goes with them."""
    ship_package(spark)
    cut = line_dedup.removed(docs).filter("n_removed > 0").dropDuplicates(["doc_id", "text_hash"])
    cut = cut.select("doc_id", "text_hash", (F.col("n_removed") == F.col("n_lines")).alias("__all"),
                     F.transform("removed", lambda x: x["line"]).alias("__gone"))
    d = _decided(docs, cut, "left").filter(~F.coalesce("__all", F.lit(False))).select(*docs.columns, "__gone")
    d = line_dedup.drop_lines(d, "text", "__gone")
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return d


@_tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at 0.8 or more stays: the smallest id, then text
    hash (null ids last).  Every row is a node of its own, so repeated rows and ids and null ids link too."""
    ship_package(spark)
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")  # written, so numbered once
    found = ngram_join.join(rows, key="__row", words=5, percent=80)
    members = found.select(F.col("doc_id").alias("__row"), "text_hash", "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "__row")).alias("first")
    stay = members.groupBy("component_id").agg(first).select("first.__row")
    return rows.join(stay, "__row", "left_semi").select(*docs.columns)


@_tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, range-sorted by training position.  Documents are
    taken whole; those without words ask for no share of the mix and stay once, at the end."""
    mixed = materialize(mixing.mix(docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("text_hash")))), "pipeline-mix")
    when = mixed.select("doc_id.doc_id", "doc_id.text_hash", F.when(F.col("size") == 0, F.array(F.lit(2.0))).otherwise(F.col("positions")).alias("__at")) \
        .dropDuplicates(["doc_id", "text_hash"])
    d = _decided(docs, when, "inner")
    return d.withColumn("__p", F.explode("__at")).orderBy("__p", "doc_id").select(*docs.columns)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix), ("best-fit packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
