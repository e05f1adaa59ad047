"""A BM25 index kept up to date: segments of postings, dead documents, and statistics merged from what changed.

Each ``update`` is a version.  A document is known by its id and text (a 128-bit fingerprint); rows that
repeat both are told apart by a number.  Documents that the index holds keep their postings, wherever they now stand in the
corpus; only the others are tokenised, into a segment of their own.  Segments are never rewritten: a
version lists its live documents with their present corpus rows, so a document that is not listed is dead, and its postings
fall out where scores meet the list.  Document frequencies move by the terms of added and dead documents only.
``compact`` writes the live postings as one segment.

Layout under the index folder: ``segments/<n>`` (postings by term bucket), ``docs/<version>``, ``terms/<version>`` and, written
last, ``versions/<version>``; a version that broke before that is not there for readers, and its number is used again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkqa.functions.text import tokenize_alnum
from sparkqa.operators.index import Bm25Index, prune_vocabulary
from sparkqa.operators.util import DEFAULT_BROADCAST_ROWS, materialize

POSTING = "doc bigint, dl int, term string, tf bigint, term_bucket int"
LIVE = "doc bigint, row_no bigint, id string, dl int, fp string, copy bigint"
N_BUCKETS, SALTS = 64, 64


def versions(spark: SparkSession, path: str) -> list[dict]:
    """The finished versions, oldest first: one small row a version."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema("value string").text(f"{path}/versions/*").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(r["value"]) for r in rows), key=lambda v: v["version"])


def fingerprints(corpus: DataFrame) -> DataFrame:
    """``row_no, id, fp, copy``: the fingerprint of (id, text), and which of the rows that share it a row is (any order).

    Rows of a fingerprint are dealt to SALTS parts and numbered there, so that a text of which there are very many copies is no single
    task's; a part's first number is the rows in those before it.
    """
    fp = F.md5(F.concat(F.coalesce(F.concat(F.length("id").cast("string"), F.lit(":"), F.col("id")), F.lit("-")),
                        F.coalesce(F.concat(F.lit("+"), F.col("text")), F.lit("-"))))
    d = corpus.select("row_no", "id", fp.alias("fp"), F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).alias("_s"))
    d = d.withColumn("_i", F.row_number().over(Window.partitionBy("fp", "_s").orderBy("row_no")) - 1)
    before = Window.partitionBy("fp").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    parts = d.groupBy("fp", "_s").agg(F.count(F.lit(1)).alias("_n")).withColumn("_off", F.sum("_n").over(before)).filter("_off is not null").drop("_n")
    d = d.join(parts, ["fp", "_s"], "left")
    return d.select("row_no", "id", "fp", (F.col("_i") + F.coalesce("_off", F.lit(0))).cast("bigint").alias("copy"))


def _segment(corpus: DataFrame, number: int) -> DataFrame:
    """Postings (doc, dl, term, tf) of ``corpus`` (row_no, text); a document's number is its segment's and its row's."""
    tk = corpus.select(F.col("row_no").bitwiseOR(F.lit(number << 44)).alias("doc"), tokenize_alnum("text").alias("tk"))
    words = tk.select("doc", F.size("tk").alias("dl"), F.explode("tk").alias("term"))
    return words.groupBy("doc", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))


def _read_segments(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], POSTING)
    out = None
    for n in numbers:  # the schema is given: a segment without words has no files
        d = spark.read.schema(POSTING).parquet(f"{path}/segments/{n}")
        out = d if out is None else out.unionByName(d)
    return out


def _write_segment(postings: DataFrame, path: str, number: int) -> None:
    bucket = F.pmod(F.xxhash64("term"), F.lit(N_BUCKETS)).cast("int")
    postings.withColumn("term_bucket", bucket).repartitionByRange("term_bucket", "term", "doc").sortWithinPartitions("term", "doc") \
        .write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/segments/{number}")


def _few(d: DataFrame, n: int) -> DataFrame:
    return F.broadcast(d) if n <= DEFAULT_BROADCAST_ROWS else d


def update(corpus: DataFrame, path: str, k1: float = 1.2, b: float = 0.75, min_df: int = 2, max_df_ratio: float = 0.3) -> dict:
    """Bring the index at ``path`` (created if need be) to ``corpus`` (row_no, id, text).  Returns the version: its number, segments,
    statistics and how many documents were tokenised (``added``) and died (``dead``)."""
    spark = corpus.sparkSession
    old = versions(spark, path)
    last = old[-1] if old else {"version": -1, "segments": [], "next_segment": 0}
    number, segment = last["version"] + 1, last["next_segment"]
    now = materialize(fingerprints(corpus), "index-fingerprints")
    live = spark.read.schema(LIVE).parquet(f"{path}/docs/{last['version']}") if old else spark.createDataFrame([], LIVE)
    keys = ["fp", "copy"]
    kept = now.join(live.select(*keys, "doc", "dl"), keys).select("doc", "row_no", "id", "dl", *keys)
    added = materialize(now.join(live.select(*keys), keys, "left_anti"), "index-added")
    n_added = added.count()
    dead = materialize(live.join(now.select(*keys), keys, "left_anti").select("doc"), "index-dead")
    n_dead = dead.count()
    segments = list(last["segments"])
    changes = []
    if n_added:
        fresh = corpus.select("row_no", "text").join(_few(added.select("row_no"), n_added), "row_no", "left_semi")
        _write_segment(_segment(fresh, segment), path, segment)
        new = _read_segments(spark, path, [segment])
        changes.append(new.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
        sizes = new.groupBy("doc").agg(F.first("dl").alias("dl"))
        more = added.withColumn("doc", F.col("row_no").bitwiseOR(F.lit(segment << 44))).join(sizes, "doc", "left")
        kept = kept.unionByName(more.select("doc", "row_no", "id", F.coalesce("dl", F.lit(0)).alias("dl"), *keys))
        segments.append(segment)
    if n_dead:
        gone = _read_segments(spark, path, last["segments"]).join(_few(dead, n_dead), "doc", "left_semi")
        changes.append(gone.groupBy("term").agg((-F.count(F.lit(1))).alias("df")))
    kept.write.mode("overwrite").parquet(f"{path}/docs/{number}")
    terms = spark.read.schema("term string, df bigint").parquet(f"{path}/terms/{last['version']}") if old else spark.createDataFrame([], "term string, df bigint")
    for c in changes:
        terms = terms.unionByName(c)
    terms.groupBy("term").agg(F.sum("df").cast("bigint").alias("df")).filter("df > 0").write.mode("overwrite").parquet(f"{path}/terms/{number}")
    st = spark.read.schema(LIVE).parquet(f"{path}/docs/{number}").filter("dl > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("dl"), F.lit(0))).first()
    version = {"version": number, "segments": segments, "next_segment": segment + (n_added > 0), "n_docs": int(st[0]), "sum_dl": int(st[1]), "added": n_added, "dead": n_dead,
               "k1": float(k1), "b": float(b), "min_df": int(min_df), "max_df_ratio": float(max_df_ratio)}
    _finish(spark, path, version)
    return version


def _finish(spark: SparkSession, path: str, version: dict) -> None:
    spark.createDataFrame([(json.dumps(version),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/versions/{version['version']}")


def load(spark: SparkSession, path: str, version: int | None = None) -> Bm25Index:
    """A version of the index (the newest).  Its postings know documents by number; ``live`` has their rows and ids."""
    every = versions(spark, path)
    v = next(x for x in reversed(every) if version is None or x["version"] == version)
    terms = spark.read.schema("term string, df bigint").parquet(f"{path}/terms/{v['version']}")
    n = v["n_docs"]
    idf = F.log(1.0 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    vocab = prune_vocabulary(terms, n, v["min_df"], v["max_df_ratio"]).select("term", "df", idf.alias("idf"))
    stats = spark.createDataFrame([(n, v["sum_dl"] / n if n else 0.0, v["k1"], v["b"], v["min_df"], v["max_df_ratio"])],
                                  "n_docs bigint, avgdl double, k1 double, b double, min_df int, max_df_ratio double")
    postings = _read_segments(spark, path, v["segments"]).withColumnRenamed("doc", "row_no").withColumn("id", F.lit(None).cast("string"))
    live = spark.read.schema(LIVE).parquet(f"{path}/docs/{v['version']}").select("doc", "row_no", "id")
    return Bm25Index(postings, vocab, stats, n_buckets=N_BUCKETS, live=live)


def compact(spark: SparkSession, path: str) -> dict:
    """A new version of the newest one's documents with a single segment; nothing is tokenised."""
    last = versions(spark, path)[-1]
    number, segment = last["version"] + 1, last["next_segment"]
    live = spark.read.schema(LIVE).parquet(f"{path}/docs/{last['version']}")
    moved = live.withColumn("_new", F.col("row_no").bitwiseOR(F.lit(segment << 44)))
    posts = _read_segments(spark, path, last["segments"]).drop("term_bucket").join(moved.select("doc", "_new"), "doc") \
        .select(F.col("_new").alias("doc"), "dl", "term", "tf")
    _write_segment(posts, path, segment)
    moved.withColumn("doc", F.col("_new")).drop("_new").write.mode("overwrite").parquet(f"{path}/docs/{number}")
    spark.read.schema("term string, df bigint").parquet(f"{path}/terms/{last['version']}").write.mode("overwrite").parquet(f"{path}/terms/{number}")
    version = last | {"version": number, "segments": [segment], "next_segment": segment + 1, "added": 0, "dead": 0}
    _finish(spark, path, version)
    return version
