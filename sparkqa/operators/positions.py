"""E1 over token positions: answers meet passages by their rarest token, and the order of the others is checked by position.

Passages become postings (document, position, token) of the tokens that some answer holds. An answer is looked up by the one of its tokens
that the fewest passages have; every place where that token stands in a passage that the question's results hold is a candidate, and a
candidate is a match when the answer's other tokens stand at their distances from it. No passage text is searched for an answer, so the work
follows the rare tokens of the results, not questions times passages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.functions.text import normalize_nfd, tokenize_unicode
from sparkqa.functions.unicode import nfd_array
from sparkqa.operators.retrieve import result_bound, retrieved_passages
from sparkqa.operators.util import DEFAULT_BROADCAST_ROWS, materialize


def answer_tokens(questions: DataFrame) -> DataFrame:
    """``qid, a, n, i, token``: the tokens of each question's answers; an answer without tokens (or null) is one row with n = 0."""
    a = questions.select("qid", F.posexplode(nfd_array(F.coalesce("answers", F.array().cast("array<string>")))).alias("a", "answer"))
    t = a.select("qid", "a", F.transform(tokenize_unicode(F.coalesce("answer", F.lit(""))), lambda x: F.lower(x)).alias("t"))
    return t.select("qid", "a", F.size("t").alias("n"), F.posexplode_outer("t").alias("i", "token"))


def passage_positions(passages: DataFrame, tokens: DataFrame) -> DataFrame:
    """``doc_id, pos, token`` of ``passages`` (doc_id, text), for the distinct ``tokens`` only."""
    wanted = tokens.filter("token is not null").select("token").distinct()
    p = passages.select("doc_id", F.posexplode(tokenize_unicode(normalize_nfd("text"))).alias("pos", "token")).withColumn("token", F.lower("token"))
    return p.join(F.broadcast(wanted) if wanted.count() <= DEFAULT_BROADCAST_ROWS else wanted, "token", "left_semi").select("doc_id", "pos", "token")


def matches(tokens: DataFrame, positions: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Distinct ``qid, doc_id``: the passages that hold one of a question's answers (with tokens); with ``pairs`` (distinct qid, doc_id), of these only."""
    df = positions.groupBy("token").agg(F.count_distinct("doc_id").alias("df"))
    known = tokens.filter("n > 0").join(df, "token", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    # an answer with a token that no passage has cannot match
    rare = known.groupBy("qid", "a").agg(F.min_by(F.struct("i", "token"), F.struct("df", "i")).alias("r"), F.min("df").alias("least"), F.first("n").alias("n")) \
        .filter("least > 0").select("qid", "a", "n", F.col("r.i").alias("i"), F.col("r.token").alias("token"))
    met = rare.join(positions, "token") if pairs is None else rare.join(pairs, "qid").join(positions, ["doc_id", "token"])
    starts = met.select("qid", "a", "n", "doc_id", (F.col("pos") - F.col("i")).alias("start")).filter("start >= 0")
    rest = starts.join(tokens.select("qid", "a", "i", "token"), ["qid", "a"]).select("qid", "a", "n", "doc_id", "start", (F.col("start") + F.col("i")).alias("pos"), "token")
    held = rest.join(positions, ["doc_id", "pos", "token"]).groupBy("qid", "a", "n", "doc_id", "start").agg(F.count(F.lit(1)).alias("found"))
    return held.filter("found = n").select("qid", "doc_id").distinct()


def match_string(results: DataFrame, corpus: DataFrame, questions: DataFrame, max_k: int | None = None) -> DataFrame:
    """``qid, rank, doc_id, has_answer``, the rows of ``evaluate.match_string``; an answer without tokens matches every passage with a text.
    ``max_k`` (results per question) lets the retrieved ids be broadcast so the corpus is never shuffled."""
    passages = materialize(retrieved_passages(results, corpus, result_bound(questions, max_k)).filter("text is not null").select(F.col("id").alias("doc_id"), "text"), "answer-passages")
    tokens = materialize(answer_tokens(questions), "answer-tokens")
    positions = materialize(passage_positions(passages, tokens), "answer-positions")
    every = tokens.filter("n = 0").select("qid").distinct().withColumn("_every", F.lit(True))
    hit = matches(tokens, positions, results.select("qid", "doc_id").distinct()).withColumn("_hit", F.lit(True))
    there = passages.select("doc_id", F.lit(True).alias("_there"))
    j = results.select("qid", "rank", "doc_id").join(there, "doc_id", "left").join(every, "qid", "left").join(hit, ["qid", "doc_id"], "left")
    has = F.coalesce("_there", F.lit(False)) & (F.coalesce("_every", F.lit(False)) | F.coalesce("_hit", F.lit(False)))
    return j.select("qid", "rank", "doc_id", has.alias("has_answer"))
