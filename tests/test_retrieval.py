"""BM25 / TF-IDF ranking, id normalisation and Hit@K on hand-written rows."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from sparkqa.operators import evaluate as ev
from sparkqa.operators import index as ix
from sparkqa.operators import retrieve as rt


def corpus_df(spark, rows):
    return spark.createDataFrame([(str(i), t, "title%d" % i, i) for i, t in rows], "id string, text string, title string, row_no long")


def questions_df(spark, rows):
    return spark.createDataFrame(rows, "qid long, question string, answers array<string>")


def brute_bm25(docs, question, k1=1.2, b=0.75, min_df=2, max_df_ratio=0.3):
    tok = lambda t: [m.lower() for m in re.findall("[A-Za-z0-9]+", t)]
    kept = [(i, tok(t)) for i, t in docs if tok(t)]
    n = len(kept)
    avgdl = sum(len(t) for _, t in kept) / n
    df = Counter(term for _, t in kept for term in set(t))
    max_df = max(int(max_df_ratio * n), 1)
    scores = {}
    for term in tok(question):
        if term not in df or df[term] < min_df or df[term] > max_df:
            continue
        idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
        for i, t in kept:
            tf = t.count(term)
            if tf:
                scores[i] = scores.get(i, 0.0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(t) / avgdl))
    return scores


DOCS = [(0, "the cat sat on the mat"), (1, "a dog and a cat"), (2, "dog dog dog barks"), (3, "birds fly"),
        (4, "cats and dogs and birds"), (5, ""), (6, "mat mat"), (7, "zebra"), (8, "the dog sat"), (9, "cat")]


def test_bm25_matches_brute_force_and_repeated_words(spark):
    corpus = corpus_df(spark, DOCS)
    idx = ix.build_bm25_index(corpus, persist=False, max_df_ratio=0.5)
    qs = questions_df(spark, [(1, "dog dog sat", []), (2, "cat mat", []), (3, "nothing here", []), (4, "", [])])
    got = {(r.qid, r.doc_id): r.score for r in rt.bm25_topk(qs, idx, 10).collect()}
    for qid, q in [(1, "dog dog sat"), (2, "cat mat")]:
        exp = brute_bm25(DOCS, q, max_df_ratio=0.5)
        assert {d for (qq, d) in got if qq == qid} == {str(i) for i in exp}
        for i, s in exp.items():
            assert abs(got[(qid, str(i))] - s) < 1e-9
    assert not [k for k in got if k[0] in (3, 4)]      # no match / no tokens -> empty list


def test_bm25_tie_order_first_query_position_then_corpus_order(spark):
    docs = [(0, "alpha x"), (1, "beta x"), (2, "alpha y"), (3, "beta y"), (4, "gamma"), (5, "gamma z")]
    idx = ix.build_bm25_index(corpus_df(spark, docs), persist=False, max_df_ratio=1.0)
    r = rt.bm25_topk(questions_df(spark, [(1, "beta alpha", [])]), idx, 10).orderBy("rank").collect()
    # all four documents score the same; "beta" comes first in the question
    assert [x.doc_id for x in r] == ["1", "3", "0", "2"]


def test_tfidf_padding_returns_exactly_k(spark):
    docs = [(i, t) for i, t in enumerate(["apple banana", "banana cherry", "cherry date", "egg", "fig", "grape"])]
    corpus = corpus_df(spark, docs)
    idx = ix.build_tfidf_index(corpus, persist=False)
    qs = questions_df(spark, [(1, "apple", []), (2, "unknownword", [])])
    r = rt.tfidf_topk(qs, idx, corpus, topk=4).collect()
    by_q = {}
    for x in r:
        by_q.setdefault(x.qid, []).append(x)
    assert sorted(len(v) for v in by_q.values()) == [4, 4]
    q2 = sorted(by_q[2], key=lambda x: x.rank)
    assert [x.doc_id for x in q2] == ["0", "1", "2", "3"] and all(x.score == 0.0 for x in q2)
    q1 = sorted(by_q[1], key=lambda x: x.rank)
    assert q1[0].doc_id == "0" and q1[0].score > 0 and [x.score for x in q1[1:]] == [0.0, 0.0, 0.0]


def test_normalize_doc_ids(spark):
    corpus = spark.createDataFrame([("d0", "t", "x", 0), ("d1", "t", "x", 1), ("d2", "t", "x", 2)],
                                   "id string, text string, title string, row_no long")
    res = spark.createDataFrame([(1, 1, "d1", 0.5), (1, 2, " 2 ", 0.4), (1, 3, "3.7", 0.3), (1, 4, "7", 0.2),
                                 (1, 5, "zz", 0.1), (1, 6, "0", 0.05)], "qid long, rank long, doc_id string, score double")
    out = [(r.rank, r.doc_id) for r in rt.normalize_doc_ids(res, corpus).orderBy("rank").collect()]
    assert out == [(1, "d1"), (2, "d2"), (3, "d0")]


def test_match_string_quirks_and_hit_at_k(spark):
    corpus = spark.createDataFrame([("a", "Paris is in France", "t", 0), ("b", None, "t", 1), ("c", "", "t", 2),
                                    ("d", "Café au lait", "t", 3)], "id string, text string, title string, row_no long")
    qs = questions_df(spark, [(1, "q", ["in france"]), (2, "q", ["!!!"]), (3, "q", ["cafe"]), (4, "q", ["café"]),
                              (5, "q", ["x"])])
    res = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (2, 1, "c"), (3, 1, "d"), (4, 1, "d")],
                                "qid long, rank long, doc_id string")
    hits = {(r.qid, r.rank): r.has_answer for r in ev.match_string(res, corpus, qs).collect()}
    assert hits[(1, 1)] is False and hits[(1, 2)] is True      # null text never matches
    assert hits[(2, 1)] is False                                # '!!!' has tokens; empty passage has none
    assert hits[(3, 1)] is False and hits[(4, 1)] is True       # accents matter after NFD
    rec = {r.k: (r.hits, r.recall) for r in ev.hit_at_k(ev.match_string(res, corpus, qs), qs, 3).collect()}
    assert rec[1] == (1, 0.2) and rec[2] == (2, 0.4) and rec[3] == (2, 0.4)  # 5 questions, one without results


def test_answer_without_tokens_matches_everything(spark):
    corpus = spark.createDataFrame([("a", "", "t", 0)], "id string, text string, title string, row_no long")
    qs = questions_df(spark, [(1, "q", ["   "])])
    res = spark.createDataFrame([(1, 1, "a")], "qid long, rank long, doc_id string")
    assert ev.match_string(res, corpus, qs).first().has_answer is True


def test_regex_invalid_pattern_is_no_match(spark):
    corpus = spark.createDataFrame([("a", "The Tree\\nline", "t", 0)], "id string, text string, title string, row_no long")
    res = spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], "qid long, rank long, doc_id string")
    qs = questions_df(spark, [(1, "q", ["(", "t[a-z]{2}e"]), (2, "q", ["("])])
    hits = {r.qid: r.has_answer for r in ev.match_regex(res, corpus, qs).collect()}
    assert hits == {1: True, 2: False}


def test_hit_at_k_default_k_is_longest_list(spark):
    qs = questions_df(spark, [(1, "q", ["a"]), (2, "q", ["a"])])
    hits = spark.createDataFrame([(2, 1, "d", False), (2, 2, "e", True), (2, 3, "f", False)],
                                 "qid long, rank long, doc_id string, has_answer boolean")
    rec = [(r.k, r.hits) for r in ev.hit_at_k(hits, qs).orderBy("k").collect()]
    assert rec == [(1, 0), (2, 1), (3, 1)]       # question 1 has an empty list and still counts


def test_bm25_salted_shuffle_path_equals_broadcast_path(spark):
    corpus = corpus_df(spark, DOCS)
    idx = ix.build_bm25_index(corpus, persist=False, max_df_ratio=1.0, min_df=1)
    qs = questions_df(spark, [(1, "dog dog sat", []), (2, "cat mat the", []), (3, "birds", [])])
    a = sorted(tuple(r) for r in rt.bm25_topk(qs, idx, 5).collect())
    b = sorted(tuple(r) for r in rt.bm25_topk(qs, idx, 5, broadcast_rows=0, salts=4).collect())
    assert a == b and a


def test_tfidf_salted_shuffle_path_equals_broadcast_path(spark):
    corpus = corpus_df(spark, DOCS)
    idx = ix.build_tfidf_index(corpus, persist=False)
    qs = questions_df(spark, [(1, "dog sat", []), (2, "cat mat", []), (3, "zzz", [])])
    a = sorted(tuple(r) for r in rt.tfidf_topk(qs, idx, corpus, 4).collect())
    b = sorted(tuple(r) for r in rt.tfidf_topk(qs, idx, corpus, 4, broadcast_rows=0, salts=3).collect())
    assert a == b and len(a) == 12


def test_empty_corpus_gives_empty_results(spark):
    corpus = corpus_df(spark, [(0, ""), (1, "!!!")])
    idx = ix.build_bm25_index(corpus, persist=False)
    assert idx.stats.first()["n_docs"] == 0
    assert rt.bm25_topk(questions_df(spark, [(1, "anything", [])]), idx, 5).count() == 0


def test_tfidf_empty_vocabulary_pads_with_zero_scores(spark):
    corpus = corpus_df(spark, [(0, "the of"), (1, "")])
    idx = ix.build_tfidf_index(corpus, persist=False)
    r = rt.tfidf_topk(questions_df(spark, [(1, "anything", [])]), idx, corpus, 5).orderBy("rank").collect()
    # the titles are indexed too, so only stop words are missing; two documents -> two rows
    assert [x.rank for x in r] == [1, 2] and all(x.qid == 1 for x in r)
