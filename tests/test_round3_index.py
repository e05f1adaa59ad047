"""Index builds at size: a document is counted and weighed where it lies."""
import pytest

from sparkqa.operators import index as ix
from sparkqa.sources import fixtures as fx


def _plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_documents_are_counted_without_a_shuffle(spark, sf_small):
    corpus = fx.corpus(spark, sf_small)
    assert "Exchange" not in _plan(ix.term_frequencies(corpus))
    idx = ix.build_tfidf_index(corpus, persist=False)
    assert "Exchange" not in _plan(idx.weights)


@pytest.mark.parametrize("words", [200_000, 3])
def test_counts_against_plain_python(spark, monkeypatch, words):
    from collections import Counter
    monkeypatch.setattr(ix, "COUNT_WORDS", words)
    texts = ["red fox red", None, "", "fox", "Red fox red fox blue", "blue " * 7]
    d = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)], "row_no bigint, id string, text string").coalesce(1)
    got = {(r["row_no"], r["term"]): r["tf"] for r in ix.tfidf_doc_terms(d, "row_no", d["text"]).collect()}
    want = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        want |= {(i, k): n for k, n in Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]).items()}
    assert got == want
    first = {(r["row_no"], r["term"]): (r["dl"], r["is_first"]) for r in ix.term_frequencies(d).collect()}
    assert first[(4, "red")] == (5, 1) and first[(4, "blue")] == (5, 0) and first[(5, "blue")] == (7, 1)


def test_stored_passages_move_once(spark, sf_small, monkeypatch):
    from sparkqa.operators import stored as st
    seen = []
    monkeypatch.setattr(st, "_store", lambda dealt, *_: seen.append(_plan(dealt)))
    st.store_passages(fx.corpus(spark, sf_small), "unused", 8)
    assert seen[0].count("Exchange") == 1 and "REPARTITION_BY_NUM" in seen[0]  # by bucket, before the last row of an id is found
