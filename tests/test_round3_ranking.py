"""Ranking at size: (question, document) pairs stay in the task that holds the document."""
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from sparkqa.operators import index as ix
from sparkqa.operators import retrieve as rt
from sparkqa.sources import fixtures as fx


def _plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_shuffled(spark, sf_small):
    corpus, qs = fx.corpus(spark, sf_small), fx.questions(spark, sf_small)
    for ranked in (rt.bm25_topk(qs, ix.build_bm25_index(corpus), 5), rt.tfidf_topk(qs, ix.build_tfidf_index(corpus), corpus, 5, pad=False)):
        dealt = [x.split(")")[0] for x in _plan(ranked).split("hashpartitioning(")[1:]]
        assert any(x.startswith("row_no") for x in dealt)                        # the postings of asked terms
        assert not any(x.startswith("qid") and "row_no" in x for x in dealt)     # never a row a question and document


@pytest.mark.parametrize("pairs", [2_000_000, 4, 1])
@pytest.mark.parametrize("size", [1, 3, 50])
def test_best_of_a_task_against_plain_python(monkeypatch, pairs, size):
    monkeypatch.setattr(rt, "SCORE_PAIRS", pairs)
    rng = np.random.default_rng(size)
    n_q, n_t, n_d, k = 6, 9, 60, 4
    asks = sorted((int(t), int(q), float(rng.integers(1, 3)), int(rng.integers(0, 5))) for t in range(n_t) for q in range(n_q) if rng.random() < 0.3)
    held = [(d, t, float(rng.integers(1, 3))) for d in range(n_d) for t in range(n_t) if rng.random() < 0.4]  # small integers: many ties
    of = np.array([a[0] for a in asks])
    arrays = (pa.array(range(100, 100 + n_q)), np.searchsorted(of, np.arange(n_t + 1)), *(np.array([a[i] for a in asks]) for i in (1, 2, 3)))
    rows = pa.RecordBatch.from_pydict({"row_no": [d for d, _, _ in held], "id": [f"d{d}" for d, _, _ in held],
                                       "t": [t for _, t, _ in held], "v": [v for _, _, v in held]})
    batches = [rows.slice(i, size) for i in range(0, rows.num_rows, size)]
    got = {}
    for b in rt._top_rows(iter(batches), SimpleNamespace(value=arrays), k):
        for r in b.to_pylist():
            got.setdefault(r["qid"] - 100, []).append((-r["score"], r["first_pos"], r["row_no"]))
            assert r["id"] == f"d{r['row_no']}" and r["_r"] == r["score"]
    want = {}
    for q in range(n_q):
        s = {}
        for d, t, v in held:
            for at, aq, w, pos in asks:
                if at == t and aq == q:
                    total, first = s.get(d, (0.0, 99))
                    s[d] = (total + w * v, min(first, pos))
        if s:
            want[q] = sorted((-total, first, d) for d, (total, first) in s.items())[:k]
    assert {q: sorted(x) for q, x in got.items()} == want
