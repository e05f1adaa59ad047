"""Answer matching and reader parts at size."""


def _plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_answers_meet_only_the_passages_of_their_results(spark):
    from sparkqa.operators import positions as ps
    qs = spark.createDataFrame([(1, "q", ["red fox"]), (2, "q", ["fox"])], "qid long, question string, answers array<string>")
    texts = spark.createDataFrame([("a", "the red fox"), ("b", "a red fox"), ("c", "fox red")], "doc_id string, text string")
    tokens = ps.answer_tokens(qs)
    positions = ps.passage_positions(texts, tokens)
    pairs = spark.createDataFrame([(1, "a"), (1, "c"), (2, "b")], "qid long, doc_id string")
    got = sorted(tuple(r) for r in ps.matches(tokens, positions, pairs).collect())
    assert got == [(1, "a"), (2, "b")]


def test_reader_parts_read_stored_contexts(spark, sf_small, monkeypatch):
    from sparkqa.plans.queries import QUERIES
    from sparkqa.sinks import reader_parts as rp
    seen = []
    monkeypatch.setattr(rp, "prepare_in_parts", lambda inputs, *a, **k: seen.append(inputs["contexts"]))
    monkeypatch.setattr(rp, "read_parts", lambda spark, path, schema: spark.createDataFrame([], schema))
    QUERIES["k9_reader_parts"](spark, sf_small)
    assert len(seen) == 2 and all("Join" not in _plan(c) and "reader-contexts" in c.inputFiles()[0] for c in seen)


def test_answers_join_results_before_texts(spark, sf_small):
    from sparkqa.operators import evaluate as ev
    from sparkqa.sources import fixtures as fx
    corpus, qs = fx.corpus(spark, sf_small), fx.questions(spark, sf_small)
    res = spark.createDataFrame([(1, 1, "3")], "qid long, rank long, doc_id string")
    lines = ev.match_string(res, corpus, qs)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [x for x in lines if "Join LeftOuter" in x]
    assert "doc_id" in joins[0] and "qid" in joins[1]  # the outer join brings the texts
