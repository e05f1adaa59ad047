"""Training-set operators against brute force, and the driver contract."""

import hashlib
import math

from pyspark.sql import functions as F

from sparkqa.operators import training as tr


def test_best_spans_top_n_matches_greedy(spark):
    start = [0.1, 2.0, 0.3, 1.5, 0.2, 0.9]
    end = [0.5, 0.1, 1.8, 0.2, 1.7, 0.4]
    sub = [False, False, True, False, False, True]
    df = spark.createDataFrame([(1, start, end, sub)],
                               "pid long, start_logits array<double>, end_logits array<double>, is_sub_word array<boolean>")
    got = [(r.start, r.end) for r in tr.best_spans(df, 3, 3).orderBy("span_rank").collect()]
    cands = sorted(((i, j, start[i] + end[j]) for i in range(6) for j in range(i, min(i + 3, 6))),
                   key=lambda x: -x[2])
    chosen, exp = [], []
    for i, j, _ in cands:
        if any(i <= a <= b <= j or a <= i <= j <= b for a, b in chosen):
            continue
        s, e = i, j
        while s > 0 and sub[s]:
            s -= 1
        while e < 5 and sub[e + 1]:
            e += 1
        exp.append((s, e))
        chosen.append((s, e))
        if len(exp) == 3:
            break
    assert got == exp


def brute_epoch(keys, shards, bs, seed, epoch, strict):
    order = sorted(keys, key=lambda k: (hashlib.md5(f"{seed + epoch}:{k}".encode()).hexdigest(), k))
    sps = math.ceil(len(order) / shards)
    iters = math.ceil(sps / bs) if strict else int(sps / bs)
    out = []
    for s in range(shards):
        sh = order[s * sps:min((s + 1) * sps, len(order))]
        b = 0
        for i in range(0, len(sh), bs):
            batch = sh[i:i + bs]
            if strict and len(batch) < bs:
                batch = batch + sh[0:bs - len(batch)]
            out += [(s, b, j, k) for j, k in enumerate(batch)]
            b += 1
        while b < iters:
            out += [(s, b, j, k) for j, k in enumerate(sh[0:bs])]
            b += 1
    return sorted(out)


def test_epoch_shards_against_brute_force(spark):
    keys = list(range(53))
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for strict in (False, True):
        got = sorted(tuple(r) for r in tr.epoch_shards(df, "key", 4, 5, seed=1, epoch=2, strict=strict)
                     .select("shard", "batch", "slot", "key").collect())
        assert got == brute_epoch(keys, 4, 5, 1, 2, strict)


def test_mix_sources_counts_and_order(spark):
    rows = [(i, "a" if i < 40 else "b") for i in range(60)]
    df = spark.createDataFrame(rows, "key long, src string")
    out = tr.mix_sources(df, "key", "src", {"a": 1.0, "b": 0.5}, 4, seed=0, epoch=0).collect()
    per = {}
    for r in out:
        per.setdefault(r.source, set()).add((r.batch, r.step))
    assert len(per["a"]) == 10 and len(per["b"]) == 2          # int(int(40/4)*1.0), int(int(20/4)*0.5)
    for src, pairs in per.items():                              # a source's batches appear in order
        by_step = [b for b, _ in sorted(pairs, key=lambda x: x[1])]
        assert by_step == sorted(by_step)
    assert sorted({r.step for r in out}) == list(range(12))


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert df.columns == ["k", "hits", "recall"] and len(rows) == 100


def test_every_query_has_an_oracle_or_is_declared(spark):
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    from sparkqa.plans.queries import QUERIES
    assert set(QUERIES) <= set(o)      # every query of the reference's operators has an exact SQL oracle
    assert len(q) >= 80


def test_retriever_examples_exclude_gold_fallback(spark):
    ctx = "array<struct<text:string,title:string,score:double,passage_id:string>>"
    rows = [("q1’", [('a\n"x"', None, None, "1"), ("b", "t", 1.0, "2")], None, []),
            ("q2", [("c", None, None, "3")], [], None)]
    df = spark.createDataFrame(rows, f"question string, positive_ctxs {ctx}, negative_ctxs {ctx}, "
                                     f"hard_negative_ctxs {ctx}")
    out = {r.query: r for r in tr.retriever_examples(df, normalize=True, exclude_gold=True, suffix="?").collect()}
    assert [p.text for p in out["q1'?"].positive_passages] == ["b"]          # only scored positives
    assert [p.text for p in out["q2?"].positive_passages] == ["c"]           # none scored: keep all
    assert out["q1'?"].negative_passages == [] and out["q2?"].hard_negative_passages == []


def test_kilt_provenance_counts_missing_and_keeps_rank_order(spark):
    from sparkqa.sinks import writers as wr
    res = spark.createDataFrame([(1, 2, "20"), (1, 1, "10"), (1, 3, "99"), (2, 1, "x")],
                                "qid long, rank long, doc_id string")
    mapping = spark.createDataFrame([(10, 1, 0), (20, 2, 5)], "ctx_id long, wikipedia_id long, end_paragraph_id long")
    gold = spark.createDataFrame([(1, "a", "q1"), (2, "b", "q2"), (3, "c", "q3")], "qid long, id string, input string")
    out = {r.qid: r for r in wr.to_kilt_provenance(res, mapping, gold).collect()}
    assert [(p.wikipedia_id, p.end_paragraph_id) for p in out[1].provenance][:2] == [(1, 0), (2, 5)]
    assert out[1].missing == 1 and out[2].missing == 1 and out[3].provenance == [] and out[3].missing == 0


def test_ctx_match_shards_numbering(spark):
    from sparkqa.sinks import writers as wr
    t = ("struct<caption:string,rows:array<struct<row:int,columns:array<struct<col:int,value:string>>>>>")
    rows = [(i, "q%d" % i, [{"caption": "c%d" % i, "rows": [
        {"row": 1, "columns": [{"col": 1, "value": "b"}, {"col": 0, "value": "a"}]},
        {"row": 0, "columns": [{"col": 0, "value": "h"}]}]}] if i % 3 else []) for i in range(7)]
    df = spark.createDataFrame(rows, f"sample_no long, question string, positive_ctxs array<{t}>")
    out = wr.ctx_match_shards(df, 2).orderBy("id").collect()
    assert [(r.id, r.shard, r.question) for r in out] == [(0, 0, "q1"), (1, 0, "q2"), (2, 1, "q4"), (3, 1, "q5")]
    assert out[0].text == "c1 . ha . b . "


def test_mix_sources_without_rates_takes_all_batches(spark):
    rows = [(i, "a" if i < 40 else "b") for i in range(60)]
    df = spark.createDataFrame(rows, "key long, src string")
    out = tr.mix_sources(df, "key", "src", None, 4, seed=1, epoch=0).collect()
    assert sorted({(r.source, r.batch) for r in out}) == [("a", b) for b in range(10)] + [("b", b) for b in range(5)]
