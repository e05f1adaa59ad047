"""Reader samples prepared in parts that are reused, and evaluation over stored tables."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sparkqa.operators import evaluate as ev
from sparkqa.operators import retrieve as rt
from sparkqa.operators import stored as st
from sparkqa.sinks import reader_parts as rp


def inputs(spark, n=60, changed=()):
    q = spark.createDataFrame([(i, f"question {i}" + ("!" if i in changed else "")) for i in range(n)], "qid long, question string")
    c = spark.createDataFrame([(i, j, f"text {i} {j}") for i in range(n) for j in range(i % 4)], "qid long, rank int, text string")
    return {"questions": q, "contexts": c}


def prepare(some):
    c = some["contexts"].groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("passages"))
    return some["questions"].join(c, "qid")


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_broken_run_goes_on_where_it_was(spark, tmp_path):
    path, data = str(tmp_path / "s"), inputs(spark)
    calls = []

    def breaks(some):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return prepare(some)
    with pytest.raises(RuntimeError):
        rp.prepare_in_parts(data, breaks, path, n_parts=10, wave=2)
    (tmp_path / "s" / "parts" / "half").mkdir()  # what a task had written of the wave that broke
    done = rp.prepare_in_parts(data, prepare, path, n_parts=10, wave=2)
    assert len(done["reused"]) == 4 and len(done["prepared"]) == 6
    want = prepare(data)
    assert rows(rp.read_parts(spark, path, want.schema)) == rows(want)
    assert rp.prepare_in_parts(data, prepare, path, n_parts=10)["prepared"] == []


def test_a_killed_process_is_resumed(spark, tmp_path):
    here = os.path.dirname(os.path.abspath(__file__))
    code = f"""
import os, signal, sys
sys.path[:0] = [{os.path.dirname(here)!r}, {here!r}]
from sparkqa.session import get_spark
from sparkqa.sinks import reader_parts as rp
import test_reuse as t
spark = get_spark("local[2]", 2)
seen = []
def prepare(some):
    if seen:
        os.kill(os.getpid(), signal.SIGKILL)
    seen.append(1)
    return t.prepare(some)
rp.prepare_in_parts(t.inputs(spark), prepare, {str(tmp_path / "s")!r}, n_parts=6, wave=3)
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert run.returncode == -9, run.stderr[-2000:]
    data = inputs(spark)
    done = rp.prepare_in_parts(data, prepare, str(tmp_path / "s"), n_parts=6, wave=3)
    assert len(done["reused"]) == 3
    want = prepare(data)
    assert rows(rp.read_parts(spark, str(tmp_path / "s"), want.schema)) == rows(want)


def test_only_changed_parts_are_prepared(spark, tmp_path):
    path = str(tmp_path / "s")
    rp.prepare_in_parts(inputs(spark), prepare, path, n_parts=12, identity="a")
    now = inputs(spark, n=60, changed={7})
    done = rp.prepare_in_parts(now, prepare, path, n_parts=12, identity="a")
    assert len(done["prepared"]) == 1
    want = prepare(now)
    assert rows(rp.read_parts(spark, path, want.schema)) == rows(want)
    assert len(rp.prepare_in_parts(now, prepare, path, n_parts=12, identity="b")["prepared"]) == 12
    none = {k: d.limit(0) for k, d in now.items()}
    rp.prepare_in_parts(none, prepare, path, n_parts=12, identity="b")
    assert rp.read_parts(spark, path, want.schema).count() == 0


def test_stored_evaluation_moves_neither_side(spark, tmp_path):
    corpus = spark.createDataFrame([(str(i % 50), f"passage {i} holds word{i % 7}" if i % 9 else None, f"t{i}", i) for i in range(80)],
                                   "id string, text string, title string, row_no long")
    qs = spark.createDataFrame([(1, ["word3"]), (2, ["nothing", "word5 "]), (3, None), (4, [""])], "qid long, answers array<string>")
    results = spark.createDataFrame([(q, r + 1, str((q * 13 + r * 7) % 55)) for q in (1, 2, 3, 4) for r in range(10)], "qid long, rank long, doc_id string")
    st.store_passages(corpus, "stored_p", 8)
    st.store_results(results, "stored_r", 8)
    hits = st.match_string(spark, "stored_r", "stored_p", qs)
    key = lambda r: (r["qid"], r["rank"], r["doc_id"], r["has_answer"])
    assert sorted(map(key, hits.collect())) == sorted(map(key, ev.match_string(results, corpus, qs, 10).collect()))
    found = st.lookup(spark, "stored_r", "stored_p")
    want = rt.passage_lookup(results, corpus, 40)
    cols = ["qid", "rank", "doc_id", "text", "title", "found"]
    assert rows(found.select(cols)) == rows(want.select(cols))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(_id" not in plan


def test_answers_by_token_positions_match_as_by_text(spark):
    import random
    from sparkqa.operators import positions as ps
    rng = random.Random(9)
    words = "a b c Rare1 rare2 É ü 字 . , x1".split()
    corpus = spark.createDataFrame([(str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25))) if i % 11 else None, "t", i) for i in range(80)]
                                   + [("7", "b rare1 a", "t", 99)], "id string, text string, title string, row_no long")
    answers = [["a b"], ["rare1 rare2", "É"], ["b b b"], [""], None, ["nowhere a", "c . c"], ["x1", None], ["a a a a a a a"], ["É ü"], [", ."], []]
    qs = spark.createDataFrame(list(enumerate(answers)), "qid long, answers array<string>")
    results = spark.createDataFrame([(q, r + 1, str((q * 17 + r * 5) % 90)) for q in range(12) for r in range(30)], "qid long, rank long, doc_id string")
    key = lambda r: (r["qid"], r["rank"], r["doc_id"], r["has_answer"])
    want = sorted(map(key, ev.match_string(results, corpus, qs, 30).collect()))
    assert sorted(map(key, ps.match_string(results, corpus, qs).collect())) == want and any(x[3] for x in want) and not all(x[3] for x in want)
