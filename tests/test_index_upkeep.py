"""Postings in blocks, and an index that is brought up to date instead of built anew."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sparkqa.operators import blocks as bl
from sparkqa.operators import index as ix
from sparkqa.operators import retrieve as rt
from sparkqa.operators import segments as sg
from sparkqa.sources import fixtures as fx


def ranking(df):
    return sorted((r["qid"], r["rank"], r["doc_id"], round(r["score"], 7)) for r in df.collect())


def skewed_corpus(spark, n=1500, seed=5):
    """Words of very uneven frequency; a few documents hold rare ones."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"common{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randrange(5, 40))]
        if rng.random() < 0.2:
            words += [f"rare{rng.randrange(40)}"] * rng.randrange(1, 4)
        rng.shuffle(words)
        rows.append((i, str(i), " ".join(words), ""))
    return spark.createDataFrame(rows, "row_no long, id string, text string, title string")


@pytest.fixture(scope="module")
def skewed(spark):
    corpus = skewed_corpus(spark)
    return corpus, ix.build_bm25_index(corpus, max_df_ratio=1.0)


@pytest.mark.parametrize("topk", [3, 25, 5000])
@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_blocks_rank_like_the_plain_index(spark, skewed, topk, broadcast_rows):
    _, index = skewed
    qs = spark.createDataFrame([(1, "rare1 common1 common2"), (2, "common1 common2 common3 rare5 rare6 common1"), (3, "nothing here"), (4, "common7"),
                                (5, "rare9"), (6, "")], "qid long, question string")
    blocks = bl.build_blocks(index, block_rows=64)
    want = rt.bm25_topk(qs, index, topk)
    assert ranking(bl.bm25_topk_blocks(qs, blocks, topk, broadcast_rows)) == ranking(want)


def test_blocks_skip_what_cannot_reach_the_top(spark, skewed):
    _, index = skewed
    qs = spark.createDataFrame([(i, f"rare{i} common1 common2 common3") for i in range(8)], "qid long, question string")
    counts = {}
    got = bl.bm25_topk_blocks(qs, bl.build_blocks(index, block_rows=16), 3, counts=counts)
    assert ranking(got) == ranking(rt.bm25_topk(qs, index, 3))
    assert counts["needed"] + counts["rest"] < counts["plain"] / 2


def test_blocks_on_the_tables(spark, sf_small):
    index = ix.build_bm25_index(fx.corpus(spark, sf_small))
    qs = fx.questions(spark, sf_small)
    assert ranking(bl.bm25_topk_blocks(qs, bl.build_blocks(index), 20)) == ranking(rt.bm25_topk(qs, index, 20))


def edited(corpus):
    """One document in a hundred new, in the middle of the corpus; some changed, gone, copied, moved."""
    c = corpus.filter("row_no % 97 != 5").withColumn("text", F.when(F.col("row_no") % 101 == 3, F.concat("text", F.lit(" changed common1"))).otherwise(F.col("text")))
    new = corpus.filter("row_no % 100 = 50").select((F.col("row_no") + F.lit(0)).alias("row_no"), F.concat(F.lit("n"), "id").alias("id"),
                                                   F.concat(F.lit("brand new rare1 "), "text").alias("text"), "title")
    copies = corpus.filter("row_no % 200 = 7")
    d = c.withColumn("o", F.lit(0)).unionByName(new.withColumn("o", F.lit(1))).unionByName(copies.withColumn("o", F.lit(2)))
    rows = sorted(d.collect(), key=lambda r: (r["row_no"], r["o"]))
    rows[10], rows[200] = rows[200], rows[10]
    return corpus.sparkSession.createDataFrame([(i, r["id"], r["text"], r["title"]) for i, r in enumerate(rows)], "row_no long, id string, text string, title string")


def test_an_updated_index_ranks_like_a_rebuild(spark, skewed, tmp_path):
    corpus, _ = skewed
    path = str(tmp_path / "index")
    qs = spark.createDataFrame([(1, "rare1 common1 common2"), (2, "common1 brand new"), (3, "common9 common4 changed")], "qid long, question string")
    first = sg.update(corpus, path)
    assert first["added"] == 1500 and first["dead"] == 0
    now = edited(corpus)
    second = sg.update(now, path)
    changed = corpus.filter("row_no % 101 = 3 and row_no % 97 != 5").count()
    copied = corpus.filter("row_no % 200 = 7 and row_no % 97 != 5 and row_no % 101 != 3").count()
    assert second["added"] == 15 + copied + changed  # new ones, copies, changed ones; nothing else is tokenised
    want = ix.build_bm25_index(now)
    got = sg.load(spark, path)
    assert ranking(rt.bm25_topk(qs, got, 40)) == ranking(rt.bm25_topk(qs, want, 40))
    assert ranking(rt.bm25_topk(qs, got, 40, broadcast_rows=0)) == ranking(rt.bm25_topk(qs, want, 40))
    a, b = got.stats.first(), want.stats.first()
    assert a["n_docs"] == b["n_docs"] and abs(a["avgdl"] - b["avgdl"]) < 1e-9
    assert sorted(map(tuple, got.vocab.select("term", "df").collect())) == sorted(map(tuple, want.vocab.select("term", "df").collect()))
    assert sg.update(now, path)["added"] == 0
    assert sg.compact(spark, path)["segments"] == [2]
    assert ranking(rt.bm25_topk(qs, sg.load(spark, path), 40)) == ranking(rt.bm25_topk(qs, want, 40))
    assert ranking(rt.bm25_topk(qs, sg.load(spark, path, version=0), 40)) == ranking(rt.bm25_topk(qs, ix.build_bm25_index(corpus), 40))


def test_an_emptied_index_and_a_broken_update(spark, tmp_path):
    path = str(tmp_path / "index")
    kind = "row_no long, id string, text string, title string"
    one = spark.createDataFrame([(0, "a", "some words", ""), (1, "a", "some words", ""), (2, None, None, None), (3, "b", "", "")], kind)
    assert sg.update(one, path)["n_docs"] == 2
    (tmp_path / "index" / "docs" / "1").mkdir()  # an update that did not finish
    assert [v["version"] for v in sg.versions(spark, path)] == [0]
    v = sg.update(spark.createDataFrame([], kind), path)
    assert v["version"] == 1 and v["n_docs"] == 0 and v["dead"] == 4
    qs = spark.createDataFrame([(1, "some words")], "qid long, question string")
    assert rt.bm25_topk(qs, sg.load(spark, path), 5).count() == 0


def test_working_storage_without_a_checkpoint_setting(tmp_path):
    """The documented fallback: a local session that names no folder (in a process of its own, with Spark's settings empty)."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from sparkqa.session import checkpoint_root, get_spark
from sparkqa.plans import workflows as wf
spark = get_spark("local[2]", 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
open("c.tsv", "w").write("1\\tred apples grow\\tt\\n2\\tgreen pears grow\\tt\\n3\\tred pears\\tt\\n4\\tblue sky\\tt\\n5\\tred sky\\tt\\n6\\tthe sea\\tt\\n7\\ta hill\\tt\\n")
open("q.tsv", "w").write("red apples\\t['apples']\\n")
wf.retrieve(spark, "c.tsv", "q.tsv", "r", topk=3)
assert wf.evaluate(spark, "r", "c.tsv", "q.tsv", "e", max_k=3).count() == 3
assert checkpoint_root(spark) == checkpoint_root(spark)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert run.returncode == 0, run.stderr[-3000:]
