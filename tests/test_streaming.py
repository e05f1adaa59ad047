"""Streaming retrieval: batch-equal results and restart without duplicates."""

from pyspark.sql import functions as F

from sparkqa.operators import index as ix
from sparkqa.operators import retrieve as rt
from sparkqa.session import scratch_path
from sparkqa.sources import fixtures as fx
from sparkqa.streaming.questions import read_stream_results, start_retrieval_stream


def test_stream_equals_batch_and_restart_is_idempotent(spark, sf_small):
    idx = ix.build_bm25_index(fx.corpus(spark, sf_small))
    qs = fx.questions(spark, sf_small)
    root = scratch_path(spark, "stream-test")
    qs.filter(F.col("qid") < 20).write.json(f"{root}/in/a")
    src = f"{root}/in/*"
    start_retrieval_stream(spark, src, idx, f"{root}/out", f"{root}/ckpt", topk=5).awaitTermination()
    # restart on the same checkpoint with no new files: nothing is reprocessed
    start_retrieval_stream(spark, src, idx, f"{root}/out", f"{root}/ckpt", topk=5).awaitTermination()
    qs.filter(F.col("qid") >= 20).write.json(f"{root}/in/b")
    start_retrieval_stream(spark, src, idx, f"{root}/out", f"{root}/ckpt", topk=5).awaitTermination()
    got = sorted(tuple(r) for r in read_stream_results(spark, f"{root}/out").drop("batch_id").collect())
    exp = sorted(tuple(r) for r in rt.bm25_topk(qs, idx, 5).collect())
    assert got == exp
    assert read_stream_results(spark, f"{root}/out").select("batch_id").distinct().count() == 2
