"""Retrieval for question files as they arrive: X1 run per Structured Streaming micro-batch.

The index is static (a saved or freshly built ``Bm25Index``); each micro-batch of questions
is ranked with the same ``bm25_topk`` plan and written to ``<sink>/batch_id=<n>`` with
overwrite, so a batch replayed after a failure replaces its own output (effectively
exactly-once with the checkpointed source offsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.operators.index import Bm25Index
from sparkqa.operators.retrieve import bm25_topk

QUESTION_SCHEMA = "qid long, question string, answers array<string>"


def start_retrieval_stream(spark: SparkSession, questions_path: str, index: Bm25Index, sink_path: str,
                           checkpoint_path: str, topk: int = 100, available_now: bool = True,
                           fmt: str = "json", schema: str = QUESTION_SCHEMA):
    """Start the stream; returns the ``StreamingQuery``.  ``available_now`` processes what is
    there and stops (batch-style backfill); otherwise it polls every 10 seconds."""
    src = spark.readStream.schema(schema).format(fmt).load(questions_path)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        ranked = bm25_topk(df, index, topk)
        ranked.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_stream_results(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(sink_path).select("qid", "rank", "doc_id", "score", F.col("batch_id").cast("bigint"))
