"""Tables at size: parsing in parts, answer positions without a row a cell, chunks by one pass, samples made once."""
import pyarrow as pa

from sparkqa.operators import tables as tb


def _pages(n):
    tokens = ["<Table>", "cap", "<Tr>", "<Td>", "a", "b", "</Td>", "</Tr>", "</Table>"]
    mask = [t.startswith("<") for t in tokens]
    t = pa.list_(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(["t"] * n), pa.array([tokens] * n, t), pa.array([mask] * n, pa.list_(pa.bool_()))],
        ["page_id", "title", "tokens", "html_mask"])


def test_pages_of_a_batch_are_parsed_in_parts(monkeypatch):
    monkeypatch.setattr(tb, "PARSE_TOKENS", 90)
    parts = list(tb._parse_pages(iter([_pages(35)]), True))
    assert [p.num_rows for p in parts] == [10, 10, 10, 5]
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["page_id"] for r in rows] == list(range(35))
    assert {r["caption"] for r in rows} == {"t cap"}
    assert rows[34]["rows"] == [{"row": 0, "cells": [{"col": 0, "tokens": ["a", "b"]}]}]


def test_chunks_of_a_long_table_copy_nothing(spark):
    from pyspark.sql import functions as F
    n = 30_000
    row = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(i.cast("int").alias("row"), F.array(
        F.struct(F.lit(0).alias("col"), F.concat(F.lit("w"), i.cast("string")).alias("value"))).alias("columns")))
    t = spark.range(1, 2).select(F.col("id").alias("table_id"), F.struct(F.lit("c").alias("caption"), row.alias("rows")).alias("t"))
    got = tb.chunk_tables(t, 2)
    assert "aggregate(" not in got._jdf.queryExecution().toString()  # Spark's fold copies its array at every row
    assert got.count() == n - 1
    assert got.orderBy("id").first()["text"] == "w0\nw1\n"


def test_table_samples_are_made_once(spark, sf_small):
    from sparkqa.plans.queries import QUERIES
    for name in ("r2_table_examples", "t8_linearize_table_long"):
        assert "MapInArrow" not in QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()


def test_answers_are_found_in_whole_tables(spark):
    rows = "array<struct<row:int,cells:array<struct<col:int,tokens:array<string>>>>>"
    t = spark.createDataFrame([(1, [(0, [(0, ["É", "b"]), (1, [])]), (1, [(1, ["x", "é", "B"])])]), (2, [(0, [(0, ["n"])])])],
                              f"table_id bigint, rows {rows}")
    q = spark.createDataFrame([(7, 1, ["é b"]), (7, 2, ["b"]), (8, 3, ["b"])], "q bigint, table_id bigint, answers array<string>")
    d = tb.locate_answers(t, q)
    got = {(r["q"], r["table_id"]): r["answer_pos"] for r in d.collect()}
    assert got == {(7, 1): [[0, 0], [1, 1]], (7, 2): None, (8, 3): None}
    assert "Generate" not in d._jdf.queryExecution().executedPlan().toString()  # no row a cell is made and moved
