"""File readers and table operators on hand-written inputs."""

import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F

from sparkqa.operators import tables as tb
from sparkqa.operators.util import global_row_number
from sparkqa.sources import files as fs


def write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return path


def test_read_corpus_header_bom_quotes_and_gz(spark):
    d = tempfile.mkdtemp()
    text = '﻿id\ttext\ttitle\n1\t"say ""hi""\nthere"\tT1\n2\tplain\t\n3\n'
    for gz in (False, True):
        p = write(os.path.join(d, "c.tsv.gz" if gz else "c.tsv"), text, gz)
        rows = fs.read_corpus(spark, p).orderBy("row_no").collect()
        assert [(r.id, r.text, r.title, r.row_no) for r in rows] == [
            ("1", 'say "hi"\nthere', "T1", 0), ("2", "plain", "", 1), ("3", "", "", 2)]


def test_read_corpus_last_duplicate_wins(spark):
    p = write(os.path.join(tempfile.mkdtemp(), "c.tsv"), "1\tfirst\tA\n1\tsecond\tB\n")
    assert [(r.id, r.text) for r in fs.read_corpus(spark, p, dedup="last").collect()] == [("1", "second")]


def test_read_qa_csv_literals(spark):
    lines = ["q1\t['a', 'b']", "q2\t[\"it's\"]", "q3\t('t1', 't2')", "q4\t['caf\\xe9']", "q5\tnot a list", "",
             "q6\t['x',]"]
    p = write(os.path.join(tempfile.mkdtemp(), "q.csv"), "\n".join(lines) + "\n")
    rows = {r.question: (r.answers, r.parse_error) for r in fs.read_qa_csv(spark, p).collect()}
    assert rows["q1"] == (["a", "b"], False)
    assert rows["q2"] == (["it's"], False)
    assert rows["q3"] == (["t1", "t2"], False)
    assert rows["q4"] == (["café"], False)
    assert rows["q5"] == (None, True)
    assert rows["q6"] == (["x"], False)


def test_read_qa_csv_range(spark):
    p = write(os.path.join(tempfile.mkdtemp(), "q.csv"), "".join(f"q{i}\t['a']\n" for i in range(6)))
    got = [r.question for r in fs.read_qa_csv(spark, p, start=2, size=3).orderBy("qid").collect()]
    assert got == ["q2", "q3", "q4"]


def test_read_kilt_and_gold(spark):
    d = tempfile.mkdtemp()
    p = write(os.path.join(d, "k.jsonl"), json.dumps({"id": "x", "input": "q’s", "output": [
        {"answer": "A"}, {"provenance": []}, {"answer": "B"}]}) + "\n")
    r = fs.read_kilt_qa(spark, p).first()
    assert (r.question, r.answers) == ("q's", ["A", "B"])
    g = write(os.path.join(d, "g.json"), json.dumps({"data": [
        {"question": "q", "question_tokens": "q", "title": "T1", "context": "c1", "example_id": "1"},
        {"question": "q", "title": "T2", "context": "c2", "example_id": "2"}]}))
    rows = fs.read_gold_passages(spark, g).collect()
    assert [(x.key, x.title, x.context) for x in rows] == [("q", "t2", "c2")]


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 503).alias("k"))
    got = [(r.k, r.n) for r in global_row_number(df, ["k"], "n").orderBy("n").collect()]
    assert [n for _, n in got] == list(range(500))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def page(tokens, title="T", pid=1):
    tags = {"<Table>", "</Table>", "<Tr>", "</Tr>", "<Td>", "</Td>", "<Th>", "</Th>"}
    return (pid, title, tokens, [t in tags for t in tokens])


def parse(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, title string, tokens array<string>, html_mask array<boolean>")
    return tb.extract_tables(df).orderBy("page_id", "table_no").collect()


def test_parser_nested_and_sibling_captions(spark):
    toks = ["<Table>", "<Tr>", "<Td>", "x", "<Table>", "<Tr>", "<Td>", "in", "</Td>", "</Tr>", "</Table>", "</Td>",
            "</Tr>", "</Table>", "<Table>", "<Tr>", "<Td>", "s", "</Td>", "</Tr>", "</Table>"]
    t = parse(spark, [page(toks)])
    # the finished outer table stays current, so the sibling is its child and takes its last cell
    assert [(x.table_no, x.parent_no, x.caption) for x in t] == [(0, -1, "T"), (1, 0, "T | x"), (2, 0, "T | x")]


def test_parser_errors_and_caption_content(spark):
    t = parse(spark, [page(["stray", "<Table>"], pid=1), page(["<Table>", "cap", "<Tr>", "<Td>", "v"], pid=2),
                      page(["<Table>", "<Tr>", "v"], pid=3)])
    assert t[0].error == "content before any table"
    assert (t[1].caption, t[1].rows[0].cells[0].tokens) == ("T cap", ["v"])
    assert t[2].error is not None


def tables_json(spark, rows_by_table):
    data = [(i + 1, {"caption": "c", "rows": [{"row": r, "columns": [{"col": j, "value": v} for j, v in enumerate(cells)]}
                                                for r, cells in enumerate(rows)], "gold_match": None})
            for i, rows in enumerate(rows_by_table)]
    return spark.createDataFrame(data, "table_id long, t struct<caption:string,rows:array<struct<row:int,"
                                       "columns:array<struct<col:int,value:string>>>>,gold_match:int>")


def brute_chunks(rows, max_len):
    lin = [(", ".join(r), sum(len(c.split(" ")) for c in r)) for r in rows]
    hs = [i for i, (s, _) in enumerate(lin) if len(s) > 1]
    if not hs:
        return []
    h = hs[0]
    chunks, cur, n = [], [lin[h][0]], lin[h][1]
    for s, ln in lin[h + 1:]:
        if len(s) > 1:
            cur.append(s)
            n += ln
        if n >= max_len:
            chunks.append("\n".join(cur) + "\n")
            cur, n = [lin[h][0]], lin[h][1]
    if len(cur) > 1:
        chunks.append("\n".join(cur) + "\n")
    return chunks


def test_chunk_tables_against_brute_force(spark):
    tables = [[["a b c", "d"], ["e", "f"], [""], ["g h", "i"], ["j", "k l m"]],
              [["long header words here", "x y"], ["a"], [""], ["b"]],
              [[""], ["x"]],
              [["", ""]]]
    for max_len in (3, 5, 100):
        got = tb.chunk_tables(tables_json(spark, tables), max_len).orderBy("id").collect()
        exp = [(i, c) for i, rows in enumerate(tables) for c in brute_chunks(rows, max_len)]
        assert [(r.table_no, r.text) for r in got] == exp


def test_mine_contexts_stop_rule(spark):
    rows = [(1, r, r, [[0, 0]] if r % 3 == 0 else None) for r in range(1, 61)]
    df = spark.createDataFrame(rows, "q long, rank long, table_id long, answer_pos array<array<int>>")
    got = [(r.rank, r.is_positive) for r in tb.mine_contexts(df).orderBy("rank").collect()]
    pos = neg = 0
    exp = []
    for _, r, _, ap in rows:
        if (pos >= 10 and neg >= 10) or neg >= 30:
            break
        exp.append((r, ap is not None))
        pos, neg = pos + (ap is not None), neg + (ap is None)
    assert got == exp


def test_file_order_across_many_splits(spark):
    d = tempfile.mkdtemp()
    for part in range(3):
        write(os.path.join(d, f"part{part}.tsv"), "".join(f"{part}-{i}\tline {i}\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = spark.read.options(sep="\t").schema("k string, v string").csv(d)
        assert raw.rdd.getNumPartitions() > 6
        got = [r.k for r in fs.with_file_order(raw).orderBy("row_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{p}-{i}" for p in range(3) for i in range(2000)]


def test_clean_tables_dedupe_first_wins_and_single_row_dropped(spark):
    t = ["<Table>", "<Tr>", "<Td>", "h", "</Td>", "</Tr>", "<Tr>", "<Td>", "v", "</Td>", "</Tr>", "</Table>"]
    header_only = ["<Table>", "<Tr>", "<Td>", "h", "</Td>", "</Tr>", "</Table>"]
    marked = ["(", "hide", ")", "This", "section", "has", "multiple", "issues"] + t
    rows = [page(t, "A", 1), page(t, "A", 2), page(header_only, "B", 3), page(t + t, "C", 4), page(marked, "D", 5)]
    pages = spark.createDataFrame(rows, "page_id long, title string, tokens array<string>, html_mask array<boolean>") \
        .withColumn("page_no", F.col("page_id"))
    tables = tb.extract_tables(pages.filter(~tb.page_has_issues(pages)))
    clean = tb.clean_tables(pages, tables).orderBy("table_id").collect()
    assert [(r.table_id, r.page_id, r.table_no) for r in clean] == [(1, 1, 0), (2, 4, 0), (3, 4, 1)]
    st = tb.table_stats(pages, tables).first()
    assert (st.pages_with_issues, st.single_row_tables, st.nested_tables, st.regular_tables, st.total_tables) == \
        (1, 1, 1, 4, 5)


def test_linearize_first_answer_row_always_taken(spark):
    t = {"caption": "c", "answer_pos": [[2, 0], [3, 0]], "gold_match": None, "rows": [
        {"row": 0, "columns": [{"col": 0, "value": "w1 w2 w3 w4 w5 w6"}]},
        {"row": 1, "columns": [{"col": 0, "value": "other"}]},
        {"row": 2, "columns": [{"col": 0, "value": "ans one"}]},
        {"row": 3, "columns": [{"col": 0, "value": "ans two"}]}]}
    schema = ("sample_id long, t struct<caption:string,answer_pos:array<array<int>>,gold_match:int,"
              "rows:array<struct<row:int,columns:array<struct<col:int,value:string>>>>>")
    df = spark.createDataFrame([(1, t)], schema)
    got = tb.linearize_tables(df, max_len=5, is_positive=True).first().text
    assert got == "w1 w2 w3 w4 w5 w6\nans one\n"      # header already past max_len, first answer row still added
    got = tb.linearize_tables(df, max_len=100, is_positive=True).first().text
    assert got == "w1 w2 w3 w4 w5 w6\nans one\nans two\nother\n"


def test_load_or_build_index_checks_parameters(spark):
    from sparkqa.sinks import writers as wr
    from sparkqa.session import scratch_path
    corpus = spark.createDataFrame([(str(i), t, "x", i) for i, t in enumerate(["a b", "b c", "c d", "a d"])],
                                   "id string, text string, title string, row_no long")
    path = scratch_path(spark, "k4-test")
    a = wr.load_or_build_bm25(spark, corpus, path, k1=1.2, b=0.75, min_df=1, max_df_ratio=1.0)
    assert a.stats.first()["k1"] == 1.2 and a.n_buckets == 64
    b = wr.load_or_build_bm25(spark, corpus, path, k1=2.0, b=0.75, min_df=1, max_df_ratio=1.0)
    assert b.stats.first()["k1"] == 2.0                      # parameters differ: rebuilt
    c = wr.load_or_build_bm25(spark, corpus, path, k1=2.0, b=0.75, min_df=1, max_df_ratio=1.0)
    assert c.stats.first()["k1"] == 2.0


def test_read_datasets_names_and_transcripts(spark):
    d = tempfile.mkdtemp()
    write(os.path.join(d, "questions.test.csv"), "q1\t['a']\nq2\t['b', 'c']\n")
    write(os.path.join(d, "nq.dev.json"), json.dumps([{"question": "q3", "answers": ["x"], "entity": "e"}]))
    ds = fs.read_datasets(spark, f"{d}/*.csv,{d}/*.json")
    assert sorted((r.dataset, r.n) for r in fs.dataset_counts(ds).collect()) == [("nq-dev", 1), ("questions-test", 2)]
    qa = spark.createDataFrame([(0, "q1", ["a"]), (1, "q2", ["b"])], "qid long, question string, answers array<string>")
    t = spark.createDataFrame([("WHO IS (None-x) IT (None-1)",), ("Plain (None-0)",)], "line string")
    rows = sorted((r.qid, r.question, r.marker_pos) for r in fs.join_transcripts(qa, t).collect()
                  if r.qid is not None)
    assert rows == [(0, "plain", 6)]          # the first marker decides; a bad number gives no qid
