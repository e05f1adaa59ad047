"""Inputs that the derived fixtures do not build: wide rows, changed indexes, odd tables, nested pages."""

import pytest
from pyspark.sql import functions as F

from sparkqa.operators import tables as tb
from sparkqa.operators import training as tr
from sparkqa.sinks import writers as wr
from sparkqa.sources import files as fs


def test_search_results_of_any_width(spark, tmp_path):
    wide = "\t".join(f"{i / 2},{i}" for i in range(1, 3001))
    (tmp_path / "s.tsv").write_text(f"who, me?\t\"['a', 'b']\"\t{wide}\n\"a \"\"quoted\"\" one\"\t['c']\t\"1.5,7\"\nnone\t[]\n")
    out = fs.read_search_results(spark, str(tmp_path / "s.tsv")).orderBy("q_index", "rank").collect()
    assert len(out) == 3002 and [r["rank"] for r in out[:3000]] == list(range(1, 3001))
    assert (out[2999]["score"], out[2999]["table_id"], out[2999]["answers"]) == (1500.0, 3000, ["a", "b"])
    assert (out[3000]["question"], out[3000]["table_id"]) == ('a "quoted" one', 7) and out[3001]["rank"] is None
    (tmp_path / "g.csv").write_text("5," + ",".join(f'"{i} tbl"' for i in range(200)) + "\n7,3\n")
    gold = fs.read_gold_results(spark, str(tmp_path / "g.csv")).collect()
    assert len(gold) == 201 and max(r["rank"] for r in gold) == 200


def test_one_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "big.tsv").write_text("q\t['a']\t1.0,2\n" * 200_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        assert fs.read_search_results(spark, str(tmp_path / "big.tsv")).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def corpus(spark, extra=()):
    rows = [(str(i), f"word{i % 3} common text number {i}", "t", i) for i in range(6)] + list(extra)
    return spark.createDataFrame(rows, "id string, text string, title string, row_no long")


def test_bm25_index_is_reused_only_for_the_same_parameters_and_corpus(spark, tmp_path):
    path = str(tmp_path / "bm25")
    wr.load_or_build_bm25(spark, corpus(spark), path, k1=2.0)
    assert wr.load_or_build_bm25(spark, corpus(spark), path).stats.first()["k1"] == 1.2
    more = corpus(spark, [("9", "another text", "t", 9)])
    assert wr.load_or_build_bm25(spark, more, path).stats.first()["n_docs"] == 7
    before = spark.read.parquet(f"{path}/postings").inputFiles()
    wr.load_or_build_bm25(spark, more, path)
    assert spark.read.parquet(f"{path}/postings").inputFiles() == before


def test_tfidf_index_is_reused_only_for_the_same_parameters(spark, tmp_path):
    path = str(tmp_path / "tfidf")
    assert wr.load_or_build_tfidf(spark, corpus(spark), path, max_features=2).vocab.count() == 2
    assert wr.load_or_build_tfidf(spark, corpus(spark), path).vocab.count() > 2
    plain = wr.load_or_build_tfidf(spark, corpus(spark), path, stop_words=())
    assert plain.weights.count() > 0


def test_a_broken_identity_is_an_error_not_a_rebuild(spark, tmp_path):
    path = tmp_path / "bm25"
    wr.load_or_build_bm25(spark, corpus(spark), str(path))
    import shutil
    shutil.move(str(path / "postings"), str(tmp_path / "away"))
    with pytest.raises(Exception):  # noqa: B017 - the identity says reuse, the postings are gone
        wr.load_or_build_bm25(spark, corpus(spark), str(path)).postings.count()


def t4(rows, caption="c"):
    return (caption, [(i, [(j, v) for j, v in enumerate(r)]) for i, r in enumerate(rows)], None)


T4 = "struct<caption:string,rows:array<struct<row:int,columns:array<struct<col:int,value:string>>>>,gold_match:int,answer_pos:array<array<int>>>"


def test_tables_without_a_header_keep_their_answer_rows(spark):
    d = spark.createDataFrame([(1, (*t4([["x"], ["y"]]), [[1, 0]])), (2, (*t4([["x"], ["y"]]), [])), (3, (*t4([]), []))],
                              f"sample_id long, t {T4}")
    got = {r["sample_id"]: r["text"] for r in tb.linearize_tables(d).collect()}
    assert got == {1: "y\n", 2: "", 3: ""}


def test_examples_of_long_lists_do_not_collide(spark):
    ctx = "array<struct<caption:string>>"
    s = spark.createDataFrame([(0, "a", [("p0",)], [(f"n{i}",) for i in range(1001)]), (1, "b", [("p1",)], [("m0",)])],
                              f"q long, question string, positive_ctxs {ctx}, hard_negative_ctxs {ctx}")
    text = lambda c: s.select("q", F.posexplode(c).alias("i", "c")).select(F.struct("q", "i").alias("sample_id"), F.col("c.caption").alias("text"))
    got = {r["q"]: r for r in tr.table_examples(s, text("positive_ctxs"), text("hard_negative_ctxs"), max_negatives=2).collect()}
    assert [x["text"] for x in got[1]["hard_negatives"]] == ["m0"] and got[1]["positive"]["text"] == "p1"


def page(spark, tokens, title="T"):
    mask = [t.startswith("<") for t in tokens]
    return spark.createDataFrame([(1, title, tokens, mask)], "page_id long, title string, tokens array<string>, html_mask array<boolean>")


def parsed(spark, tokens, **kw):
    return [(r["table_no"], r["parent_no"], r["caption"], [[c["tokens"] for c in x["cells"]] for x in r["rows"] or []], r["error"])
            for r in tb.extract_tables(page(spark, tokens.split()), **kw).orderBy("table_no").collect()]


def test_nested_and_sibling_tables(spark):
    nested = "<Table> cap <Tr> <Td> a <Table> in <Tr> <Td> x </Td> </Tr> </Table> b </Td> <Th> c </Th> </Tr> <Tr> <Td> d </Td> </Tr> </Table>"
    assert parsed(spark, nested) == [(0, -1, "T cap", [[["a", "b"], ["c"]], [["d"]]], None), (1, 0, "T cap | a in", [[["x"]]], None)]
    two = "</Table> <Table> <Tr> <Td> a </Td> </Tr> </Table> <Table> <Tr> <Td> b </Td> </Tr> </Table>"
    assert parsed(spark, two) == [(0, -1, "T", [[["a"]]], None), (1, 0, "T | a", [[["b"]]], None)]
    assert parsed(spark, two, sibling_as_nested=False) == [(0, -1, "T", [[["a"]]], None), (1, -1, "T", [[["b"]]], None)]
    deep = "<Table> <Tr> <Td> a <Table> <Tr> <Td> b <Table> <Tr> <Td> c </Table> </Table> e </Table>"
    assert [(t[0], t[1], t[2]) for t in parsed(spark, deep)] == [(0, -1, "T"), (1, 0, "T | a"), (2, 1, "T | a | b")]
    assert parsed(spark, deep)[0][3] == [[["a", "e"]]]


def test_broken_pages_become_error_rows(spark):
    for tokens, why in (("x <Table>", "content before any table"), ("<Table> <Tr> x", "content in a row with no cell"), ("<Tr>", "row outside a table"),
                        ("<Table> <Td>", "cell outside a row"), ("<Table> <Tr> <Table> </Table>", "nested table end in a row with no cell")):
        assert parsed(spark, tokens) == [(-1, -1, None, [], why)]
    assert parsed(spark, "") == []


def test_overlapping_spans_are_ranked_after_widening(spark):
    d = spark.createDataFrame([(1, [0.0, 5.0, 4.0, 0.0, 3.0], [0.0, 4.0, 5.0, 0.0, 3.0], [False, False, True, True, False])],
                              "pid long, start_logits array<double>, end_logits array<double>, is_sub_word array<boolean>")
    got = [(r["span_rank"], r["start"], r["end"], r["score"]) for r in tr.best_spans(d, 3, 3).orderBy("span_rank").collect()]
    # (1, 2) widens to (1, 3), so (1, 1) and (2, 2) are out; (2, 4) overlaps it and widens to (1, 4)
    assert got == [(0, 1, 3, 10.0), (1, 1, 4, 7.0)] or got[:2] == [(0, 1, 3, 10.0), (1, 1, 4, 7.0)] and len(got) == 3


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    from sparkqa.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
