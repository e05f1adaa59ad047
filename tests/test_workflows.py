"""The two file-to-file steps give the same Hit@K as the in-memory query."""

from pyspark.sql import functions as F

from sparkqa.plans import workflows as wf
from sparkqa.plans.queries import QUERIES
from sparkqa.session import scratch_path
from sparkqa.sinks import writers as wr
from sparkqa.sources import fixtures as fx


def test_retrieve_then_evaluate_matches_registered_query(spark, sf_small):
    root = scratch_path(spark, "workflow-test")
    wr.write_tsv(fx.corpus(spark, sf_small).orderBy("row_no").select("id", "text", "title"), f"{root}/corpus",
                 header=True)
    qs = fx.questions(spark, sf_small).orderBy("qid")
    wr.write_tsv(qs.select("question", wr.py_list_literal("answers").alias("answers")), f"{root}/qa")
    for rebuild in (True, False):                    # second run loads the saved index
        wf.retrieve(spark, f"{root}/corpus", f"{root}/qa", f"{root}/results", "bm25", topk=20,
                    index_root=f"{root}/indexes", force_rebuild=rebuild)
    recall = wf.evaluate(spark, f"{root}/results", f"{root}/corpus", f"{root}/qa", f"{root}/eval", max_k=20)
    got = sorted((r.k, r.hits) for r in recall.collect())
    exp = sorted((r.k, r.hits) for r in QUERIES["e5_hit_at_k"](spark, sf_small).collect())
    assert got == exp
    back = spark.read.schema("k bigint, recall double").csv(f"{root}/eval/recall_at_k").count()
    report = spark.read.json(f"{root}/eval/results")
    assert back == 20 and report.count() == qs.count()
    assert "ctxs" in report.columns and report.filter(F.size("ctxs") > 0).count() > 0


def test_tfidf_retrieve_with_saved_index(spark, sf_small):
    root = scratch_path(spark, "workflow-tfidf")
    wr.write_tsv(fx.corpus(spark, sf_small).orderBy("row_no").select("id", "text", "title"), f"{root}/corpus")
    qs = fx.questions(spark, sf_small).orderBy("qid")
    wr.write_tsv(qs.select("question", wr.py_list_literal("answers").alias("answers")), f"{root}/qa")
    runs = [sorted(tuple(r) for r in wf.retrieve(spark, f"{root}/corpus", f"{root}/qa", f"{root}/res{i}", "tfidf",
                                                topk=20, index_root=f"{root}/idx").collect()) for i in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 20 * qs.count()
    exp = sorted((r.qid, r.rank, r.doc_id) for r in QUERIES["x3_tfidf_topk"](spark, sf_small).collect())
    assert [(q, k, d) for q, k, d, _ in runs[0]] == exp


def test_tables_to_training_matches_registered_query(spark, sf_small):
    from sparkqa.plans import queries as Q
    root = scratch_path(spark, "workflow-tables")
    pages = fx.table_pages(spark, sf_small)
    pages.orderBy("page_id").select("page_id", "title", "tokens", "html_mask").coalesce(1).write.json(f"{root}/pages")
    clean = Q.clean_table_frame(spark, sf_small)
    tq = fx.table_questions(spark, sf_small)
    search = fx.table_search(spark, sf_small, clean)
    gold = fx.table_search(spark, sf_small, clean, descending=True)
    # search file: one line per question with candidates, in q order; its line number is q_index
    lists = search.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "table_id"))).alias("c")) \
        .join(tq, "q").orderBy("q").collect()
    pos = {r.q: i for i, r in enumerate(lists)}
    lines = ["\t".join([r.question, repr(list(r.answers))] + [f"{100.0 - x.rank},{x.table_id}" for x in r.c])
             for r in lists]
    spark.createDataFrame([(ln,) for ln in lines], "v string").coalesce(1).write.text(f"{root}/search")
    glists = gold.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "table_id"))).alias("c")).collect()
    glines = [",".join([str(pos[r.q])] + [f'"{x.table_id} t"' for x in r.c]) for r in glists if r.q in pos]
    spark.createDataFrame([(ln,) for ln in glines], "v string").coalesce(1).write.text(f"{root}/gold")
    # question file: the gold page of each question is its nation's smallest-key customer page
    cust = fx.table(spark, sf_small, "customer")
    gp = cust.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg((F.min("c_custkey") * 2).cast("bigint").alias("page_id"))
    nq = tq.join(gp, "n_nationkey").join(pages, "page_id").select(
        "question", F.col("id").alias("example_id"), "title", F.col("answers").alias("short_answers"),
        F.array(F.struct("tokens", "html_mask")).alias("contexts"))
    nq.write.json(f"{root}/nq")
    out = wf.tables_to_training(spark, f"{root}/pages", f"{root}/search", f"{root}/nq", f"{root}/out",
                                gold_path=f"{root}/gold")

    def flat(df, kind_col):
        return df.select("question", F.posexplode(kind_col).alias("ord", "c")).select(
            "question", F.lit(kind_col).alias("kind"), "ord", "c.caption",
            F.coalesce(F.col("c.gold_match"), F.lit(0)).cast("long").alias("gm"),
            Q.answer_pos_text("c.answer_pos").alias("ap"))
    got = flat(out, "positive_ctxs").unionByName(flat(out, "hard_negative_ctxs"))
    got = sorted((r.question, r.kind, r.ord, r.caption, r.gm, r.ap) for r in got.collect())
    kinds = {"positive": "positive_ctxs", "hard_negative": "hard_negative_ctxs"}
    exp = Q.QUERIES["t12_assemble_table_training"](spark, sf_small).join(tq.select("q", "question"), "q").collect()
    exp = sorted((r.question, kinds[r.kind], r.ord, r.caption, r.gold_match, r.answer_pos) for r in exp)
    assert got == exp and got


def test_prepare_reader_matches_registered_query(spark, sf_small):
    from sparkqa.operators import evaluate as ev
    from sparkqa.operators import retrieve as rt
    from sparkqa.plans import queries as Q
    root = scratch_path(spark, "workflow-reader")
    corpus, qs = fx.corpus(spark, sf_small), fx.questions(spark, sf_small)
    r = Q.bm25_results(spark, sf_small)
    hits = ev.match_string(r, corpus, qs, 20)
    wr.write_result_report(wr.result_report(r, qs.orderBy("qid"), corpus, hits, max_k=20).orderBy("qid").coalesce(1)
                           .drop("qid"), f"{root}/report")
    g = Q.gold_passages(spark, sf_small, r, hits).join(qs.select("question", "qid"), "question") \
        .select("question", F.regexp_replace("question", " ", "  ").alias("question_tokens"), "title",
                F.lit("ctx").alias("context"), F.col("qid").cast("string").alias("example_id")).dropDuplicates(["question"])
    g.coalesce(1).select(F.to_json(F.struct(F.collect_list(F.struct(*g.columns)).alias("data"))).alias("v")) \
        .write.text(f"{root}/gold")
    out = wf.prepare_reader(spark, f"{root}/report", f"{root}/samples", gold_path=f"{root}/gold")
    got = sorted((r.question, len(r.positive_passages), len(r.negative_passages),
                  r.positive_passages[0].doc_id) for r in out.collect())
    exp = sorted((r.question, r.n_pos, r.n_neg, r.first_positive)
                 for r in Q.QUERIES["r8_prepare_reader_data"](spark, sf_small).collect())
    assert got == exp and got
