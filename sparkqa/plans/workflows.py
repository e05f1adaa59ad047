"""The two end-to-end steps of the reference, as file-to-file Spark jobs.

``retrieve``: corpus TSV + question CSV -> index (built or loaded, K4) -> top-k (X1/X3) ->
id normalisation (X2) -> saved results (K3).
``evaluate``: saved results + corpus + questions -> answer matching (E1-E3) -> Hit@1..K
(E5) -> ``recall_at_k`` CSV (K2) and a per-question report (K1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkqa.operators import evaluate as ev
from sparkqa.operators import index as ix
from sparkqa.operators import retrieve as rt
from sparkqa.sinks import reader_parts as rp
from sparkqa.sinks import writers as wr
from sparkqa.sources import files as fs


def retrieve(spark: SparkSession, corpus_path: str, questions_path: str, out_path: str, model: str = "bm25",
             topk: int = 100, index_root: str | None = None, force_rebuild: bool = False) -> DataFrame:
    """Rank the top-``topk`` passages of every question and save them (Parquet) at ``out_path``.

    Indexes are saved under ``index_root`` (model, parameters and corpus path in the folder
    name) and reused unless ``force_rebuild``.
    """
    corpus = fs.read_corpus(spark, corpus_path)
    questions = fs.read_qa_csv(spark, questions_path)
    if model == "bm25":
        params = {"k1": 1.2, "b": 0.75, "min_df": 2, "max_df_ratio": 0.3}
        if index_root:
            corpus_id = corpus_path.strip("/").replace("/", "_")
            index = wr.load_or_build_bm25(spark, corpus, wr.index_path(index_root, "bm25", params, corpus_id),
                                          force_rebuild, **params)
        else:
            index = ix.build_bm25_index(corpus, **params)
        results = rt.bm25_topk(questions, index, topk)
    elif model == "tfidf":
        if index_root:
            corpus_id = corpus_path.strip("/").replace("/", "_")
            path = wr.index_path(index_root, "tfidf", {"max_features": 200_000, "ngram_max": 2}, corpus_id)
            index = wr.load_or_build_tfidf(spark, corpus, path, force_rebuild)
        else:
            index = ix.build_tfidf_index(corpus)
        results = rt.tfidf_topk(questions, index, corpus, topk)
    else:
        raise ValueError(f"unknown model {model!r}")
    results = rt.normalize_doc_ids(results, corpus, rt.result_bound(questions, topk))
    wr.save_results(results, out_path)
    return wr.load_results(spark, out_path)


def evaluate(spark: SparkSession, results_path: str, corpus_path: str, questions_path: str, out_dir: str,
             match_type: str = "string", max_k: int | None = None, no_text: bool = False) -> DataFrame:
    """Hit@1..K of saved results; writes ``recall_at_k`` (CSV) and ``results`` (JSON lines)
    under ``out_dir`` and returns the recall table."""
    from pyspark.sql import functions as F
    corpus = fs.read_corpus(spark, corpus_path)
    questions = fs.read_qa_csv(spark, questions_path)
    results = wr.load_results(spark, results_path).withColumn("score", F.col("score").cast("double"))
    hits = ev.MATCHERS[match_type](results, corpus, questions, max_k)
    recall = ev.hit_at_k(hits, questions, max_k)
    wr.write_recall(recall, f"{out_dir.rstrip('/')}/recall_at_k")
    report = wr.result_report(results, questions, corpus, hits, no_text=no_text, max_k=max_k)
    wr.write_result_report(report, f"{out_dir.rstrip('/')}/results")
    return recall


NQ_TABLE_SCHEMA = ("question string, example_id string, title string, short_answers array<string>, "
                   "contexts array<struct<tokens:array<string>,html_mask:array<boolean>>>")


def tables_to_training(spark: SparkSession, pages_path: str, search_path: str, questions_path: str,
                       out_path: str, gold_path: str | None = None) -> DataFrame:
    """Search results over table passages -> retriever training samples (JSON lines).

    Tables: S11 -> T1 -> T2 (ids 1..n in page order).  Each question's ranked tables (S12) are
    checked for answers (T9) and mined (T10); an optional gold list injects the first gold
    table with an answer (T11).  Tables of the question's own page (``contexts[0]`` of the
    question file) that hold an answer are appended as positives (T12).  Questions are
    matched between files by text.
    """
    from pyspark.sql import functions as F
    from sparkqa.operators import tables as tb
    pages = fs.read_table_pages(spark, pages_path)
    clean = tb.clean_tables(pages, tb.extract_tables(pages.filter(~tb.page_has_issues(pages))))
    search = fs.read_search_results(spark, search_path).filter(F.col("table_id").isNotNull())
    qs = search.select(F.col("q_index").alias("q"), "question", "answers").distinct()
    cand = search.select(F.col("q_index").alias("q"), "rank", "table_id", "answers")
    rows = clean.select("table_id", "rows")
    located = tb.locate_answers(rows, cand).join(cand.select("q", "table_id", "rank"), ["q", "table_id"])
    mined = tb.mine_contexts(located)
    if gold_path:
        gold = fs.read_gold_results(spark, gold_path).select(F.col("q_index").alias("q"), "rank", "table_id") \
            .join(qs.select("q", "answers"), "q")
        gold_loc = tb.locate_answers(rows, gold).join(gold.select("q", "table_id", "rank"), ["q", "table_id"])
        mined = tb.inject_gold(mined, gold_loc)
    else:
        mined = mined.withColumn("gold_match", F.lit(False))
    nq = spark.read.schema(NQ_TABLE_SCHEMA).json(questions_path)
    gp = nq.select("question", "example_id", F.col("title"),
                   F.coalesce("short_answers", F.array().cast("array<string>")).alias("short_answers"),
                   F.get(F.col("contexts"), 0).alias("c")).join(qs.select("q", "question"), "question")
    page_tables = tb.extract_tables(gp.select(F.col("q").alias("page_id"), "title", F.col("c.tokens").alias("tokens"),
                                              F.col("c.html_mask").alias("html_mask"))).filter(F.col("table_no") >= 0)
    pt = page_tables.join(gp.select(F.col("q").alias("page_id"), "short_answers"), "page_id").select(
        F.col("page_id").alias("q"), F.col("table_no").alias("ord"),
        F.struct("page_id", "table_no").alias("table_id"), "rows", "caption",
        F.col("short_answers").alias("answers"))
    loc = tb.locate_answers(pt.select("table_id", "rows"), pt.select("q", "table_id", "answers"))
    page_pos = pt.join(loc, ["q", "table_id"]).filter(F.col("answer_pos").isNotNull()) \
        .select("q", "ord", tb.to_nested_json().alias("t"), "answer_pos")
    samples = tb.assemble_table_training(
        mined, page_pos,
        gp.select("q", "question", F.col("example_id").alias("id"), F.col("short_answers").alias("answers")),
        clean.select("table_id", tb.to_nested_json().alias("t")))
    samples = samples.drop("q")
    samples.write.mode("overwrite").json(out_path)
    return spark.read.schema(samples.schema).json(out_path)


REPORT_SCHEMA = ("question string, answers array<string>, "
                 "ctxs array<struct<id:string,rank:bigint,title:string,text:string,score:string,has_answer:boolean>>")


def prepare_reader(spark: SparkSession, report_path: str, out_path: str, gold_path: str | None = None,
                   is_train: bool = True, n_parts: int = 64, wave: int = 64) -> DataFrame:
    """Retriever result reports (K1 JSON lines) -> reader samples written as Parquet parts (K9).

    Parts that an earlier run finished from the same inputs are reused; a run that broke goes on where it was.

    Passages and answers are tokenised with the BM25 tokenizer, which stands in for a model
    tokenizer; R3 selects passages (gold-page positives when ``gold_path`` is an S13 file),
    R4 builds sequences and R8 groups them per question.
    """
    from pyspark.sql import functions as F
    from sparkqa.functions.text import tokenize_alnum
    from sparkqa.operators import training as tr
    rep = fs.with_file_order(spark.read.schema(REPORT_SCHEMA).json(report_path), "qid")
    ctx = rep.select("qid", F.explode("ctxs").alias("c")).select(
        "qid", F.col("c.rank").alias("rank"), F.col("c.id").alias("doc_id"), F.col("c.title").alias("title"),
        F.coalesce(F.col("c.has_answer"), F.lit(False)).alias("has_answer"),
        tokenize_alnum(F.col("c.text")).alias("tokens"), tokenize_alnum(F.col("c.title")).alias("title_tokens"))
    q = rep.select("qid", "question", F.transform(F.coalesce("answers", F.array().cast("array<string>")),
                                                  lambda a: tokenize_alnum(a)).alias("answer_tokens"),
                   tokenize_alnum("question").alias("question_tokens"))
    gold = fs.read_gold_passages(spark, gold_path) if gold_path else None

    def prepare(some: dict[str, DataFrame]) -> DataFrame:
        return tr.prepare_reader_data(tr.select_reader_passages(some["contexts"], some["questions"], gold, is_train=is_train), some["questions"])

    inputs = {"contexts": ctx, "questions": q}
    identity = f"train={is_train}" + (f" gold={wr.corpus_fingerprint(gold, tuple(gold.columns))}" if gold is not None else "")
    rp.prepare_in_parts(inputs, prepare, out_path, n_parts=n_parts, wave=wave, identity=identity)
    return rp.read_parts(spark, out_path, prepare(inputs).schema)
