"""File sources (S1-S13): tab CSV corpora and question sets, JSON / JSON-lines QA and training
files, table pages, search results and gold passages.

All readers use explicit schemas (no inference), return lazy DataFrames, and assign file order
(``row_no``) from the scan itself: file path, split start and the position inside the split,
then a distributed global numbering.  A ``.gz`` file is read by Spark directly.  Delimited files with
quoted line feeds are read by as many tasks as they have splits (``records``).
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkqa.functions.text import normalize_passage, normalize_question
from sparkqa.sources.json_arrays import read_array
from sparkqa.sources.records import read_records, with_record_order

TSV_OPTIONS = {"sep": "\t", "quote": '"', "escape": '"', "multiLine": "true", "header": "false",
               "mode": "PERMISSIVE"}
BOM = "﻿"


def read_tsv(spark: SparkSession, path, columns: list[str], sep: str = "\t") -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(**{**TSV_OPTIONS, "sep": sep}).schema(schema).csv(path)


def with_file_order(df: DataFrame, name: str = "row_no") -> DataFrame:
    """0-based position of each row in file order (path, then split start, then position).

    Must be applied directly on a file scan (filters and projections are fine).  Inside one
    split the scan yields rows in file order with consecutive ``monotonically_increasing_id``
    values, so only one row per split is aggregated (path, split start, first id, count); the
    running offsets over that small table - one row per split - are broadcast back.  No data
    is shuffled or rewritten, and a recomputed scan assigns the same ids.
    """
    from pyspark.sql import Window
    tagged = df.select("*", F.col("_metadata.file_path").alias("_fp"),
                       F.col("_metadata.file_block_start").alias("_fb"),
                       F.monotonically_increasing_id().alias("_fm"))
    splits = tagged.groupBy("_fp", "_fb").agg(F.min("_fm").alias("_f0"), F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).select("_fp", "_fb", "_f0", "_off")
    out = tagged.join(F.broadcast(offsets), ["_fp", "_fb"])
    return out.withColumn(name, (F.col("_off") + F.col("_fm") - F.col("_f0")).cast("bigint")) \
        .drop("_fp", "_fb", "_fm", "_f0", "_off")


def _strip_bom(c):
    return F.regexp_replace(c, "^" + BOM, "")


# --- S1 ------------------------------------------------------------------------------------------
def read_corpus(spark: SparkSession, path, dedup: str | None = None) -> DataFrame:
    """Passages ``id, text, title, row_no`` from a tab CSV (standard quoting, optional .gz).

    Rows whose first field is ``id`` (headers) are dropped; missing text/title become ``""``;
    a leading BOM is stripped from the id.  ``dedup='last'`` keeps the last row per id (the
    evaluation view); by default every row is kept (the index view).
    """
    raw = read_records(spark, path, ["id", "text", "title"], TSV_OPTIONS)
    raw = raw.withColumns({"id": _strip_bom(F.col("id")), "text": F.coalesce("text", F.lit("")), "title": F.coalesce("title", F.lit(""))})
    # header rows are dropped before numbering: row_no is the position among passages
    df = with_record_order(raw.filter(F.col("id").isNull() | (F.col("id") != "id")))
    if dedup == "last":
        from sparkqa.operators.retrieve import passages_last_wins
        df = passages_last_wins(df)
    return df


# --- S2 ------------------------------------------------------------------------------------------
def read_contexts(spark: SparkSession, path, id_col: int = 0, text_col: int = 1, title_col: int = 2,
                  id_prefix: str | None = None, normalize: bool = False, n_cols: int = 3) -> DataFrame:
    """Like S1 with configurable columns; optional id prefix; text stripped of every leading
    and trailing ``"``; optional N2; the last duplicate id wins."""
    cols = [f"c{i}" for i in range(max(n_cols, id_col + 1, text_col + 1, title_col + 1))]
    raw = with_record_order(read_records(spark, path, cols, TSV_OPTIONS).filter(F.col(f"c{id_col}") != "id"))
    sid = F.col(f"c{id_col}")
    if id_prefix:
        sid = F.concat(F.lit(id_prefix), sid)
    text = F.expr(f"trim(BOTH '\"' FROM coalesce(c{text_col}, ''))")
    if normalize:
        text = normalize_passage(text)
    df = raw.select(sid.alias("id"), text.alias("text"), F.col(f"c{title_col}").alias("title"), "row_no")
    from sparkqa.operators.retrieve import passages_last_wins
    return passages_last_wins(df)


# --- S3 ------------------------------------------------------------------------------------------
@F.pandas_udf(T.ArrayType(T.StringType()))
def _literal_list(s: pd.Series) -> pd.Series:
    """Python list/tuple literal to list of strings with ``ast.literal_eval`` (never ``eval``)."""
    def parse(v):
        if v is None:
            return None
        try:
            x = ast.literal_eval(v)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return None
        if isinstance(x, (list, tuple)) and all(isinstance(e, str) for e in x):
            return list(x)
        return None
    return s.map(parse)


JSON_LITERAL_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def parse_answer_literal(c) -> F.Column:
    """Answers field (a Python list literal) as ``array<string>``.

    The common case is parsed natively by ``from_json`` with single quotes allowed.  ``\\xNN``
    escapes are read wrongly by a JSON parser, and tuples or trailing commas give null, so
    rows with those go to an Arrow ``ast.literal_eval`` branch.
    """
    col = F.col(c) if isinstance(c, str) else c
    native = F.from_json(col, "array<string>", JSON_LITERAL_OPTIONS)
    odd = native.isNull() | col.contains("\\x") | col.contains("\\u") | col.contains("\\N")
    return F.when(odd, _literal_list(col)).otherwise(native)


def read_qa_csv(spark: SparkSession, path, question_col: int = 0, answers_col: int = 1, id_col: int = -1,
                start: int = -1, size: int = -1, suffix: str | None = None, normalize: bool = False,
                n_cols: int | None = None) -> DataFrame:
    """S3: ``qid, question, answers, id, parse_error`` from a tab CSV of question + answer literal.

    Blank and one-field rows are skipped; ``qid`` is the file position among kept rows.  With
    ``start >= 0`` only rows ``[start, start + size)`` are kept (``size = -1``: to the end).
    Rows whose literal cannot be parsed keep null answers and ``parse_error = true``.
    """
    n = n_cols or max(question_col, answers_col, id_col, 1) + 1
    cols = [f"c{i}" for i in range(n)]
    raw = read_tsv(spark, path, cols).filter(F.col(f"c{answers_col}").isNotNull())
    q = _strip_bom(F.col(f"c{question_col}"))
    if normalize or suffix:
        q = normalize_question(q, suffix)
    df = with_file_order(raw.select(
        q.alias("question"), parse_answer_literal(f"c{answers_col}").alias("answers"),
        (F.col(f"c{id_col}") if id_col >= 0 else F.lit(None).cast("string")).alias("id")), "qid")
    df = df.withColumn("parse_error", F.col("answers").isNull())
    if start >= 0:
        cond = F.col("qid") >= start
        if size != -1:
            cond = cond & (F.col("qid") < start + size)
        df = df.filter(cond)
    return df.select("qid", "question", "answers", "id", "parse_error")


# --- S4 / S5 / S6 --------------------------------------------------------------------------------
QA_JSON_SCHEMA = "question string, answers array<string>, entity string"


def read_qa_json(spark: SparkSession, path) -> DataFrame:
    """JSON array of ``{question, answers[, entity]}``; ``qid`` = position."""
    return with_record_order(read_array(spark, path, QA_JSON_SCHEMA), "qid").select("qid", "question", "answers", "entity")


def read_qa_jsonl(spark: SparkSession, path, question_attr: str = "question", answers_attr: str = "answers",
                  id_attr: str = "id", suffix: str | None = None) -> DataFrame:
    """JSON lines; answers default ``[]``; id optional; questions normalised."""
    schema = T.StructType([T.StructField(question_attr, T.StringType()),
                           T.StructField(answers_attr, T.ArrayType(T.StringType())),
                           T.StructField(id_attr, T.StringType())])
    df = spark.read.schema(schema).json(path)
    df = df.select(normalize_question(F.col(question_attr), suffix).alias("question"),
                   F.coalesce(F.col(answers_attr), F.array().cast("array<string>")).alias("answers"),
                   F.col(id_attr).alias("id"))
    return with_file_order(df, "qid").select("qid", "question", "answers", "id")


def read_kilt_qa(spark: SparkSession, path, suffix: str | None = None) -> DataFrame:
    """KILT JSON lines; question = ``input``; answers = ``answer`` of each output that has one."""
    df = spark.read.schema("id string, input string, output array<struct<answer:string>>").json(path)
    df = df.select(normalize_question(F.col("input"), suffix).alias("question"),
                   F.transform(F.filter(F.coalesce("output", F.array().cast("array<struct<answer:string>>")),
                                        lambda o: o["answer"].isNotNull()), lambda o: o["answer"]).alias("answers"),
                   "id")
    return with_file_order(df, "qid").select("qid", "question", "answers", "id")


# --- S7 ------------------------------------------------------------------------------------------
def join_transcripts(qa: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Transcript rows ``<text>(None-<n>)``: question = text before the first marker,
    stripped and lower-cased; answers from QA row ``n`` (``qa.qid``).  ``marker_pos`` is the
    character offset of the marker (the reference's sample id)."""
    line = F.col("line")
    pos = F.instr(line, "(None-")
    t = transcripts.filter(pos > 0).select(
        F.lower(F.trim(F.substring(line, F.lit(1), pos - 1))).alias("question"),
        F.expr("try_cast(regexp_extract(substring(line, instr(line, '(None-') + 6), '^(\\\\d+)\\\\)$', 1) as bigint)")
        .alias("qid"),
        (pos - 1).cast("bigint").alias("marker_pos"))
    return t.join(qa.select("qid", "answers"), "qid", "left")


# --- S8 ------------------------------------------------------------------------------------------
def dataset_name(path_col) -> F.Column:
    """File stem with ``.`` replaced by ``-``; a Spark part file is named by its folder."""
    parts = F.split(path_col, "/")
    leaf = F.element_at(parts, -1)
    name = F.when(leaf.startswith("part-"), F.element_at(parts, -2)).otherwise(leaf)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.replace(stem, F.lit("."), F.lit("-"))


def read_datasets(spark: SparkSession, patterns: str, catalog: dict | None = None) -> DataFrame:
    """Comma-separated paths/globs (or catalog names) to one question table with a
    ``dataset`` column (file stem, ``.`` to ``-``).  Patterns ending in ``.csv`` are question
    CSVs, others JSON arrays; Spark expands the globs, one scan per format."""
    pats = [(catalog or {}).get(p, p) for p in patterns.split(",") if p]
    csvs = [p for p in pats if p.rstrip("/").endswith(".csv")]
    jsons = [p for p in pats if p not in csvs]
    frames = []
    if csvs:
        raw = read_tsv(spark, csvs, ["c0", "c1"]).filter(F.col("c1").isNotNull())
        frames.append(raw.select(dataset_name(F.col("_metadata.file_path")).alias("dataset"),
                                 F.col("c0").alias("question"), parse_answer_literal("c1").alias("answers")))
    if jsons:
        raw = spark.read.schema(QA_JSON_SCHEMA).json(jsons, multiLine=True)
        frames.append(raw.select(dataset_name(F.col("_metadata.file_path")).alias("dataset"),
                                 "question", "answers", "entity"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dataset_counts(datasets: DataFrame) -> DataFrame:
    return datasets.groupBy("dataset").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# --- S9 / S10 ------------------------------------------------------------------------------------
CTX = "array<struct<text:string,title:string,score:double,passage_id:string>>"
TRAINING_SCHEMA = (f"question string, answers array<string>, positive_ctxs {CTX}, negative_ctxs {CTX}, "
                   f"hard_negative_ctxs {CTX}")


def read_training_json(spark: SparkSession, path, start: int = -1, end: int = -1) -> DataFrame:
    """JSON arrays of retriever samples; samples with no positive context dropped; optional
    ``[start, end)`` slice after the filter."""
    df = read_array(spark, path, TRAINING_SCHEMA)
    df = with_record_order(df.filter(F.size(F.coalesce("positive_ctxs", F.array())) > 0), "sample_no")
    if start >= 0 and end >= 0:
        df = df.filter((F.col("sample_no") >= start) & (F.col("sample_no") < end))
    return df


def read_training_jsonl(spark: SparkSession, path, start: int = -1, end: int = -1) -> DataFrame:
    """JSON lines; no positive filter; slice on the global line number over all files."""
    df = with_file_order(spark.read.schema(TRAINING_SCHEMA).json(path), "sample_no")
    if start >= 0 and end >= 0:
        df = df.filter((F.col("sample_no") >= start) & (F.col("sample_no") < end))
    return df


# --- S11 -----------------------------------------------------------------------------------------
TABLE_PAGE_SCHEMA = "page_id bigint, title string, doc_url string, tokens array<string>, html_mask array<boolean>"


def read_table_pages(spark: SparkSession, path) -> DataFrame:
    """JSON lines ``{tokens[], html_mask[], title, doc_url}`` feeding T1."""
    df = spark.read.schema(TABLE_PAGE_SCHEMA).json(path)
    df = with_file_order(df, "page_no")
    return df.withColumn("page_id", F.coalesce("page_id", "page_no"))


# --- S12 -----------------------------------------------------------------------------------------
def line_fields(line, sep: str) -> F.Column:
    """All fields of a delimited line of any width (standard quoting, doubled quotes)."""
    s = f"\\x{ord(sep):02x}"
    raw = F.regexp_extract_all(line, F.lit(f'(?:^|{s})("(?:[^"]|"")*+"|[^{s}]*+)'), F.lit(1))
    return F.transform(raw, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), F.replace(
        F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def _rows_of_fields(spark: SparkSession, path, sep: str, name: str) -> DataFrame:
    """One row a line: its file position and its fields.  Lines are split by the scan, so a large
    file is many tasks."""
    lines = with_file_order(spark.read.text(path), name)
    return lines.select(name, line_fields(F.col("value"), sep).alias("f"))


def _candidates(first: int) -> F.Column:
    """The non-empty fields from position ``first`` on."""
    return F.filter(F.slice("f", first, F.greatest(F.size("f") - first + 1, F.lit(0))), lambda x: x != "")


def read_search_results(spark: SparkSession, path) -> DataFrame:
    """Lines ``question, answers-literal, "score,id", ...`` of any width to long form
    ``q_index, question, answers, rank, score, table_id``; a line without candidates keeps one
    row with null rank."""
    raw = _rows_of_fields(spark, path, "\t", "q_index")
    df = raw.select("q_index", F.get("f", F.lit(0)).alias("question"), parse_answer_literal(F.get("f", F.lit(1))).alias("answers"),
                    F.posexplode_outer(_candidates(3)).alias("pos", "cand"))
    return df.select("q_index", "question", "answers", (F.col("pos") + 1).cast("bigint").alias("rank"),
                     F.split_part("cand", F.lit(","), F.lit(1)).cast("double").alias("score"),
                     F.split_part("cand", F.lit(","), F.lit(2)).cast("bigint").alias("table_id"))


def read_gold_results(spark: SparkSession, path) -> DataFrame:
    """S12 (gold): lines ``q_index, "id ...", ...`` of any width to ``q_index, rank, table_id`` (first
    whitespace token of each field)."""
    df = _rows_of_fields(spark, path, ",", "_no").select(F.get("f", F.lit(0)).cast("bigint").alias("q_index"),
                                                         F.posexplode(_candidates(2)).alias("pos", "cand"))
    return df.select("q_index", (F.col("pos") + 1).cast("bigint").alias("rank"),
                     F.split(F.trim("cand"), r"\s+")[0].cast("bigint").alias("table_id"))


# --- S13 -----------------------------------------------------------------------------------------
def read_gold_passages(spark: SparkSession, path) -> DataFrame:
    """``{"data": [{question, question_tokens?, title, context, example_id}]}`` keyed by
    both question forms (title lower-cased); later duplicates of a key win."""
    schema = "question string, question_tokens string, title string, context string, example_id string"
    items = with_record_order(read_array(spark, path, schema, member="data"), "order")
    base = items.withColumn("title", F.lower("title"))
    keys = base.select(F.col("question").alias("key"), "*").unionByName(
        base.filter(F.col("question_tokens").isNotNull()).select(F.col("question_tokens").alias("key"), "*"))
    last = keys.groupBy("key").agg(F.max_by(F.struct("question", "title", "context", "example_id"),
                                            F.col("order")).alias("g"))
    return last.select("key", "g.question", "g.title", "g.context", "g.example_id")
