"""Operator inputs derived by Spark from the driver tables (see FIXTURES.md).

The reference works on a passage corpus and question files that are not shipped; these
functions build equivalent inputs from ``/root/testdata/sf*/`` so every query's work grows
with the tables.  The same derivations are written in SQL in ``sparkqa.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.functions.text import tokenize_alnum
from sparkqa.operators.util import rank_in_groups


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fx-corpus: ``id STRING, text, title, row_no BIGINT`` from ``documents``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text"),
        F.col("source").alias("title"),
        F.col("doc_id").cast("bigint").alias("row_no"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fx-questions: ``qid, question, answers`` from ``benchmark`` tokens.

    question = all tokens joined by a space; answers = [tokens 7-8 joined, token 10]
    (an answer is left out when the item has too few tokens).
    """
    b = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("bigint").alias("qid"), tokenize_alnum("text").alias("tk"))
    return b.select(
        "qid",
        F.array_join("tk", " ").alias("question"),
        F.filter(F.array(F.when(F.size("tk") >= 7, F.array_join(F.slice("tk", 7, 2), " ")),
                         F.try_element_at("tk", F.lit(10))),
                 lambda a: a.isNotNull()).alias("answers"),
    )


def regex_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fx-questions-regex: the same questions with answers ``['t[a-z]{2}e', '(']``."""
    return questions(spark, sf_dir).select(
        "qid", "question", F.array(F.lit("t[a-z]{2}e"), F.lit("(")).alias("answers"))


# --- table pages (Fx-pages, Fx-dirty) --------------------------------------------------------------
# The tags and header of the generated pages.
TABLE_TAGS = ["<Table>", "</Table>", "<Tr>", "</Tr>", "<Td>", "</Td>"]
PAGE_HEADER = ["order", "status", "priority"]
ISSUES_TOKENS = ["(", "hide", ")", "This", "section", "has", "multiple", "issues"]


def _cell(tokens):
    return F.concat(F.array(F.lit("<Td>")), tokens, F.array(F.lit("</Td>")))


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fx-pages with Fx-dirty: ``page_id, page_no, title, tokens, html_mask``.

    One page per customer (title = c_name, page_id = 2 * c_custkey): a table with a header row and
    the customer's orders by o_orderkey (key, status, priority split on spaces).  Customers of the
    BUILDING segment get a second copy of their page (the next odd page_id, dedupe); customers
    with a negative balance get the issues marker as leading text (skipped pages).
    """
    o = table(spark, sf_dir, "orders")
    row_toks = F.concat(F.array(F.lit("<Tr>")), _cell(F.array(F.col("o_orderkey").cast("string"))),
                        _cell(F.array(F.col("o_orderstatus"))), _cell(F.split("o_orderpriority", " ")),
                        F.array(F.lit("</Tr>")))
    per_c = o.groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", row_toks.alias("t")))).alias("_rows"))
    header = F.concat(F.array(F.lit("<Table>"), F.lit("<Tr>")),
                      *[_cell(F.array(F.lit(h))) for h in PAGE_HEADER], F.array(F.lit("</Tr>")))
    c = table(spark, sf_dir, "customer").join(per_c, F.col("c_custkey") == F.col("o_custkey"), "left")
    body = F.flatten(F.transform(F.coalesce("_rows", F.array().cast(per_c.schema["_rows"].dataType)),
                                 lambda r: r["t"]))
    toks = F.concat(header, body, F.array(F.lit("</Table>")))
    toks = F.when(F.col("c_acctbal") < 0, F.concat(F.array(*[F.lit(t) for t in ISSUES_TOKENS]), toks)).otherwise(toks)
    pages = c.select((F.col("c_custkey") * 2).cast("bigint").alias("page_id"), F.col("c_name").alias("title"),
                     toks.alias("tokens"), "c_mktsegment")
    copies = pages.filter(F.col("c_mktsegment") == "BUILDING") \
        .withColumn("page_id", F.col("page_id") + 1)
    allp = pages.unionByName(copies).drop("c_mktsegment")
    return allp.select("page_id", F.col("page_id").alias("page_no"), "title", "tokens",
                       F.transform("tokens", lambda t: t.isin(TABLE_TAGS)).alias("html_mask"))


def table_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fx-table-search questions: per nation ``orders in <n_name>`` with answers ['1-URGENT']
    (q = 2 * nationkey) and ``orders in <n_name> none`` with ['9-NONE'] (q = 2 * nationkey + 1)."""
    n = table(spark, sf_dir, "nation")
    a = n.select((F.col("n_nationkey") * 2).cast("bigint").alias("q"), "n_nationkey",
                 F.concat(F.lit("orders in "), "n_name").alias("question"),
                 F.array(F.lit("1-URGENT")).alias("answers"))
    b = n.select((F.col("n_nationkey") * 2 + 1).cast("bigint").alias("q"), "n_nationkey",
                 F.concat(F.lit("orders in "), "n_name", F.lit(" none")).alias("question"),
                 F.array(F.lit("9-NONE")).alias("answers"))
    return a.unionByName(b).withColumn("id", F.concat(F.lit("q"), F.col("q").cast("string")))


def nation_tables(spark: SparkSession, sf_dir: str, clean: DataFrame) -> DataFrame:
    """Cleaned tables with their customer's nation and key: ``table_id, c_custkey, n_nationkey``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return clean.join(c, clean["page_id"] == c["c_custkey"] * 2).select("table_id", "c_custkey", "n_nationkey")


def table_search(spark: SparkSession, sf_dir: str, clean: DataFrame, descending: bool = False
                 ) -> DataFrame:
    """Fx-table-search candidates ``q, rank, table_id, answers``: the tables of the nation's
    customers by c_custkey (descending for the gold list), all of them."""
    nt = nation_tables(spark, sf_dir, clean)
    order = F.col("c_custkey").desc() if descending else F.col("c_custkey")
    nt = rank_in_groups(nt, "n_nationkey", [order])
    return table_questions(spark, sf_dir).join(nt, "n_nationkey").select("q", "rank", "table_id", "answers")
