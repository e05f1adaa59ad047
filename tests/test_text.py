"""Column functions against hand-written values and Python brute force."""

import re
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sparkqa.functions import text as tx


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first().o


def test_normalize_passage_strips_one_quote_each_side(spark):
    assert one(spark, tx.normalize_passage("v"), '""a\nb’s""') == '"a b\'s"'
    assert one(spark, tx.normalize_passage("v"), '"x"\n') == 'x" '
    assert one(spark, tx.normalize_passage("v"), '"') == ''


def test_normalize_question_suffix(spark):
    assert one(spark, tx.normalize_question("v", "?"), "who’s there") == "who's there?"
    assert one(spark, tx.normalize_question("v", "?"), "why?") == "why?"


def py_normalize_answer(s):
    s = s.lower()
    s = "".join(ch for ch in s if ch not in set('!"#$%&\'()*+,-./:;<=>?@[\\]^_`{|}~'))
    s = re.sub(r"\b(a|an|the)\b", " ", s)
    return " ".join(s.split())


@pytest.mark.parametrize("s", ["The  Eiffel-Tower!", "a\x1fthe\tan b", "Théâtre an der the", "An apple, the end."])
def test_normalize_answer(spark, s):
    assert one(spark, tx.normalize_answer("v"), s) == py_normalize_answer(s)


def test_unicode_tokens_and_nfd(spark):
    toks = one(spark, tx.tokenize_unicode(tx.normalize_nfd("v")), "Café, naïve!")
    assert toks == [unicodedata.normalize("NFD", t) for t in ["café", ",", "naïve", "!"]]


def test_token_ngrams_order_and_content(spark):
    out = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>").select(
        F.explode(tx.token_ngrams("t", 2)).alias("g")).select("g.*").collect()
    got = sorted((r.start, r.n, r.gram) for r in out)
    assert got == [(0, 1, "a"), (0, 2, "a b"), (1, 1, "b"), (1, 2, "b c"), (2, 1, "c")]


def test_answer_positions_keep_overlaps(spark):
    df = spark.createDataFrame([(["x", "a", "a", "a", "y"], ["a", "a"])], "c array<string>, a array<string>")
    got = df.select(tx.answer_positions("c", "a").alias("p")).first().p
    assert [(p.start, p.end) for p in got] == [(1, 2), (2, 3)]


def test_extend_span(spark):
    df = spark.createDataFrame([(2, 3, [False, False, True, False, True, True])], "s int, e int, sub array<boolean>")
    got = df.select(tx.extend_span("s", "e", "sub").alias("x")).first().x
    assert (got.start, got.end) == (1, 5)


def test_token_position(spark):
    df = spark.createDataFrame([(["[CLS]", "a", "[SEP]"],), (["a"],)], "t array<string>")
    assert [r.p for r in df.select(tx.token_position("t", "[SEP]").alias("p")).collect()] == [2, 0]


def test_token_spans_and_untokenize(spark):
    text = "  Hello, wörld\t!  "
    df = spark.createDataFrame([(1, text)], "k long, text string")
    spans = tx.token_spans(df, "k", "text").orderBy("pos").collect()
    assert [(s.token, s.start, s.end) for s in spans] == [("Hello", 2, 7), (",", 7, 8), ("wörld", 9, 14), ("!", 15, 16)]
    assert tx.untokenize(tx.token_spans(df, "k", "text"), "k").first().text == "Hello, wörld\t!"


def test_entity_groups(spark):
    rows = [(1, i, t, g) for i, (t, g) in enumerate([("a", "O"), ("b", "P"), ("c", "P"), ("d", "O"), ("e", "L"),
                                                      ("f", "P")])]
    df = spark.createDataFrame(rows, "k long, pos long, tok string, tag string")
    got = sorted((r.text, r.tag) for r in tx.entity_groups(df, "k", "pos", "tok", "tag").collect())
    assert got == [("b c", "P"), ("e", "L"), ("f", "P")]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=0, max_size=12),
       st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=3))
def test_answer_positions_property(spark, ctx, ans):
    df = spark.createDataFrame([(ctx, ans)], "c array<string>, a array<string>")
    got = [(p.start, p.end) for p in df.select(tx.answer_positions("c", "a").alias("p")).first().p]
    exp = [(i, i + len(ans) - 1) for i in range(len(ctx) - len(ans) + 1) if ctx[i:i + len(ans)] == ans]
    assert got == exp
