"""Column-level text functions (normalisation, tokenisation, n-grams, spans).

Everything here returns a ``Column`` built from JVM-side SQL functions, so it stays inside
whole-stage code generation.  The one thing Spark has no built-in for, Unicode NFD, lives in
``sparkqa.functions.unicode`` and is only invoked for non-ASCII rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkqa.functions.unicode import nfd

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------------------------
# BM25 token: a run of ASCII letters or digits, lower-cased afterwards.
ALNUM_PATTERN = "[A-Za-z0-9]+"
# Answer-matching tokenizer: a run of letters/digits/marks, else one non-space non-control char.
UNICODE_TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}]"
# TF-IDF word: two or more word characters (letters, digits, underscore), on lower-cased text.
WORD2_PATTERN = r"[\p{L}\p{N}_]{2,}"
# The 32 ASCII punctuation characters removed by answer normalisation.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Right single quotation mark, replaced by an apostrophe in questions and passages.
RIGHT_SINGLE_QUOTE = "’"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- N1 / N2 ----------------------------------------------------------------------------------
def normalize_question(q, suffix: str | None = None) -> Column:
    """Curly apostrophe to ``'``; append ``suffix`` unless the question already ends with it."""
    out = F.replace(_col(q), F.lit(RIGHT_SINGLE_QUOTE), F.lit("'"))
    if suffix:
        out = F.when(F.endswith(out, F.lit(suffix)), out).otherwise(F.concat(out, F.lit(suffix)))
    return out


def normalize_passage(t) -> Column:
    """Newline to space, curly apostrophe to ``'``, drop one leading and one trailing quote."""
    out = F.replace(F.replace(_col(t), F.lit("\n"), F.lit(" ")), F.lit(RIGHT_SINGLE_QUOTE), F.lit("'"))
    out = F.regexp_replace(out, '^"', "")
    return F.regexp_replace(out, '"\\z', "")


# --- N3 ----------------------------------------------------------------------------------------
def normalize_nfd(t) -> Column:
    """Unicode NFD through an Arrow-batched UDF.

    Spark evaluates a Python UDF for every row of its projection, so ASCII rows (unchanged by
    NFD) are handed to it as null - nothing to transfer - and keep their own value.
    """
    c = _col(t)
    return F.coalesce(nfd(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)


# --- N4 / N14 ---------------------------------------------------------------------------------
def normalize_answer(s) -> Column:
    """Lower, strip ASCII punctuation, articles to space, collapse whitespace, trim."""
    out = F.translate(F.lower(_col(s)), ASCII_PUNCTUATION, "")
    out = F.regexp_replace(out, r"(?U)\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(out, r"(?U)[\s\x1c-\x1f]+", " "))


def exact_match(pred, gold) -> Column:
    """Normalised prediction equals normalised gold answer."""
    return normalize_answer(pred) == normalize_answer(gold)


# --- N5 / N6 / N7 -----------------------------------------------------------------------------
def tokenize_alnum(t) -> Column:
    """ASCII alphanumeric runs, lower-cased (BM25 tokens)."""
    return F.transform(F.regexp_extract_all(F.coalesce(_col(t), F.lit("")), F.lit(ALNUM_PATTERN), 0),
                       lambda x: F.lower(x))


def tokenize_words(t) -> Column:
    """N6 (before stop-word removal): words of two or more word characters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(t), F.lit(""))), F.lit(WORD2_PATTERN), 0)


def tokenize_unicode(t, uncased: bool = True) -> Column:
    """letters/digits/marks runs or single visible characters; optionally lower-cased per token."""
    toks = F.regexp_extract_all(F.coalesce(_col(t), F.lit("")), F.lit(UNICODE_TOKEN_PATTERN), 0)
    return F.transform(toks, lambda x: F.lower(x)) if uncased else toks


def match_key(tokens, sep: str = " ") -> Column:
    """Tokens joined with ``sep`` and framed by it, so a contiguous run test is one ``instr``."""
    return F.concat(F.lit(sep), F.array_join(_col(tokens), sep), F.lit(sep))


# --- N11 / N12 / N13 --------------------------------------------------------------------------
def token_position(tokens, token: str) -> Column:
    """0-based position of the first ``token`` in the sequence, 0 when missing."""
    return F.greatest(F.array_position(_col(tokens), F.lit(token)) - 1, F.lit(0)).cast("bigint")


def answer_positions(ctx, ans) -> Column:
    """Every inclusive (start, end) where array ``ans`` occurs contiguously in array ``ctx``.

    Both arrays must be materialised columns (the lambdas index them).
    """
    c, a = _col(ctx), _col(ans)
    n, m = F.size(c), F.size(a)
    starts = F.when((m > 0) & (n >= m), F.sequence(F.lit(0), n - m)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(starts, lambda i: F.slice(c, i + 1, m) == a)
    return F.transform(hits, lambda i: F.struct(i.alias("start"), (i + m - 1).alias("end")))


def extend_span(start, end, is_sub_word) -> Column:
    """Widen [start, end] to whole words given a per-token ``is_sub_word`` flag array."""
    s, e, sub = _col(start), _col(end), _col(is_sub_word)
    n = F.size(sub)
    new_s = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), s),
                                            lambda i: ~F.get(sub, i))), F.lit(0))
    new_e = F.array_min(F.filter(F.sequence(e, n - 1),
                                 lambda i: (i == n - 1) | ~F.get(sub, i + 1)))
    return F.struct(new_s.alias("start"), F.coalesce(new_e, e).alias("end"))


# --- N15 / N16 --------------------------------------------------------------------------------
def prepare_answer_tokens(a) -> Column:
    """NFD, lower-case, split on a single space (empty strings kept)."""
    return F.split(F.lower(normalize_nfd(a)), " ", -1)


def meta_text(text, title, use_title: bool = False, compressed: bool = False) -> Column:
    """Passage text, optionally prefixed by ``title + ' . '``; with ``compressed`` both
    fields are zlib-compressed bytes and are decompressed first (Arrow UDF)."""
    from sparkqa.functions.unicode import zlib_text
    tx_, ti = _col(text), _col(title)
    if compressed:
        tx_, ti = zlib_text(tx_), zlib_text(ti)
    t = F.coalesce(tx_, F.lit(""))
    if use_title:
        return F.concat(F.coalesce(ti, F.lit("")), F.lit(" . "), t)
    return t


def _gram_struct(k: int):
    def make(g, i):
        return F.struct(i.cast("bigint").alias("start"), F.lit(k).cast("bigint").alias("n"), g.alias("gram"))
    return make


# --- N9 / N10 -----------------------------------------------------------------------------------
def token_ngrams(tokens, n: int = 2, keep=None) -> Column:
    """All n-grams of length 1..n as ``array<struct<start, n, gram>>``.

    Grams of one length are built with ``zip_with`` over shifted slices (linear in the array;
    no lambda indexes the token array).  ``keep`` is an optional predicate on the gram struct
    (the reference's ``filter_fn`` negated).  Sort the exploded rows by (start, n) for the
    reference's order.
    """
    t = _col(tokens)
    size = F.size(t)
    parts = []
    prev = t
    for k in range(1, n + 1):
        if k > 1:
            m = F.greatest(size - k + 1, F.lit(0))
            prev = F.when(m > 0, F.zip_with(F.slice(prev, 1, F.greatest(m, F.lit(1))),
                                            F.slice(t, k, F.greatest(m, F.lit(1))),
                                            lambda a, b: F.concat_ws(" ", a, b))
                          ).otherwise(F.array().cast("array<string>"))
        parts.append(F.transform(prev, _gram_struct(k)))
    out = F.concat(*parts) if len(parts) > 1 else parts[0]
    return F.filter(out, keep) if keep is not None else out


# --- N8 -------------------------------------------------------------------------------------------
# A token followed by the separators up to the next token (its "text with whitespace").
TOKEN_WS_PATTERN = r"(?:[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}])[\p{Z}\p{C}]*"


def token_spans(df, key: str, text_col: str = "text"):
    """Long table ``key, pos, token, start, end, text_ws`` (offsets in characters, end
    exclusive; the last token's ``text_ws`` has no trailing separators).

    Pieces of token + following separators come from one regex pass; offsets are the length
    of the leading separators plus a running sum of piece lengths over the document's pieces.
    """
    from pyspark.sql import Window
    t = F.coalesce(F.col(text_col), F.lit(""))
    pieces = df.select(key, F.length(F.regexp_extract(t, r"^[\p{Z}\p{C}]*", 0)).alias("_lead"),
                       F.posexplode(F.regexp_extract_all(t, F.lit(TOKEN_WS_PATTERN), 0)).alias("pos", "_piece"))
    tok = F.regexp_extract("_piece", r"^(?:[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}])", 0)
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    wl = Window.partitionBy(key)
    p = pieces.withColumn("token", tok) \
        .withColumn("start", (F.col("_lead") + F.coalesce(F.sum(F.length("_piece")).over(w), F.lit(0))).cast("bigint")) \
        .withColumn("_last", F.col("pos") == F.max("pos").over(wl))
    return p.select(key, F.col("pos").cast("bigint").alias("pos"), "token", "start",
                    (F.col("start") + F.length("token")).cast("bigint").alias("end"),
                    F.when(F.col("_last"), F.col("token")).otherwise(F.col("_piece")).alias("text_ws"))


def untokenize(spans_df, key: str):
    """``untokenize``: the document's ``text_ws`` pieces in order, joined and stripped."""
    agg = spans_df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "text_ws"))).alias("_p"))
    return agg.select(key, F.trim(F.array_join(F.transform("_p", lambda x: x["text_ws"]), "")).alias("text"))


# --- N10 ------------------------------------------------------------------------------------------
def entity_groups(tagged, key: str, pos: str, token: str, tag: str, non_entity: str = "O"):
    """Runs of consecutive tokens with the same tag (other than ``non_entity``) as
    ``key, group_no, text, tag, start, n``; ``group_no`` counts the key's earlier runs of any tag.

    Gaps and islands without a per-key window (a key may hold a third of all rows): two
    distributed global numberings, by (key, pos) and by (key, tag, pos), minus each group's
    first number give the row's rank in its key and in its (key, tag); their difference is
    constant along a run.  A third numbering over the run starts gives ``group_no``.  Only the
    per-key / per-(key, tag) minimums are aggregated (map-side partial).
    """
    from sparkqa.operators.util import global_row_number
    base = tagged.select(key, pos, token, tag)
    a = global_row_number(base, [key, pos], "_ga")
    a = a.join(a.groupBy(key).agg(F.min("_ga").alias("_ma")), key).withColumn("_ra", F.col("_ga") - F.col("_ma"))
    b = global_row_number(a.select(key, pos, token, tag, "_ra"), [key, tag, pos], "_gb")
    b = b.join(b.groupBy(key, tag).agg(F.min("_gb").alias("_mb")), [key, tag]) \
        .withColumn("_isl", F.col("_ra") - (F.col("_gb") - F.col("_mb")))
    runs = b.groupBy(key, tag, "_isl").agg(
        F.min(pos).alias("start"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(token).alias("t")))).alias("_toks"))
    numbered = global_row_number(runs.select(key, "start", tag, "_isl"), [key, "start"], "_gr")
    numbered = numbered.join(numbered.groupBy(key).agg(F.min("_gr").alias("_mr")), key) \
        .select(key, tag, "_isl", (F.col("_gr") - F.col("_mr")).alias("group_no"))
    out = runs.filter(F.col(tag) != non_entity).join(numbered, [key, tag, "_isl"])
    return out.select(key, F.col("group_no").cast("bigint").alias("group_no"),
                      F.array_join(F.transform("_toks", lambda x: x["t"]), " ").alias("text"), tag,
                      F.col("start").cast("bigint").alias("start"), F.col("n").cast("bigint").alias("n"))
