"""Training-set preparation (R1-R8) and question overlap.

Model token ids are abstract in the reference; here any ``array<string>`` token column stands
in for them (the queries use the BM25 tokenizer).  "Seeded order" is a deterministic
permutation by ``md5(concat_ws(':', seed + epoch, key))``; Python's Mersenne-Twister
shuffles are not reproducible outside Python and are not attempted.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.functions import permute
from sparkqa.functions.text import answer_positions, extend_span, normalize_passage, normalize_question
from sparkqa.operators.util import global_row_number, materialize, rank_in_groups


def seeded_key(seed: int, epoch: int, key) -> F.Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed + epoch)), k.cast("string")))


# --- R1 ------------------------------------------------------------------------------------------
def retriever_examples(samples: DataFrame, normalize: bool = False, exclude_gold: bool = False,
                       suffix: str | None = None) -> DataFrame:
    """Question normalised (N1, optional suffix); with ``exclude_gold`` only positives that
    carry a ``score`` are kept, unless none does; missing negatives are ``[]``; passages
    optionally normalised (N2).  Titles stay as given (null when missing)."""
    pos = F.col("positive_ctxs")
    if exclude_gold:
        scored = F.filter(pos, lambda c: c["score"].isNotNull())
        pos = F.when(F.size(scored) > 0, scored).otherwise(pos)

    def passages(c):
        return F.transform(F.coalesce(c, F.array()), lambda x: F.struct(
            (normalize_passage(x["text"]) if normalize else x["text"]).alias("text"), x["title"].alias("title")))

    return samples.select(
        normalize_question("question", suffix).alias("query"),
        passages(pos).alias("positive_passages"),
        passages(F.col("negative_ctxs")).alias("negative_passages"),
        passages(F.col("hard_negative_ctxs")).alias("hard_negative_passages"), *[
            c for c in samples.columns if c in ("qid", "sample_no")])


# --- R2 ------------------------------------------------------------------------------------------
def table_examples(samples: DataFrame, linearized_pos: DataFrame, linearized_neg: DataFrame,
                   max_negatives: int = 1, is_train: bool = False, shuffle_positives: bool = False,
                   seed: int = 0) -> DataFrame:
    """R2: one positive and up to ``max_negatives`` hard negatives per sample (seeded order for
    shuffled lists), text from T8 and the caption as title; samples without positives dropped.

    ``samples(q, positive_ctxs, hard_negative_ctxs)``; ``linearized_*(sample_id, text)`` keyed by
    the struct (q, i) of the question and the context's position in its list.
    """
    has = samples.filter(F.size("positive_ctxs") > 0)
    pos = has.select("q", F.posexplode("positive_ctxs").alias("i", "c"))
    pos_order = seeded_key(seed, 0, F.concat_ws(":", F.col("q").cast("string"), F.col("i").cast("string"))) \
        if shuffle_positives else F.format_string("%012d", F.col("i"))
    pos = pos.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(pos_order, "i"))) \
        .filter(F.col("_r") == 1)
    neg = has.select("q", F.posexplode("hard_negative_ctxs").alias("i", "c"))
    neg_order = seeded_key(seed, 0, F.concat_ws(":", F.col("q").cast("string"), F.col("i").cast("string"))) \
        if is_train else F.format_string("%012d", F.col("i"))
    neg = neg.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(neg_order, "i"))) \
        .filter(F.col("_r") <= max_negatives)
    sid = F.struct("q", "i").alias("sample_id")
    p = pos.select("q", sid, F.col("c.caption").alias("title")).join(linearized_pos, "sample_id")
    n = neg.select("q", "_r", sid, F.col("c.caption").alias("title")).join(linearized_neg, "sample_id")
    pa = p.groupBy("q").agg(F.first(F.struct("text", "title")).alias("positive"))
    na = n.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("_r", "text", "title"))).alias("_n"))
    out = has.select("q", "question").join(pa, "q", "left").join(na, "q", "left")
    return out.select("q", "question", "positive", F.transform(F.coalesce("_n", F.array()), lambda x: F.struct(
        x["text"].alias("text"), x["title"].alias("title"))).alias("hard_negatives"))


# --- R3 / R4 / R8 ----------------------------------------------------------------------------------
def select_reader_passages(ctxs: DataFrame, questions: DataFrame, gold: DataFrame | None = None,
                           is_train: bool = True, max_retriever_passages: int = 200, max_positives: int = 20,
                           min_negatives: int = 50, max_negatives: int = 150, eval_passages: int = 100,
                           gold_page_only_positives: bool = True, skip_no_positives: bool = True,
                           include_gold_passage: bool = False, tokenize=None) -> DataFrame:
    """Choose reader passages per question.

    ``ctxs(qid, rank, doc_id, title, has_answer, tokens)``; ``questions(qid, question, answer_tokens)``
    with ``answer_tokens: array<array<string>>``; ``gold(key, title)`` (S13, optional).
    Train: of the first ``max_retriever_passages`` contexts, positives are ``has_answer`` ones
    with at least one answer span (N12); those from the gold page (title equal ignoring case)
    are kept uncapped, else the first ``max_positives`` positives; negatives = first
    min(max(10 * positives, min_negatives), max_negatives) non-answer contexts.  Eval: no
    positives, the first ``eval_passages`` contexts.  Output ``qid, kind, ord, doc_id, rank,
    spans`` plus the context columns; questions without positives dropped in training when
    ``skip_no_positives``.  With ``include_gold_passage`` the question's gold passage (``gold``
    needs ``context`` and ``example_id``; ``ctxs`` needs ``text``) is appended as the last
    positive when no selected positive has its text and it holds an answer span; it counts
    towards the negative cap.  ``tokenize`` turns the gold context into the same tokens.
    """
    c = ctxs.filter(F.col("rank") <= max_retriever_passages)
    if not is_train:
        neg = c.filter(F.col("rank") <= eval_passages).withColumn("kind", F.lit("negative"))
        return neg.withColumn("ord", (F.col("rank") - 1).cast("bigint")) \
            .withColumn("spans", F.array().cast("array<struct<start:int,end:int>>"))
    q = questions.select("qid", "question", "answer_tokens")
    pos = c.filter(F.col("has_answer")).join(q, "qid")
    spans = F.flatten(F.transform("answer_tokens", lambda a: answer_positions("tokens", a)))
    pos = pos.withColumn("spans", spans).filter(F.size("spans") > 0)
    if gold is not None and gold_page_only_positives:
        g = gold.select(F.col("key").alias("question"), F.lower("title").alias("_gt"))
        pos = pos.join(g, "question", "left").withColumn("_gold", F.lower("title") == F.col("_gt"))
    else:
        pos = pos.withColumn("_gold", F.lit(False))
    pos = pos.withColumn("_gold", F.coalesce("_gold", F.lit(False)))
    wq = Window.partitionBy("qid")
    pos = pos.withColumn("_any_gold", F.max(F.col("_gold").cast("int")).over(wq))
    pos = pos.filter((F.col("_any_gold") == 0) | F.col("_gold"))
    pos = pos.withColumn("ord", (F.row_number().over(Window.partitionBy("qid").orderBy("rank")) - 1).cast("bigint"))
    pos = pos.filter((F.col("_any_gold") == 1) | (F.col("ord") < max_positives))
    cols = [x for x in ctxs.columns if x not in ("qid", "rank", "doc_id")]
    if include_gold_passage and gold is not None:
        gp = q.join(gold.select(F.col("key").alias("question"), "title", "context", "example_id"), "question") \
            .select("qid", "answer_tokens", F.col("example_id").alias("doc_id"), "title",
                    F.col("context").alias("text"), tokenize(F.col("context")).alias("tokens"))
        gp = gp.withColumn("spans", F.flatten(F.transform("answer_tokens", lambda a: answer_positions("tokens", a)))) \
            .filter(F.size("spans") > 0)
        gp = gp.join(pos.select("qid", "text"), ["qid", "text"], "left_anti")
        last = pos.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"))
        gp = gp.join(last, "qid", "left").select(
            "qid", F.coalesce("_n", F.lit(0)).cast("bigint").alias("ord"), F.lit(None).cast("bigint").alias("rank"),
            "doc_id", "spans", *[F.lit(True).alias(c) if c == "has_answer" else F.col(c) for c in cols])
        pos = pos.select("qid", "ord", "rank", "doc_id", "spans", *cols).unionByName(gp)
    n_pos = pos.groupBy("qid").agg(F.count(F.lit(1)).alias("_np"))
    neg = c.filter(~F.col("has_answer")).join(n_pos, "qid", "left")
    if skip_no_positives:
        neg = neg.filter(F.col("_np").isNotNull())
    limit = F.least(F.greatest(F.coalesce("_np", F.lit(0)) * 10, F.lit(min_negatives)), F.lit(max_negatives))
    neg = neg.withColumn("ord", (F.row_number().over(Window.partitionBy("qid").orderBy("rank")) - 1).cast("bigint")) \
        .filter(F.col("ord") < limit)
    p = pos.select("qid", F.lit("positive").alias("kind"), "ord", "rank", "doc_id", "spans", *cols)
    n = neg.select("qid", F.lit("negative").alias("kind"), "ord", "rank", "doc_id",
                   F.array().cast("array<struct<start:int,end:int>>").alias("spans"), *cols)
    return p.unionByName(n)


def reader_sequences(selected: DataFrame, questions: DataFrame, cls: str = "[CLS]", sep: str = "[SEP]",
                     tailing_sep: bool = False, question_tokens_col: str = "question_tokens",
                     title_tokens_col: str = "title_tokens") -> DataFrame:
    """sequence = [CLS] question [SEP] title [SEP] + passage tokens (+ [SEP]); offset = the
    length of the first part (must be > 1, reported in ``offset_ok``); answer spans shifted by
    it for positives."""
    j = selected.join(questions.select("qid", question_tokens_col), "qid")
    first = F.concat(F.array(F.lit(cls)), F.col(question_tokens_col), F.array(F.lit(sep)),
                     F.col(title_tokens_col), F.array(F.lit(sep)))
    seq = F.concat(first, F.col("tokens"), F.array(F.lit(sep)) if tailing_sep else F.array().cast("array<string>"))
    j = j.withColumn("_first", first)
    off = F.size("_first")
    return j.select("qid", "kind", "ord", "doc_id", seq.alias("sequence"), off.alias("passage_offset"),
                    (off > 1).alias("offset_ok"),
                    F.transform("spans", lambda s: F.struct((s["start"] + off).alias("start"),
                                                            (s["end"] + off).alias("end"))).alias("answer_spans"))


def prepare_reader_data(selected: DataFrame, questions: DataFrame, **kw) -> DataFrame:
    """R3 + R4 as one job, one row per question with its positive and negative passages
    (lists bounded by the R3 caps)."""
    seqs = reader_sequences(selected, questions, **kw)
    agg = seqs.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "positive", F.struct(
            "ord", "doc_id", "sequence", "passage_offset", "answer_spans")))).alias("positive_passages"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "negative", F.struct(
            "ord", "doc_id", "sequence", "passage_offset")))).alias("negative_passages"))
    return questions.select("qid", "question").join(agg, "qid")


# --- R5 ------------------------------------------------------------------------------------------
def span_candidates(start_logits, end_logits, max_answer_length: int) -> F.Column:
    """All (start, end) with end - start < max_answer_length as one array of (order, start, end),
    where order is minus the sum of the two logits, so that an ascending sort puts the best first
    (ties by start, then end)."""
    s, e = F.col(start_logits), F.col(end_logits)
    return F.flatten(F.transform(s, lambda a, i: F.transform(F.slice(e, i + 1, max_answer_length), lambda b, d: F.struct(
        (-(a.cast("double") + b.cast("double"))).alias("order"), i.alias("start"), (i + d).alias("end")))))


def best_spans(logits: DataFrame, max_answer_length: int = 10, top_spans: int = 1) -> DataFrame:
    """The best span(s) of each passage, widened to whole words.

    ``logits(pid, start_logits, end_logits, is_sub_word)``; one row holds a passage, so the choice
    is a fold over its sorted candidates with no shuffle: a candidate is taken while fewer than
    ``top_spans`` are, unless it and a taken (widened) span lie one inside the other.
    """
    d = logits.select("pid", "is_sub_word", F.array_sort(span_candidates("start_logits", "end_logits", max_answer_length)).alias("_c"))
    none = F.array().cast("array<struct<order:double,start:int,end:int>>")

    def nested(taken, x):
        return F.exists(taken, lambda y: ((x["start"] <= y["start"]) & (y["end"] <= x["end"])) |
                        ((y["start"] <= x["start"]) & (x["end"] <= y["end"])))

    def take(taken, x):
        wide = extend_span(x["start"], x["end"], F.col("is_sub_word"))
        more = F.struct(x["order"].alias("order"), wide["start"].cast("int").alias("start"), wide["end"].cast("int").alias("end"))
        return F.when((F.size(taken) >= top_spans) | nested(taken, x), taken).otherwise(F.concat(taken, F.array(more)))

    chosen = d.select("pid", F.posexplode(F.aggregate("_c", none, take)).alias("_r", "_s"))
    return chosen.select("pid", F.col("_r").cast("bigint").alias("span_rank"), (-F.col("_s.order")).alias("score"),
                         F.col("_s.start").alias("start"), F.col("_s.end").alias("end"))


# --- R6 / R7 -------------------------------------------------------------------------------------
def number_rows(df: DataFrame, key: str, group: str | None = None, name: str = "number") -> DataFrame:
    """``df`` with dense numbers from 0 in ``key`` order (inside each ``group``), written once: all epochs read it."""
    d = rank_in_groups(df, group, [F.col(key)], name).withColumn(name, F.col(name) - 1) if group else global_row_number(df, [F.col(key)], name)
    return materialize(d, "numbered-rows")


def _sorted_positions(df: DataFrame, key: str, seed: int, epoch: int, shuffle: bool) -> DataFrame:
    order = [seeded_key(seed, epoch, key), F.col(key)] if shuffle else [F.col(key)]
    return global_row_number(df.select(key, *[o.alias(f"_o{i}") for i, o in enumerate(order)]),
                             [f"_o{i}" for i in range(len(order))], "_p").select(key, "_p")


def _keyed_position(number, n: int, seed: int, epoch: int) -> F.Column:
    keys = permute.round_keys(seed, epoch)
    a, b = permute.box(n)
    return permute.position(number, F.lit(n), F.lit(a), F.lit(b), keys, permute.passes(n, keys))


def epoch_shards(df: DataFrame, key: str, num_shards: int, batch_size: int, seed: int = 0, epoch: int = 0,
                 strict: bool = False, shuffle: bool = True, number: str | None = None) -> DataFrame:
    """``shard, batch, slot, key`` for one epoch.

    Seeded permutation, contiguous shards of ceil(n / num_shards) rows, batches of
    ``batch_size``; iterations = ceil (strict) or int of rows-per-shard / batch_size.  A strict
    short batch is filled from the shard start; a shard with fewer batches than iterations
    repeats its first batch; non-strict still yields its last short batch.  The permutation
    position is a distributed global numbering; the per-shard figures are ``num_shards`` rows.

    With ``number`` (a column of ``number_rows``) the permutation is a keyed bijection of the row numbers, computed
    where the row is: an epoch sorts and moves nothing.
    """
    spark = df.sparkSession
    n = df.count()
    if number is None:
        num = _sorted_positions(df, key, seed, epoch, shuffle)
    else:
        place = _keyed_position(F.col(number), n, seed, epoch) if shuffle and n else F.col(number)
        num = df.select(key, place.cast("bigint").alias("_p"))
    sps_v = -(-n // num_shards)                 # ceil(n / num_shards)
    sps = F.lit(sps_v).cast("bigint")
    num = num.withColumn("_n", F.lit(n).cast("bigint")).withColumn("_sps", sps) \
        .withColumn("shard", F.floor(F.col("_p") / F.col("_sps")).cast("bigint")) \
        .withColumn("_in", F.col("_p") - F.col("shard") * F.col("_sps"))
    base = num.select("shard", key, "_in", (F.floor(F.col("_in") / batch_size)).cast("bigint").alias("batch"),
                      (F.col("_in") % batch_size).cast("bigint").alias("slot"))
    grid = spark.range(num_shards).select(F.col("id").alias("shard")) \
        .withColumn("_n", F.lit(n).cast("bigint")).withColumn("_sps", sps) \
        .withColumn("_len", F.greatest(F.least(F.col("_sps"), F.col("_n") - F.col("shard") * F.col("_sps")), F.lit(0))) \
        .withColumn("_nb", F.ceil(F.col("_len") / batch_size).cast("bigint")) \
        .withColumn("_iters", (F.ceil(F.col("_sps") / batch_size) if strict
                               else F.floor(F.col("_sps") / batch_size)).cast("bigint")) \
        .withColumn("_last", F.col("_len") - (F.col("_nb") - 1) * batch_size)
    out = base.select("shard", "batch", "slot", key)
    if strict:
        fill = num.join(F.broadcast(grid.filter((F.col("_nb") > 0) & (F.col("_last") < batch_size))
                                    .select("shard", "_nb", "_last")), "shard") \
            .filter(F.col("_in") < batch_size - F.col("_last")) \
            .select("shard", (F.col("_nb") - 1).alias("batch"), (F.col("_last") + F.col("_in")).alias("slot"), key)
        out = out.unionByName(fill)
    extra = grid.filter(F.col("_iters") > F.col("_nb")).select(
        "shard", F.explode(F.sequence(F.col("_nb"), F.col("_iters") - 1)).alias("batch"))
    rep = num.filter(F.col("_in") < batch_size).join(F.broadcast(extra), "shard") \
        .select("shard", "batch", F.col("_in").alias("slot"), key)
    return out.unionByName(rep)


def mix_sources(sources: DataFrame, key: str, source_col: str, rates: dict | None, batch_size: int, seed: int = 0,
                epoch: int = 0, number: str | None = None) -> DataFrame:
    """Per source int(int(n / batch_size) * rate) batches drawn cyclically from its seeded
    order; sources are interleaved by a seeded permutation, each source's batches in order.  Output
    ``step, source, batch, slot, key``.  The (source, batch, slot) grid has one row per output
    row and is joined to the sources on the cyclic position.

    With ``number`` (a column of ``number_rows`` by source) a source's order and the interleaving are keyed bijections:
    no row is sorted, only the list of batches, for each source's to come in order."""
    if number is None:
        num = global_row_number(sources.select(source_col, key, seeded_key(seed, epoch, key).alias("_o")),
                                [source_col, "_o", key], "_g")
        first = num.groupBy(source_col).agg(F.min("_g").alias("_f"), F.count(F.lit(1)).alias("_n"))
        num = num.join(F.broadcast(first), source_col).withColumn("_pos", F.col("_g") - F.col("_f"))
    else:
        keys = permute.round_keys(seed, epoch)
        sizes = sources.groupBy(source_col).agg(F.count(F.lit(1)).alias("_n")).collect()  # a row a source
        table = [(r[0], r[1], *permute.box(r[1])) for r in sizes]
        first = sources.sparkSession.createDataFrame(table, sources.select(F.col(source_col), F.lit(0).cast("bigint").alias("_n"),
                                                     F.lit(0).cast("bigint").alias("_a"), F.lit(0).cast("bigint").alias("_b")).schema)
        walks = max([permute.passes(r[1], keys) for r in sizes], default=1)
        num = sources.join(F.broadcast(first), source_col)
        num = num.withColumn("_pos", permute.position(F.col(number), F.col("_n"), F.col("_a"), F.col("_b"), keys, walks))
    # no rates: every source contributes all its batches (rate 1.0)
    rate = F.coalesce(*[F.when(F.col(source_col) == F.lit(s), F.lit(float(r))) for s, r in rates.items()],
                      F.lit(0.0)) if rates else F.lit(1.0)
    plan = first.withColumn("_its", F.floor(F.floor(F.col("_n") / batch_size) * rate).cast("bigint")) \
        .filter(F.col("_its") > 0)
    grid = plan.select(source_col, "_n", F.explode(F.sequence(F.lit(0), F.col("_its") - 1)).alias("batch")) \
        .select(source_col, "_n", "batch", F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1))).alias("slot")) \
        .withColumn("_pos", ((F.col("batch") * batch_size + F.col("slot")) % F.col("_n")))
    rows = grid.join(num.select(source_col, "_pos", key), [source_col, "_pos"])
    # the step order interleaves sources by a seeded permutation of (source, j) slots; the k-th
    # slot of a source (in step order) takes that source's batch k, as the shuffled source list does
    if number is None:
        slots = plan.select(source_col, F.explode(F.sequence(F.lit(0), F.col("_its") - 1)).alias("_j"))
        slots = global_row_number(slots.withColumn(
            "_bo", seeded_key(seed, epoch, F.concat_ws(":", F.col(source_col), F.col("_j").cast("string")))),
            ["_bo", source_col, "_j"], "step")
    else:
        its = plan.select(source_col, "_its").orderBy(source_col).collect()  # a row a source
        total, starts = 0, []
        for r in its:
            starts.append((r[0], total, r[1]))
            total += r[1]
        table = sources.sparkSession.createDataFrame(starts, plan.select(F.col(source_col), F.lit(0).cast("bigint").alias("_s"),
                                                     F.lit(0).cast("bigint").alias("_its")).schema)
        slots = table.select(source_col, F.explode(F.sequence(F.col("_s"), F.col("_s") + F.col("_its") - 1)).alias("_j"))
        slots = slots.withColumn("step", _keyed_position(F.col("_j"), total, seed, epoch) if total else F.col("_j"))
    within = global_row_number(slots.select(source_col, "step"), [source_col, "step"], "_g2")
    base = within.groupBy(source_col).agg(F.min("_g2").alias("_m"))
    batches = within.join(F.broadcast(base), source_col).select(
        source_col, "step", (F.col("_g2") - F.col("_m")).alias("batch"))
    return rows.join(batches, [source_col, "batch"]) \
        .select("step", F.col(source_col).alias("source"), "batch", F.col("slot").cast("bigint").alias("slot"), key)


# --- A7 ------------------------------------------------------------------------------------------
def question_overlap(tables_side: DataFrame, regular: DataFrame, dev: DataFrame | None = None) -> DataFrame:
    """Distinct questions on each side (regular = regular ∪ dev) and in their intersection."""
    t = tables_side.select("question").distinct()
    r = regular.select("question")
    if dev is not None:
        r = r.unionByName(dev.select("question"))
    r = r.distinct()
    both = t.intersect(r)
    spark = tables_side.sparkSession
    return spark.createDataFrame([(t.count(), r.count(), both.count())],
                                 "tab_questions bigint, reg_questions bigint, overlap bigint")
