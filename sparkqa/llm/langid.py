"""Language identification, words first: known words by their log frequency in each language, unseen words
by the longest character n-grams that are known.

Words are runs of letters, lower-cased.  The words of labelled texts are counted by language; every
distinct word of the corpus gets one row of weights.  A word that some labelled text holds has the log
of its smoothed frequency in each language.  Any other word is cut into n-grams (a mark at either end), and
the longest of ``LENGTHS`` of which it has known ones gives the mean of their log frequencies; a word without
any says nothing.  A text's score in a language is the sum over its words.

Weights are kept relative to what the language gives a word it has not, so a word's row holds only
the languages that have it.  Items (texts, or unseen words) meet weights in two ways: keys that make up at least one in
``BOUND`` of all occurrences, ``BOUND`` keys at most by that very rule, are broadcast and summed where the
item is read; the other keys are joined, and none of them can be hot.  Counts and weights cover all
words and grow with the corpus.  Words meet weights by 64-bit hashes; at n distinct words
n * n / 2 ** 65 pairs collide.

Edge cases: a null text or one without a letter is ``und`` with score 0; so is every text if nothing is
labelled; a null id is neither held out nor learned from; texts without a language are not learned from; ties go to the first language
by name; repeated rows are predicted each; a text of any length is read whole; an empty table gives an empty result; other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize

LENGTHS = (5, 4, 3, 2, 1)
SMOOTH = 0.5
BOUND = 1 << 20
UNKNOWN = "und"
_ENTRIES = "array<struct<lang:int,gain:double>>"


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether CRC-32 of the id's decimal text leaves ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "utf-8")) % folds == fold, F.lit(False))


def letters(text: str) -> Column:
    """All words of a text: runs of letters (with their marks), lower-cased.  A null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0))


def grams(word: str, n: int) -> Column:
    """All character n-grams of a word with a mark at either end; single characters without the marks."""
    padded = F.col(word) if n == 1 else F.concat(F.lit("_"), F.col(word), F.lit("_"))
    return F.regexp_extract_all(padded, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))


def count_words(docs: DataFrame, languages: DataFrame) -> DataFrame:
    """word, n (in all texts), learned (array<struct<lang, c>>: by language, of labelled texts) of every distinct word.

    ``docs`` (words, label): the label is null where the text is not learned from.
    """
    d = docs.select("label", F.explode("words").alias("word")).groupBy("word", "label").agg(F.count(F.lit(1)).alias("c"))
    d = d.join(F.broadcast(languages), "label", "left")  # one row a language
    entry = F.when(F.col("lang").isNotNull(), F.struct("lang", "c"))
    return d.groupBy("word").agg(F.sum("c").alias("n"), F.collect_list(entry).alias("learned"))


def _weights(rows: DataFrame) -> DataFrame:
    """``rows`` with learned counts -> ``entries``: log((c + a) / a) of the languages that have the key."""
    gain = F.transform("learned", lambda x: F.struct(x["lang"].alias("lang"), F.log1p(x["c"] / F.lit(SMOOTH)).alias("gain")))
    return rows.withColumn("entries", gain.cast(_ENTRIES))


def _floor(totals: list[float], distinct: int) -> list[float]:
    """What each language gives a key it has not: the log of its smoothed frequency."""
    return [float(np.log(SMOOTH / (t + SMOOTH * max(distinct, 1)))) for t in totals]


def _totals(rows: DataFrame, n_langs: int) -> tuple[list[float], int]:
    """Occurrences by language of ``rows`` (learned) and the number of rows that have any."""
    t = [0.0] * n_langs
    for lang, c in rows.select(F.explode("learned").alias("x")).groupBy("x.lang").agg(F.sum("x.c")).collect():  # a row a language
        t[lang] = float(c)
    return t, rows.filter(F.size("learned") > 0).count()


def weigh(items: DataFrame, facts: list[str], table: DataFrame, total: int, n_langs: int) -> DataFrame:
    """Sum the weights of each item's keys.

    ``items``: the columns ``facts`` and ``keys`` (array<bigint>, repeats count).  ``table``: key, n, entries; ``total``
    is the sum of n.  Returns facts, n_keys, hits (keys that the table has) and gains (array<double>, by language; null without keys).
    """
    spark = items.sparkSession
    least = -(-total // BOUND)
    top = table.filter(F.col("n") >= least).select("key", F.col("entries.lang").alias("l"), F.col("entries.gain").alias("g")).toArrow()
    keys = np.asarray(top.column("key").combine_chunks())
    order = np.argsort(keys)
    lists = top.column("l").combine_chunks()
    size = np.asarray(lists.value_lengths(), dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    shared = spark.sparkContext.broadcast((keys[order], first[:-1][order], size[order], np.asarray(lists.flatten(), dtype=np.int32),
                                           np.asarray(top.column("g").combine_chunks().flatten(), dtype=np.float64)))
    kinds = dict(items.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in facts)

    def run(batches):
        known, at, many, lang, gain = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                b = whole.slice(i, 2000)
                lists = b.column("keys")
                k, n = np.asarray(lists.flatten()), np.asarray(lists.value_lengths(), dtype=np.int64)
                row = np.repeat(np.arange(len(n)), n)
                place = np.searchsorted(known, k)
                here = place < len(known)
                here[here] = known[place[here]] == k[here]
                p, r = place[here], row[here]
                src = np.repeat(at[p] - (np.cumsum(many[p]) - many[p]), many[p]) + np.arange(int(many[p].sum()))
                cell = np.repeat(r, many[p]) * n_langs + lang[src]
                sums = np.bincount(cell, gain[src], len(n) * n_langs).astype(float)  # whole numbers if there is nothing to sum
                cold = np.concatenate(([0], np.cumsum(np.bincount(row[~here], minlength=len(n)))))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in facts), pa.array(n), pa.array(np.bincount(r, minlength=len(n))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * n_langs), pa.array(sums)),
                     pa.ListArray.from_arrays(pa.array(cold.astype(np.int32)), pa.array(k[~here]))], [*facts, "n_keys", "hits", "hot", "cold"])

    met = items.select(*facts, "keys").mapInArrow(run, f"{head}, n_keys bigint, hits bigint, hot array<double>, cold array<bigint>")
    met = materialize(met.withColumn("row", F.monotonically_increasing_id()), "langid-met")  # written, so numbered once
    rare = met.select("row", F.explode("cold").alias("k")).join(table.filter(F.col("n") < least), F.col("k") == F.col("key"))
    rare = rare.select("row", F.when(F.size("entries") > 0, F.col("entries")).otherwise(F.array(F.struct(F.lit(0).alias("lang"), F.lit(0.0).alias("gain")))).alias("e"))
    rare = rare.select("row", F.posexplode("e").alias("i", "x")).select("row", "x.lang", "x.gain", (F.col("i") == 0).cast("int").alias("one"))
    rare = rare.groupBy("row", "lang").agg(F.sum("gain").alias("gain"), F.sum("one").alias("one")) \
        .groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("lang", "gain")).alias("more"), F.sum("one").alias("found"))
    d = met.join(rare, F.col("row") == F.col("_row"), "left")
    more = F.coalesce("more", F.array().cast(_ENTRIES))
    both = F.transform("hot", lambda x, i: F.aggregate(F.filter(more, lambda y: y["lang"] == i), x, lambda s, y: s + y["gain"]))
    return d.select(*facts, "n_keys", (F.col("hits") + F.coalesce("found", F.lit(0))).alias("hits"), F.when(F.col("n_keys") > 0, both).alias("gains"))


def back_off(words: DataFrame, n_langs: int, floor: list[float]) -> DataFrame:
    """key, n, entries of the unseen words of ``words`` (key, word, n, learned), through the n-grams of the known ones.

    Length after length, words with at least one known n-gram are settled and the others go on.
    Entries are relative to ``floor``, the share of a known word's unseen language.
    """
    known = words.filter(F.size("learned") > 0)
    rest = words.filter(F.size("learned") == 0).select("key", "word", "n")
    base = F.array(*[F.lit(x) for x in floor]).cast("array<double>")
    out = []
    for n in LENGTHS:
        t = known.select("n", F.explode(grams("word", n)).alias("gram"), "learned").select("gram", F.explode("learned").alias("x")) \
            .groupBy("gram", "x.lang").agg(F.sum("x.c").alias("c")) \
            .groupBy("gram").agg(F.sum("c").alias("n"), F.collect_list(F.struct("lang", "c")).alias("learned"))
        t = materialize(t.withColumn("key", F.xxhash64("gram")), "langid-grams")
        totals, distinct = _totals(t, n_langs)
        low = F.array(*[F.lit(x) for x in _floor(totals, distinct)]).cast("array<double>")
        items = rest.select(F.struct("key", "word", "n").alias("of"), F.transform(grams("word", n), lambda g: F.xxhash64(g)).alias("keys"))
        met = materialize(weigh(items, ["of"], _weights(t), int(sum(totals)), n_langs), "langid-unseen")
        mean = F.transform("gains", lambda g, i: F.struct(i.alias("lang"), (g / F.col("hits") + F.get(low, i) - F.get(base, i)).alias("gain")))
        out.append(met.filter("hits > 0").select("of.key", "of.n", mean.cast(_ENTRIES).alias("entries")))
        rest = met.filter("hits = 0").select("of.*")
        if rest.isEmpty():
            return _union(out)
    silent = F.transform(base, lambda b, i: F.struct(i.alias("lang"), (-b).alias("gain")))
    out.append(rest.select("key", "n", silent.cast(_ENTRIES).alias("entries")))
    return _union(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def identify(docs: DataFrame, learn: Column, held: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; ``learn`` says which labelled rows are counted.

    The score is the probability of the predicted language under equal priors.
    """
    spark = docs.sparkSession
    label = F.when(learn, F.col(lang).cast("string"))
    d = docs.select(F.col(key).alias("doc_id"), held.alias("held_out"), label.alias("label"), letters(text).alias("words"))
    names = [r[0] for r in docs.select(label.alias("label")).filter("label is not null").distinct().orderBy("label").collect()]  # a row a language
    if not names:
        return d.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    languages = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "label string, lang int")
    words = count_words(d, languages)
    words = materialize(words.withColumn("key", F.xxhash64("word")), "langid-words")
    totals, distinct = _totals(words, len(names))
    total = words.agg(F.sum("n")).first()[0] or 0
    floor = _floor(totals, distinct)
    known = _weights(words.filter(F.size("learned") > 0)).select("key", "n", "entries")
    table = materialize(known.unionByName(back_off(words, len(names), floor)), "langid-weights")
    items = d.select("doc_id", "held_out", F.transform("words", lambda w: F.xxhash64(w)).alias("keys"))
    s = weigh(items, ["doc_id", "held_out"], table, int(total), len(names))
    base = F.array(*[F.lit(x) for x in floor]).cast("array<double>")
    s = s.withColumn("scores", F.zip_with("gains", base, lambda g, b: g + b * F.col("n_keys")))
    s = s.withColumn("most", F.array_max("scores"))
    pick = F.get(F.array(*[F.lit(x) for x in names]), F.array_position("scores", F.col("most")).cast("int") - 1)
    share = 1 / F.aggregate(F.transform("scores", lambda x: F.exp(x - F.col("most"))), F.lit(0.0), lambda a, x: a + x)
    return s.select("doc_id", "held_out", F.coalesce(pick, F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))


def predict(docs: DataFrame) -> DataFrame:
    """``identify`` of a documents table, learned from all labelled rows but one fold in four by CRC-32 of the id."""
    held = held_out()
    return identify(docs, ~held & F.col("doc_id").isNotNull(), held)
