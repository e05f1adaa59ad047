"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over words (case kept), known by 64-bit hashes: every bigram of every trusted document
is counted, so the counts grow with the corpus, and a word that no trusted text holds is the
unknown word.  Counts are summed by (language, context, word) over the cluster; context totals,
continuation counts and discounts are aggregates of the counts, joined to them.

While the trusted texts hold at most ``FEW`` words, words are numbered, frequent ones first, and every task has the numbers: a
text is a row of numbers, a bigram one of (words + 1)^2, and nothing that moves is wider than its entropy.  Documents are
read once into blocks of some ``ASK_BYTES`` of text, which are written.  A block asks a shard once for each of its bigrams, with how often its
counted documents hold it; the shard's task adds that up, and so both counts the model and answers the block: a small number
for each question, in its order.  What the model needs besides (by word: how many bigrams it begins that were counted 1, 2, 3, 4 or more times,
how many it ends) is summed by ranges of words.  A block then scores its documents word by word.

Beyond ``FEW`` words, counts are rows (language, context, word, count).  There a document's log-probability is a sum over its words
of log g(h) + log q(w), plus, for each bigram that was counted, the gain log p(w|h) - log g(h) - log q(w).  The first two
are one weight a word, put right at both ends of a text.  So the model is one table of
(64-bit key, weight), and what it has not is worth nothing: an unknown context has g = 1, an unknown
word the unknown word's share, which a language adds for each word.
Keys that make up one in ``HOT`` of the counted words or bigrams, which at most ``HOT`` of either can, are broadcast and summed
where a document is read.  For the others, documents are read in blocks of about ``BLOCK_BYTES``; a block asks once for each
of its keys, with the documents that hold it.  Keys are dealt to shards by their leading bits, and both a block's
questions and a part of the model are one packed row a shard (``packed``: sorted keys by their differences), so what moves is a few bytes a
key.  A shard's task holds the shard's part of the model (some ``SHARD_KEYS`` keys) and
streams the blocks' questions against it; the answers are summed by block.

A document is rejected when its perplexity passes a quantile of its own language's trusted documents that were held out from the counts.

Edge cases: a null or empty text has no words, no perplexity, and is kept; a null language is a
language of its own; a language without trusted text rejects nothing; repeated rows are scored
alike; of repeated labels the lowest counts; an empty table gives an empty result; other columns are
passed over.  Short texts are drawn to their language's mean by ``PRIOR_WORDS`` words of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import chunks, materialize, mix64, parallel, release, word_hashes
from sparkqa.llm.packed import pack, unpack
from sparkqa.operators.util import DEFAULT_BROADCAST_ROWS

BLOCK_BYTES, ASK_BYTES, HELD = 4 << 20, 8 << 20, 4_000_000
HOT, SHARD_KEYS, FEW, SPAN = 1 << 19, 1 << 20, 8_000_000, 1 << 16
PRIOR_WORDS, QUANTILE, FOLDS = 20, 0.995, 5
START = np.uint64(0x5157A127)  # the context of a document's first word
_K = np.random.default_rng(1010).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def keys(lang: np.ndarray, h: np.ndarray | None, w: np.ndarray | None) -> np.ndarray:
    """64-bit keys of contexts (w None), words (h None) or bigrams of a language."""
    x = mix64(lang * _K[0] + _K[1 if w is None else 2 if h is None else 3])
    if h is not None:
        x = mix64(x + h * _K[4])
    if w is not None:
        x = mix64(x + w * _K[5])
    return x


def _bigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of every word, of the word before it (START at a text's first), and the texts' offsets."""
    w, _, _, at = word_hashes(data, offs, lower=False)
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[at[:-1][np.diff(at) > 0]] = START
    return h, w, at


def _by_language(d: DataFrame, few: DataFrame) -> DataFrame:
    """Join one row a language.  Broadcast while there are at most 1000 languages; a join beyond."""
    return d.join(F.broadcast(few) if few.count() <= 1000 else few, "lang", "left")


def counts(trusted: DataFrame) -> DataFrame:
    """lang, h, w, c: how often word w follows word h (as hashes) in ``trusted`` (lang as a hash, text)."""

    def run(batches):
        for batch in batches:
            for part, data, offs in chunks(batch, most=BLOCK_BYTES):
                h, w, at = _bigrams(data, offs)
                lang = np.repeat(np.asarray(part.column(0)).view(np.uint64), np.diff(at))
                _, first, n = np.unique(keys(lang, h, w), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(x[first].view(np.int64)) for x in (lang, h, w)] + [pa.array(n)], ["lang", "h", "w", "c"])

    return trusted.select("lang", "text").mapInArrow(run, "lang long, h long, w long, c long") \
        .groupBy("lang", "h", "w").agg(F.sum("c").alias("c"))


def _discounts(df: DataFrame, c: str, names: list[str]) -> DataFrame:
    """Modified Kneser-Ney discounts of each language from how many counts are 1, 2, 3 and 4."""
    n = df.groupBy("lang").agg(*[F.count_if(F.col(c) == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
    out = [F.when(F.col(f"n{k}") > 0, F.least(F.greatest(F.lit(k) - F.lit(k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.05 * k)),
                                               F.lit(0.95 * k))).otherwise(F.lit(0.5 * k)).alias(nm) for k, nm in zip((1, 2, 3), names)]
    return n.select("lang", *out)


def weights(c: DataFrame) -> tuple[list, DataFrame]:
    """The model of counts (lang, h, w, c), as parts that are each a table and a function from its batches to model rows ``key, n, weight`` (n: how
    often the key is in the trusted texts, 0 where it hardly matters); and, a row a language, ``lang, unknown``: the log-probability of the unknown word.

    p(w|h) = (c(hw) - D(c)) / c(h) + g(h) q(w), with q the continuation distribution, itself
    discounted and interpolated with the uniform one over all words and the unknown word.  A bigram's gain needs but the sum of
    its context's discounts, c(h) g(h), and q(w).
    """
    disc = lambda x, a: F.when(x == 1, F.col(f"{a}1")).when(x == 2, F.col(f"{a}2")).otherwise(F.col(f"{a}3"))
    cells = _by_language(c, _discounts(c, "c", ["d1", "d2", "d3"])).select("lang", "h", "w", "c", disc(F.col("c"), "d").alias("less"))
    ctx = materialize(cells.groupBy("lang", F.col("h").alias("x")).agg(F.sum("c").alias("total"), F.sum("less").alias("less")), "kn-contexts")
    cont = materialize(c.groupBy("lang", F.col("w").alias("x")).agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("n")), "kn-continuations")
    cont_less = _by_language(cont, _discounts(cont, "k", ["e1", "e2", "e3"])).withColumn("less", disc(F.col("k"), "e"))
    whole = materialize(cont_less.groupBy("lang").agg(F.sum("k").alias("all"), (F.sum("less") / F.sum("k") / (F.count(F.lit(1)) + 1)).alias("unk")), "kn-languages")
    q = _by_language(cont_less, whole).select("lang", "x", "n", ((F.col("k") - F.col("less")) / F.col("all") + F.col("unk")).alias("q"), "unk")
    q = materialize(q.select("lang", "x", "n", "q", F.log(F.col("q") / F.col("unk")).alias("weight")), "kn-words")

    def keyed(kind: str):
        def run(batches):
            for b in batches:
                lang, x = (np.asarray(b.column(i)).view(np.uint64) for i in (0, 1))
                k = keys(lang, x, None) if kind == "h" else keys(lang, None, x) if kind == "w" else \
                    keys(lang, x, np.asarray(b.column(2)).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), *b.columns[-2:]], ["key", "n", "weight"])
        return run

    side = lambda d, x, v: d.select(F.col("lang").alias(f"_l{x}"), F.col("x").alias(f"_{x}"), F.col(v).alias(f"_v{x}"))
    met = cells
    for d, x, v in ((ctx, "h", "less"), (q, "w", "q")):
        met = met.join(side(d, x, v).hint("merge"), (F.col("lang") == F.col(f"_l{x}")) & (F.col(x) == F.col(f"_{x}")))
    gain = (met.select("lang", "h", "w", "c", F.log1p((F.col("c") - F.col("less")) / (F.col("_vh") * F.col("_vw"))).alias("weight")), keyed("hw"))
    # A word brings its own share and that of the context it is for the next; the last word is none, START always is.
    start = F.col("x") == int(START)
    lg = F.log(F.col("less") / F.col("total"))
    ends = ctx.select("lang", "x", F.when(start, F.col("total")).otherwise(F.lit(0)).cast("bigint").alias("n"), F.when(start, lg).otherwise(-lg).alias("weight"))
    word = q.select("lang", "x", "n", "weight").unionByName(ctx.filter(~start).select("lang", "x", F.lit(0).cast("bigint").alias("n"), lg.alias("weight")))
    word = word.groupBy("lang", "x").agg(F.max("n").alias("n"), F.sum("weight").alias("weight")).filter("n > 0")
    return [(ends, keyed("h")), (word, keyed("w")), gain], whole.select("lang", F.log("unk").alias("unknown"))


def shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key: its leading bits.  ``shards`` is a power of two; sorted keys have sorted shards."""
    bits = shards.bit_length() - 1
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hot_model(model: list, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and weights of the model's keys with n >= ``least``, on the driver: 2 * HOT keys at most, and a START a language."""
    t = _union([d.mapInArrow(f, "key long, n long, weight double") for d, f in model]).filter(F.col("n") >= least).select("key", "weight").toArrow()
    k, w = np.asarray(t.column(0).combine_chunks()).view(np.uint64), np.asarray(t.column(1).combine_chunks())
    o = np.argsort(k)
    return k[o], w[o]


def packed_model(model: list, least: int, shards: int) -> DataFrame:
    """``shard, pack`` of the model's keys with n < ``least``.  A part's rows are made and packed by one Python worker."""

    def packer(make):
        def run(batches):
            held, size = [], 0

            def emit():
                k, w = (np.concatenate([b[i] for b in held]) for i in range(2))
                o = np.argsort(k)
                k, w = k[o], w[o]
                at = shards_of(k, shards)
                cut = np.flatnonzero(np.diff(at, prepend=-1))
                packs = [pack(k[x:y], w[x:y]) for x, y in zip(cut, [*cut[1:].tolist(), len(k)])]
                return pa.RecordBatch.from_arrays([pa.array(at[cut]), pa.array(packs, pa.binary())], ["shard", "pack"])

            for b in make(batches):
                cold = np.asarray(b.column(1)) < least
                held.append((np.asarray(b.column(0)).view(np.uint64)[cold], np.asarray(b.column(2))[cold]))
                size += int(cold.sum())
                if size >= SHARD_KEYS:
                    yield emit()
                    held, size = [], 0
            if size:
                yield emit()
            release()
        return run

    return _union([d.mapInArrow(packer(f), "shard long, pack binary") for d, f in model])


def score(docs: DataFrame, model: list, least: int, shards: int) -> DataFrame:
    """``docs`` (doc_id, text_hash, lang_name, lang as a hash, text) without the text, with n_words and
    ``gain``: the summed weights of its keys in ``model`` (of ``weights``); those with n >= ``least`` are broadcast.  Texts of a block are told
    apart by their place in it."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    inner = f"struct<doc_id:{kind},text_hash:bigint,lang_name:string,lang:bigint>"
    d = docs.select(F.struct("doc_id", "text_hash", "lang_name", "lang").alias("about"), "lang", "text")
    shared = spark.sparkContext.broadcast(hot_model(model, least))

    def ask(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32  # the same in a task run again
        known, worth = shared.value
        for batch in batches:
            for part, data, offs in chunks(batch, most=BLOCK_BYTES):
                block += 1
                h, w, at = _bigrams(data, offs)
                n = np.diff(at)
                m = len(n)
                lang = np.repeat(np.asarray(part.column(1)).view(np.uint64), n)
                has = np.flatnonzero(n)
                ends = np.concatenate([np.full(len(has), START), w[at[has + 1] - 1]])
                k = np.concatenate([keys(lang, None, w), keys(lang, h, w), keys(np.tile(lang[at[has]], 2), ends, None)])
                doc = np.repeat(np.arange(m), n)
                doc = np.concatenate([doc, doc, np.tile(has, 2)])
                place = np.searchsorted(known, k)
                here = place < len(known)
                here[here] = known[place[here]] == k[here]
                gain = np.bincount(doc[here], worth[place[here]], m).astype(float)
                k, doc = k[~here], doc[~here]
                o = np.argsort(k, kind="stable")  # texts stay in order inside a key
                k, doc = k[o], doc[o]
                first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
                many = np.diff(np.append(first, len(k)))
                distinct = k[first]
                shard = shards_of(distinct, shards)
                cut = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(distinct))
                edge = np.append(first, len(k))[cut]
                packs = [pack(distinct[x:y], many[x:y], doc[s:e]) for x, y, s, e in zip(cut[:-1], cut[1:], edge[:-1], edge[1:])]
                c = len(packs)
                yield pa.RecordBatch.from_arrays([pa.array(shard[cut[:-1]]), pa.array(np.full(c, 1, np.int32)), pa.array(packs, pa.binary()), pa.array(np.full(c, block)),
                                                  pa.nulls(c, pa.int32()), pa.nulls(c, pa.int64()), pa.nulls(c, pa.float64()), pa.nulls(c, part.column(0).type)], names)
                # the texts themselves: any shard will do
                yield pa.RecordBatch.from_arrays([pa.array((block + np.arange(m)) % shards), pa.array(np.full(m, 2, np.int32)), pa.nulls(m, pa.binary()), pa.array(np.full(m, block)),
                                                  pa.array(np.arange(m, dtype=np.int32)), pa.array(n), pa.array(gain), part.column(0)], names)

    names = ["shard", "kind", "pack", "block", "place", "n", "hot", "about"]
    back = ["block", "place", "n", "hot", "about", "at", "value"]

    def answer(batches):
        """A shard's part of the model comes before its questions.  Sums by block, for some HELD documents at a time, as bytes; texts pass through."""
        shard, parts, table = None, [], (np.zeros(0, np.uint64), np.zeros(0))
        held: dict = {}
        size = 0

        def emit():
            for block, sums in held.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()),
                                                  pa.nulls(1, about), pa.array([at.astype("<i4").tobytes()], pa.binary()), pa.array([sums[at].tobytes()], pa.binary())], back)
            held.clear()

        for b in batches:
            about = b.column("about").type
            what = np.asarray(b.column("kind"))
            texts = b.filter(pa.array(what == 2))
            if texts.num_rows:
                none = pa.nulls(texts.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*(texts.column(x) for x in back[:5]), none, none], back)
            for i in np.flatnonzero(what < 2):
                own = b.column("shard")[int(i)].as_py()
                if own != shard:
                    shard, parts, table = own, [], (np.zeros(0, np.uint64), np.zeros(0))
                x = unpack(b.column("pack")[int(i)].as_py())
                if what[i] == 0:
                    parts.append(x)
                    continue
                if parts:
                    k, w = (np.concatenate([p[j] for p in parts]) for j in range(2))
                    o = np.argsort(k)
                    table, parts = (k[o], w[o]), []
                key, many, doc = x
                place = np.searchsorted(table[0], key)
                here = place < len(table[0])
                here[here] = table[0][place[here]] == key[here]
                worth = np.zeros(len(key))
                worth[here] = table[1][place[here]]
                got = np.bincount(doc, np.repeat(worth, many))
                block = b.column("block")[int(i)].as_py()
                old = held.get(block, got[:0])
                size += max(len(got) - len(old), 0)
                if len(old) < len(got):
                    old, got = got, old
                old[:len(got)] += got
                held[block] = old
                if size > HELD:
                    yield from emit()
                    size = 0
        if held:
            yield from emit()
        release()

    def add(batches):
        """A block's answers come before its texts."""
        block, sums = None, np.zeros(0)
        for b in batches:
            blocks, is_text = np.asarray(b.column("block")), np.asarray(b.column("place").is_valid().cast(pa.int8())) > 0
            cuts = np.concatenate(([0], np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_text.astype(np.int8)) != 0)) + 1, [len(blocks)]))
            for s, e in zip(cuts[:-1], cuts[1:]):
                if s == e:
                    continue
                if blocks[s] != block:
                    block, sums = blocks[s], np.zeros(0)
                rows = b.slice(s, e - s)
                if is_text[s]:
                    place = np.asarray(rows.column("place"))
                    value = np.where(place < len(sums), sums[np.minimum(place, max(len(sums) - 1, 0))], 0.0) if len(sums) else np.zeros(len(place))
                    yield pa.RecordBatch.from_arrays([rows.column("about"), rows.column("n"), pa.array(value + np.asarray(rows.column("hot")))], ["about", "n", "gain"])
                    continue
                for at, value in zip(rows.column("at"), rows.column("value")):
                    at, value = np.frombuffer(at.as_py(), "<i4"), np.frombuffer(value.as_py())
                    if len(at) and at[-1] >= len(sums):
                        sums = np.concatenate([sums, np.zeros(max(len(sums), int(at[-1]) + 1 - len(sums)))])
                    sums[at] += value

    asked = d.mapInArrow(ask, f"shard long, kind int, pack binary, block long, place int, n long, hot double, about {inner}")
    parts = packed_model(model, least, shards).withColumn("kind", F.lit(0))
    n = parallel(spark)
    met = asked.unionByName(parts, allowMissingColumns=True).repartition(n, "shard").sortWithinPartitions("shard", "kind")
    sums = met.mapInArrow(answer, f"block long, place int, n long, hot double, about {inner}, at binary, value binary")
    sums = sums.repartition(n, "block").sortWithinPartitions("block", F.col("place").asc_nulls_first())
    return sums.mapInArrow(add, f"about {inner}, n long, gain double") \
        .select("about.*", F.col("n").alias("n_words"), "gain")


# --- the model over numbered words -------------------------------------------------------------------
_TURN = [int(x) | 1 for x in np.random.default_rng(1011).integers(1, 1 << 63, 2)]


def fold(x: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """Numbers below 2^bits dealt evenly over those below 2^bits, one to one; ``back`` undoes it."""
    a, b = (pow(t, -1, 1 << 64) for t in _TURN[::-1]) if back else _TURN
    mask = np.uint64((1 << bits) - 1)
    x = (x * np.uint64(a)) & mask
    return ((x ^ (x >> np.uint64(-(-bits // 2)))) * np.uint64(b)) & mask


def vocabulary(counted: DataFrame) -> DataFrame:
    """``lang, key, n, total``: every word of ``counted`` (lang as a hash, text), and START, by its key: how often it is a word and a context."""

    def run(batches):
        for batch in batches:
            for part, data, offs in chunks(batch, most=BLOCK_BYTES):
                w, _, _, at = word_hashes(data, offs, lower=False)
                lang, n = np.asarray(part.column(0)).view(np.uint64), np.diff(at)
                own = np.repeat(lang, n)
                key, first, place, times = np.unique(keys(own, None, w), return_index=True, return_inverse=True, return_counts=True)
                last = np.bincount(place[at[1:][n > 0] - 1], minlength=len(key))
                begun, texts = np.unique(lang[n > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([own[first], begun]).view(np.int64)), pa.array(np.concatenate([key, keys(begun, None, START)]).view(np.int64)),
                    pa.array(np.concatenate([times, np.zeros(len(begun), np.int64)])), pa.array(np.concatenate([times - last, texts]))], ["lang", "key", "n", "total"])

    return counted.select("lang", "text").mapInArrow(run, "lang long, key long, n long, total long") \
        .groupBy("lang", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _numbered(n: np.ndarray, start: np.ndarray, ids: np.ndarray, words: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of n words each: the word before every word, the places where both are known, and the folded bigrams there."""
    h = np.empty_like(ids)
    h[1:] = ids[:-1]
    h[(np.cumsum(n) - n)[n > 0]] = start[n > 0]
    at = np.flatnonzero((h > 0) & (ids > 0))
    return h, at, fold((h[at] * words + ids[at]).astype(np.uint64), bits)


def blocks(docs: DataFrame, known) -> DataFrame:
    """``block, words, pack, about``: some ASK_BYTES of ``docs`` (about, lang, counted, text) a row, texts as the numbers of their words (0: unknown).
    ``known``: broadcast sorted keys and their numbers."""

    def numbers(k):
        keyed, ids = known.value
        place = np.searchsorted(keyed, k)
        here = place < len(keyed)
        here[here] = keyed[place[here]] == k[here]
        out = np.zeros(len(k), np.int64)
        out[here] = ids[place[here]]
        return out

    def run(batches):
        from pyspark import TaskContext
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def emit():
            about = pa.concat_arrays([x[0] for x in held])
            n, start, counted, ids = (np.concatenate([x[i] for x in held]) for i in range(1, 5))
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([pack(n, start, counted, ids)], pa.binary()),
                                               pa.ListArray.from_arrays(pa.array([0, len(about)], pa.int32()), about)], ["block", "words", "pack", "about"])

        for batch in batches:
            for part, data, offs in chunks(batch):
                w, _, _, at = word_hashes(data, offs, lower=False)
                n, lang = np.diff(at), np.asarray(part.column(1)).view(np.uint64)
                k, place = np.unique(keys(np.repeat(lang, n), None, w), return_inverse=True)
                begun, which = np.unique(lang, return_inverse=True)
                held.append((part.column(0), n, numbers(keys(begun, None, START))[which], np.asarray(part.column(2)).astype(np.int64), numbers(k)[place]))
                size += len(data)
                if size >= ASK_BYTES:
                    yield emit()
                    block, held, size = block + 1, [], 0
        if held:
            yield emit()
        release()

    about = dict((f.name, f.dataType) for f in docs.schema)["about"].simpleString()
    return docs.select("about", "lang", "counted", "text").mapInArrow(run, f"block long, words long, pack binary, about array<{about}>")


def asked(written: DataFrame, words: int, bits: int, shards: int) -> DataFrame:
    """``kind, at, shard, pack``.  Kind 0: how often the counted texts hold the bigrams of block ``at`` that are in a shard, in their order.
    Kind 1: numbers and counts of words of range ``at``: 8 x + c, bigrams that x begins and that were counted c times (5: or more); 8 x + 6, bigrams that it ends."""
    shift = np.uint64(bits - (shards.bit_length() - 1))

    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                n, start, counted, ids = unpack(b.column(1)[i].as_py())
                _, at, x = _numbered(n, start, ids, words, bits)
                k, place = np.unique(x, return_inverse=True)
                sure = np.bincount(place, np.repeat(counted, n)[at], len(k)).astype(np.int64)
                shard = (k >> shift).astype(np.int64)
                cut = np.flatnonzero(np.diff(shard, prepend=-1))
                packs = [pack(k[s:e], sure[s:e]) for s, e in zip(cut, [*cut[1:].tolist(), len(k)])]
                yield pa.RecordBatch.from_arrays([pa.array(shard[cut]), pa.array(np.full(len(cut), b.column(0)[i].as_py(), np.int64)), pa.array(packs, pa.binary())],
                                                 ["shard", "block", "pack"])
        release()

    def answer(batches):
        shard, held, sums, size = None, [], [], 0
        out = lambda kind, at, own, packs: pa.RecordBatch.from_arrays([pa.array(np.full(len(packs), kind, np.int32)), pa.array(at, pa.int64()),
                                                                      pa.array(np.full(len(packs), own)), pa.array(packs, pa.binary())], ["kind", "at", "shard", "pack"])

        def settle():
            """A shard's counts; its blocks' answers."""
            nonlocal size
            k, sure = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            k, sure = k[sure > 0], sure[sure > 0]
            k, place = np.unique(k, return_inverse=True)
            c = np.bincount(place, sure, len(k)).astype(np.int64)
            h, w = np.divmod(fold(k, bits, back=True).astype(np.int64), words)
            sums.append(np.concatenate([8 * h + np.minimum(c, 5), 8 * w + 6]))
            size += len(k)
            packs = []
            for _, x, _ in held:
                at = np.searchsorted(k, x)
                here = at < len(k)
                here[here] = k[at[here]] == x[here]
                n = np.zeros(len(x), np.int64)
                n[here] = c[at[here]]
                packs.append(pack(n))
            return out(0, [x[0] for x in held], shard, packs)

        def summed():
            x, n = np.unique(np.concatenate(sums), return_counts=True)
            at = x // (8 * SPAN)
            cut = np.flatnonzero(np.diff(at, prepend=-1))
            return out(1, at[cut], -1, [pack(x[s:e].astype(np.uint64), n[s:e]) for s, e in zip(cut, [*cut[1:].tolist(), len(x)])])

        for b in batches:
            for i in range(b.num_rows):
                own = b.column(0)[i].as_py()
                if own != shard:
                    if held:
                        yield settle()
                        if size > 8 * SHARD_KEYS:
                            yield summed()
                            sums, size = [], 0
                    shard, held = own, []
                held.append((b.column(1)[i].as_py(), *unpack(b.column(2)[i].as_py())))
        if held:
            yield settle()
            yield summed()
        release()

    n = parallel(written.sparkSession)
    questions = written.select("block", "pack").mapInArrow(ask, "shard long, block long, pack binary")
    return questions.repartition(n, "shard").sortWithinPartitions("shard", "block").mapInArrow(answer, "kind int, at long, shard long, pack binary")


def _range_sums(stats: DataFrame) -> list[tuple[int, bytes]]:
    """The sums of kind 1 of ``asked``, a packed array of 8 counts a word for each range."""

    def run(batches):
        at, total = None, np.zeros(0, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                own = b.column(0)[i].as_py()
                if own != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([pack(total)], pa.binary())], ["at", "pack"])
                    at, total = own, np.zeros(8 * SPAN, np.int64)
                x, n = unpack(b.column(1)[i].as_py())
                total[x.astype(np.int64) - 8 * SPAN * at] += n
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([pack(total)], pa.binary())], ["at", "pack"])

    d = stats.select("at", "pack").repartition(parallel(stats.sparkSession), "at").sortWithinPartitions("at")
    return [(r["at"], bytes(r["pack"])) for r in d.mapInArrow(run, "at long, pack binary").collect()]


def _discount_array(n: np.ndarray) -> np.ndarray:
    """``_discounts`` of rows of how many counts are 1, 2, 3 and 4; column k is for a count of k, 3 for more."""
    n = n.astype(float)
    both = n[:, 0] + 2 * n[:, 1]
    y = np.where(both > 0, n[:, 0] / np.maximum(both, 1), 0.5)
    out = np.zeros((len(n), 4))
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[:, k] / np.maximum(n[:, k - 1], 1)
        out[:, k] = np.where(n[:, k - 1] > 0, np.clip(d, 0.05 * k, 0.95 * k), 0.5 * k)
    return out


class _Sent:
    """What a broadcast sends packed: unpickled, it is ``make(*args)``, once in a worker."""

    def __init__(self, make, *args):
        self.made = make, args

    def __reduce__(self):
        return self.made


def _numbers(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their numbers from 1, frequent ones first."""
    key, often = unpack(packed)
    number = np.empty(len(key), np.int32)
    number[np.argsort(-often, kind="stable")] = np.arange(1, len(key) + 1, dtype=np.int32)
    return key, number


def _model(sums: list[tuple[int, bytes]], words: bytes, languages: int, span: int) -> tuple:
    """By number of the word (0: unknown): its language, c(h) g(h), log g(h), q(w) and log q(w) less that of the unknown word; by language the discounts
    and the unknown word's log-probability.  Of ``sums`` (``_range_sums``) and the packed languages and totals, range by range."""
    lang, total = unpack(words)
    lang, size = lang.astype(np.int32), len(lang)
    n, ends = np.zeros((languages, 4)), np.zeros((languages, 7))  # bigrams by count; words by how many bigrams they end (3: or more), words, bigrams

    def ranges():
        for at, p in sums:
            own = slice(at * span, min((at + 1) * span, size))
            yield own, lang[own], unpack(p)[0].reshape(span, 8)[:own.stop - own.start]

    for _, l, c in ranges():
        k = c[:, 6]
        for i in range(4):
            n[:, i] += np.bincount(l, c[:, i + 1], languages)
            ends[:, i] += np.bincount(l, k == i + 1, languages)
        for i, x in ((4, k >= 3), (5, k > 0), (6, k)):
            ends[:, i] += np.bincount(l, x, languages)
    d, e = _discount_array(n), _discount_array(ends[:, :4])
    off = (ends[:, [0, 1, 4]] * e[:, 1:]).sum(axis=1)
    unknown = off / np.maximum(ends[:, 6], 1) / (ends[:, 5] + 1)
    unknown = np.where(unknown > 0, unknown, 1.0)
    less, left, share, worth = np.zeros(size), np.zeros(size), np.ones(size), np.zeros(size)
    for own, l, c in ranges():
        less[own] = c[:, 1] * d[l, 1] + c[:, 2] * d[l, 2] + c[:, 3:6].sum(axis=1) * d[l, 3]
        begun, k = total[own] > 0, c[:, 6]
        left[own][begun] = np.log(less[own][begun] / total[own][begun])
        x, y = k > 0, l[k > 0]
        share[own][x] = (k[x] - e[y, np.minimum(k[x], 3)]) / ends[y, 6] + unknown[y]
        worth[own][x] = np.log(share[own][x] / unknown[y])
    return lang, less, left, share, worth, d, np.log(unknown)


def numbered_score(docs: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``score`` of ``docs`` (as there, and counted: whether a document is) by ``words``, its ``vocabulary``; and the frame of ``lang, unknown``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    t = words.toArrow()
    lang, key, n, total = (np.asarray(t.column(x).combine_chunks()) for x in ("lang", "key", "n", "total"))
    o = np.argsort(key.view(np.uint64))
    packed = pack(key.view(np.uint64)[o], (n + total)[o])
    o = o[np.argsort(-(n + total)[o], kind="stable")]
    names, lang = np.unique(lang, return_inverse=True)
    told = pack(*(np.concatenate([[0], x[o]]).astype(np.int64) for x in (lang, total)))
    size = len(o) + 1
    del t, lang, key, n, total, o
    bits = max((size * size).bit_length(), 32)
    known = sc.broadcast(_Sent(_numbers, packed))
    d = docs.select(F.struct("doc_id", "text_hash", "lang_name", "lang").alias("about"), "lang", "counted", "text")
    written = materialize(blocks(d, known), "kn-blocks", free=True)
    known.destroy()
    shards = 1 << max(4 * parallel(spark), -(-(written.agg(F.sum("words")).first()[0] or 0) // SHARD_KEYS)).bit_length()
    answers = materialize(asked(written, size, bits, shards), "kn-answers", free=True)
    model = _range_sums(answers.filter("kind = 1")), told, max(len(names), 1), SPAN
    shared = sc.broadcast(_Sent(_model, *model))
    unknown = _model(*model)[-1]

    def run(batches):
        """A block's answers come before its texts."""
        lang, less, left, share, worth, off, _ = shared.value
        block, got = None, []
        for b in batches:
            for i in range(b.num_rows):
                if b.column(0)[i].as_py() != block:
                    block, got = b.column(0)[i].as_py(), []
                x = unpack(b.column(2)[i].as_py())
                if b.column(1)[i].as_py() < shards:
                    got += x
                    continue
                n, start, _, ids = x
                h, at, x = _numbered(n, start, ids, size, bits)
                gain = worth[ids] + left[h]
                if len(at):
                    c = np.concatenate(got)[np.unique(x, return_inverse=True)[1]]
                    at, c = at[c > 0], c[c > 0]
                    u, w = h[at], ids[at]
                    gain[at] += np.log1p((c - off[lang[u], np.minimum(c, 3)]) / (less[u] * share[w]))
                gain = np.bincount(np.repeat(np.arange(len(n)), n), gain, len(n))
                yield pa.RecordBatch.from_arrays([b.column(3)[i].values, pa.array(n), pa.array(gain.astype(float))], ["about", "n", "gain"])
        release()

    about = d.schema["about"].dataType.simpleString()
    met = answers.filter("kind = 0").select(F.col("at").alias("block"), "shard", "pack") \
        .unionByName(written.select("block", F.lit(shards).cast("long").alias("shard"), "pack", "about"), allowMissingColumns=True)
    met = met.select("block", "shard", "pack", "about").repartition(parallel(spark), "block").sortWithinPartitions("block", "shard")
    s = met.mapInArrow(run, f"about {about}, n long, gain double").select("about.*", F.col("n").alias("n_words"), "gain")
    rest = pa.table({"lang": pa.array(names, pa.int64()), "unknown": pa.array(unknown[:len(names)], pa.float64())})
    return s, spark.createDataFrame(rest)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = QUANTILE) -> DataFrame:
    """One row a document: doc_id, text_hash, lang, n_words, perplexity, threshold, kept.

    ``labels`` (doc_id, quality): documents labelled 1 are trusted.  One in FOLDS of them (by hash) is
    held out to set the thresholds; all others are counted.
    """
    trusted = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")) \
        .filter("quality = 1").select(F.col("doc_id").alias("_id"))
    name = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    d = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), name.alias("lang_name"), F.xxhash64(name).alias("lang"),
                    F.col(text).alias("text"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    few = trusted.count() <= DEFAULT_BROADCAST_ROWS  # labels grow with the documents
    counted = d.filter(F.col("doc_id").isNotNull() & ~held).select("doc_id", "lang", "text") \
        .join(F.broadcast(trusted) if few else trusted.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    words = materialize(vocabulary(counted), "kn-vocabulary", free=True)
    if words.count() <= FEW:
        told = d.join(F.broadcast(trusted) if few else trusted.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
        told = told.withColumn("counted", (F.col("_id").isNotNull() & ~held).cast("long"))
        s, unknown = numbered_score(told, words)
    else:
        c = materialize(counts(counted), "kn-counts", free=True)
        total, distinct = c.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        shards = 1 << max(4 * parallel(docs.sparkSession), -(-distinct // SHARD_KEYS)).bit_length()
        model, unknown = weights(c)
        s = score(d, model, max(-(-total // HOT), 1), shards)
    s = s.join(trusted.hint("merge"), F.col("doc_id") == F.col("_id"), "left").withColumn("held", F.col("_id").isNotNull() & held).drop("_id")
    s = _by_language(s, materialize(unknown, "kn-unknown"))
    s = s.withColumn("logp", F.when(F.col("n_words") > 0, F.col("gain") + F.col("n_words") * F.col("unknown"))).drop("gain", "unknown")
    s = materialize(s, "kn-scores", free=True)
    mean = s.filter("held and logp is not null").groupBy("lang").agg((F.sum("logp") / F.sum("n_words")).alias("mean"))
    s = _by_language(s, mean)
    s = s.withColumn("drawn", -(F.col("logp") + PRIOR_WORDS * F.col("mean")) / (F.col("n_words") + PRIOR_WORDS))
    limit = s.filter("held").groupBy("lang").agg(F.percentile_approx("drawn", quantile, 100_000).alias("limit"))
    s = _by_language(s, limit)
    return s.select("doc_id", "text_hash", F.col("lang_name").alias("lang"), "n_words", F.exp(-F.col("logp") / F.col("n_words")).alias("perplexity"),
                    F.exp("limit").alias("threshold"), F.exp("drawn").alias("shrunk_perplexity"),
                    F.coalesce(F.col("drawn") <= F.col("limit"), F.lit(True)).alias("kept"))

