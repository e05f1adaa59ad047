"""Language identification against a plain Python version, and its accuracy on held-out documents."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkqa.llm import langid

from util import documents, empty, frame

A = langid.SMOOTH


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def grams(w, n):
    p = w if n == 1 else f"_{w}_"
    return [p[i:i + n] for i in range(len(p) - n + 1)]


def expected(rows):
    """doc_id -> (held, lang, score) of rows (doc_id, text, lang) with distinct ids."""
    fold = lambda d: zlib.crc32(str(d).encode()) % 4
    train = [(t, g) for d, t, g in rows if d is not None and g is not None and fold(d) != 2]
    langs = sorted({g for _, g in train})
    count = defaultdict(Counter)
    for t, g in train:
        for w in words(t):
            count[w][g] += 1
    size = {g: sum(c[g] for c in count.values()) for g in langs}
    freq = lambda c, total, v: math.log((c + A) / (total + A * v))
    by_gram = {n: defaultdict(Counter) for n in langid.LENGTHS}
    for w, c in count.items():
        for n in langid.LENGTHS:
            for x in grams(w, n):
                by_gram[n][x].update(c)
    total = {n: {g: sum(c[g] for c in by_gram[n].values()) for g in langs} for n in langid.LENGTHS}

    def score(w, g):
        if w in count:
            return freq(count[w][g], size[g], len(count))
        for n in langid.LENGTHS:
            known = [x for x in grams(w, n) if x in by_gram[n]]
            if known:
                return sum(freq(by_gram[n][x][g], total[n][g], len(by_gram[n])) for x in known) / len(known)
        return 0.0

    out = {}
    for d, t, _ in rows:
        ws = words(t)
        if not ws:
            out[d] = (d is not None and fold(d) == 2, "und", 0.0)
            continue
        s = [sum(score(w, g) for w in ws) for g in langs]
        best = max(s)
        out[d] = (d is not None and fold(d) == 2, langs[s.index(best)], 1 / sum(math.exp(x - best) for x in s))
    return out


@pytest.mark.parametrize("bound", [langid.BOUND, 64])
def test_predictions_are_those_of_a_plain_version(spark, sf_small, monkeypatch, bound):
    monkeypatch.setattr(langid, "BOUND", bound)  # 64: most keys are joined
    d = spark.read.parquet(f"{sf_small}/documents.parquet").limit(120).select("doc_id", "text", "lang")
    rows = [tuple(r) for r in d.collect()]
    rows += [(10_000, None, "en"), (10_001, "", "en"), (10_002, "12 34 !", "de"), (10_003, "qqqqq zzxxyy", None), (None, "the of and", "en"),
             (10_004, "新闻 報道", None), (10_005, "word " * 5000, "en")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, words string, key int")
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in langid.predict(frame).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    for k, (held, lang, score) in want.items():
        assert got[k][:2] == (held, lang) and got[k][2] == pytest.approx(score, abs=1e-6), (k, got[k], want[k])


def test_held_out_documents_get_their_language(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    j = langid.predict(d).filter("held_out").join(d.select("doc_id", "lang"), "doc_id")
    right, n = j.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 200 and right / n > 0.97


def test_odd_tables(spark):
    assert langid.predict(empty(spark)).count() == 0
    rows = documents()
    got = langid.predict(frame(spark, rows))
    assert got.count() == len(rows) and got.filter("lang_pred is null or score is null or score < 0 or score > 1").count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None), (1, "some words", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.predict(unlabelled).collect()] == [(1, False, "und", 0.0)] * 2
