import random
from pathlib import Path

import numpy as np
import pytest
from util import empty, frame

from sparkqa.llm import kneser_ney as kn
from sparkqa.operators.util import recorded


def corpus():
    rng = random.Random(3)
    common, rare = "the of and to in is that for".split(), [f"w{i}" for i in range(300)]
    clean = lambda n: " ".join(rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        junk = i % 10 == 0
        text = " ".join(f"JUNK{rng.randrange(10**6)}!!" for _ in range(60)) if junk else clean(rng.randrange(20, 120))
        rows.append((i, text, "en", "s"))
        if i % 2 == 0:
            labels.append((i, 0 if junk else 1))
    rows += [(900, None, "en", "s"), (901, "", None, "s"), (902, "unknown language here", "xx", "s"), (None, clean(50), "en", "s"),
             rows[3], (903, clean(20000), "en", "s")]
    return rows, labels + [(0, 1), (None, 1), (5000, 1)]


def test_junk_goes_and_clean_text_stays(spark):
    rows, labels = corpus()
    got = kn.classify(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    junk = [by[i]["kept"] for i in range(0, 400, 10)]
    clean = [by[i]["kept"] for i in range(400) if i % 10]
    assert sum(junk) <= 2 and sum(clean) >= 0.93 * len(clean)  # 40 held-out documents
    assert by[900]["kept"] and by[901]["kept"] and by[902]["kept"] and by[903]["kept"]
    assert by[900]["perplexity"] is None and by[902]["perplexity"] is None and by[1]["perplexity"] > 1
    assert kn.classify(empty(spark), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert all(r["kept"] for r in kn.classify(frame(spark, rows[:5]), spark.createDataFrame([], "doc_id long, quality int")).collect())


@pytest.mark.parametrize("hot,few", [(kn.HOT, kn.FEW), (40, kn.FEW), (1, 0)])
def test_scores_are_those_of_whole_word_bigrams(spark, monkeypatch, hot, few):
    """Every word counts as itself; a word no trusted text holds is the unknown word."""
    monkeypatch.setattr(kn, "HOT", hot)  # 1: nearly every key is asked for
    monkeypatch.setattr(kn, "FEW", few)  # 0: the tables are joined
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(6000)]
    rows = [(i, " ".join(rng.choice(vocabulary[:50] if rng.random() < 0.5 else vocabulary) for _ in range(60)), "en", "s") for i in range(300)]
    rows += [(900 + i, " ".join(f"zz{rng.randrange(10**9)}" for _ in range(60)), "en", "s") for i in range(5)]
    rows += [(950, "v1 v2 neverseen v3", "de", "s"), (951, "v1 v2 neverseen v3", "en", "s"), rows[0]]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    got = kn.classify(docs, labels).collect()
    assert len(got) == len(rows)
    held = {r[0] for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {kn.FOLDS}) = 0 AS h").collect() if r["h"]}
    c = {}
    for i, t, *_ in rows:
        if i < 300 and i not in held:
            w = t.split()
            for pair in zip(["<s>"] + w, w):
                c[pair] = c.get(pair, 0) + 1

    def discounts(counts):
        n = [sum(x == k for x in counts) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        return [0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05 * k), 0.95 * k) if n[k] else 0.5 * k for k in (1, 2, 3)]

    k, total, left = {}, {}, {}
    for h, w in c:
        k[w] = k.get(w, 0) + 1
    d, e = discounts(c.values()), discounts(k.values())
    for (h, w), n in c.items():
        total[h] = total.get(h, 0) + n
        left[h] = left.get(h, 0) + d[min(n, 3)]
    unk = sum(e[min(x, 3)] for x in k.values()) / sum(k.values()) / (len(k) + 1)
    q = lambda w: unk + ((k[w] - e[min(k[w], 3)]) / sum(k.values()) if w in k else 0)
    assert sum(q(w) for w in k) + unk == pytest.approx(1)

    def p(h, w):
        n = c.get((h, w), 0)
        return (n - d[min(n, 3)]) / total[h] + left[h] / total[h] * q(w) if h in total else q(w)

    text = {r[0]: r[1] for r in rows}
    for r in got:
        w = text[r["doc_id"]].split()
        if r["lang"] == "de":
            assert r["perplexity"] is None and r["kept"]
            continue
        want = np.exp(-sum(np.log(p(*x)) for x in zip(["<s>"] + w, w)) / len(w))
        assert r["perplexity"] == pytest.approx(want, rel=1e-9) and r["n_words"] == len(w)
        if 900 <= r["doc_id"] < 950:
            assert not r["kept"] and r["perplexity"] > 0.9 / unk


@pytest.mark.parametrize("bits", [32, 33, 44, 63])
def test_folded_numbers_come_back(bits):
    x = np.unique(np.random.default_rng(bits).integers(0, 1 << bits, 5000, dtype=np.uint64))
    x = np.concatenate([x, np.arange(50, dtype=np.uint64), np.uint64((1 << bits) - 1) - np.arange(50, dtype=np.uint64)])
    y = kn.fold(x, bits)
    assert (kn.fold(y, bits, back=True) == x).all() and int(y.max()) < 1 << bits
    low = kn.fold(np.arange(1 << 16, dtype=np.uint64), bits) >> np.uint64(bits - 4)  # neighbours are dealt evenly
    assert np.bincount(low.astype(int), minlength=16).min() > 3500


def stored(spark, paths):
    """Bytes of the tables at ``paths`` and of the shuffles that are on disk."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    own = [f for p in paths for f in Path(p.removeprefix("file:")).rglob("*.parquet")]
    return sum(f.stat().st_size for f in own), sum(f.stat().st_size for d in dirs for f in Path(d.toString()).rglob("shuffle_*"))


def test_disk_stays_below_the_text(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"word{rng.randrange(20000)}" for _ in range(500)), "en", "s") for i in range(800)]
    docs, labels = frame(spark, rows), spark.createDataFrame([(i, 1) for i in range(800)], "doc_id long, quality int")
    before = stored(spark, [])[1]
    with recorded() as paths:
        judged = kn.classify(docs, labels)
    tables, shuffles = stored(spark, paths)
    text = sum(len(r[1]) for r in rows)
    assert judged.count() == 800 and 0 < tables < 0.6 * text and shuffles - before < 0.1 * text


def test_both_paths_give_the_same(spark, monkeypatch):
    rows, labels = corpus()
    rows += [(2000 + i, rows[1 + i][1], "de" if i % 2 else None, "s") for i in range(60)]
    labels += [(2000 + i, 1) for i in range(60)]
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    monkeypatch.setattr(kn, "ASK_BYTES", 3000)  # many blocks
    monkeypatch.setattr(kn, "SPAN", 64)
    a = {tuple(r[:4]): r for r in kn.classify(docs, labels).collect()}
    monkeypatch.setattr(kn, "FEW", 0)
    b = {tuple(r[:4]): r for r in kn.classify(docs, labels).collect()}
    assert set(a) == set(b) and {k[2] for k in a} == {"en", "de", "xx", ""}
    for k in a:
        for x, y in zip(a[k][4:], b[k][4:]):
            assert x == pytest.approx(y, rel=1e-9) if x is not None else y is None
