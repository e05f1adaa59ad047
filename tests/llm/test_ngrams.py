import random
import re

import numpy as np
import pytest
from util import documents, empty, frame, words

from sparkqa.llm import groups, ngram_join


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(rows, n, percent):
    s = [(i, shingles(t, n)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in s:
        for j, b in s:
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in s}


@pytest.mark.parametrize("n,percent,few", [(3, 90, ngram_join.FEW), (5, 80, ngram_join.FEW), (5, 80, 0)])  # 0: texts are joined
def test_components_equal_brute_force(spark, monkeypatch, n, percent, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(groups.linked, "__defaults__", (3,))
    rng = random.Random(n)
    rows = documents(3, 40)
    base = words(rng, 120)
    for i in range(25):  # a group whose members link only through others
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
        rows.append((300 + i, " ".join(w) if i % 2 else " ".join(w).upper(), "en", "s"))
    for i in range(30):  # short texts around the bound, where blocks are few and often empty
        w = base[: 8 + i % 9]
        if i % 3:
            w = w + [f"t{i % 5}"]
        rows.append((400 + i, " ".join(w), "en", "s"))
    want = brute(rows, n, percent)
    got = ngram_join.join(frame(spark, rows), words=n, percent=percent).collect()
    assert len(got) == len(rows)
    size = {i: len(shingles(t, n)) for i, t, *_ in rows}
    for r in got:
        assert r["n_shingles"] == size[r["doc_id"]]
        assert r["component_id"] == want.get(r["doc_id"])


def test_empty_table(spark):
    assert ngram_join.join(empty(spark)).count() == 0


def prints(sets, percent):
    g = [np.sort(np.array(list(s), np.uint64)) for s in sets]
    offs = np.concatenate(([0], np.cumsum([len(x) for x in g])))
    flat = np.concatenate(g)
    sig, own, most = ngram_join.fingerprints(flat, offs, percent)
    sketch = ngram_join.sketches(flat, offs)
    return [{int(x): (int(m), int(sketch[i])) for x, m in zip(sig[own == i], most[own == i])} for i in range(len(sets))]


@pytest.mark.parametrize("percent", [80, 90])
def test_texts_that_just_link_share_a_fingerprint_and_their_sketches_fit(percent):
    rng = random.Random(percent)
    for n in [*range(3, 60), *range(60, 700, 9)]:
        union = {rng.randrange(1 << 64) for _ in range(n)}
        apart = n * (100 - percent) // 100
        for share in (0, apart // 2):  # one holds the other, or both have their own
            own = sorted(union)
            rng.shuffle(own)
            a, b = prints([union - set(own[:share]), union - set(own[share:apart])], percent)
            assert all(a[x][0] == b[x][0] for x in a.keys() & b.keys())
            assert apart == 0 or any((a[x][1] ^ b[x][1]).bit_count() <= a[x][0] for x in a.keys() & b.keys())


def test_unrelated_texts_that_share_few_ngrams_do_not_meet():
    rng = random.Random(4)
    common = [rng.randrange(1 << 64) for _ in range(5)]
    own = prints([{*common, *(rng.randrange(1 << 64) for _ in range(300))} for _ in range(300)], 80)
    assert len(set().union(*own)) == sum(map(len, own))
