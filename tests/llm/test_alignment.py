"""Alignment against whole texts given to both tokenizers, one at a time."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from sparkqa.llm import alignment

from util import documents, empty, frame

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(*PATHS)


def tokens(tok, text):
    """(A ids and ends, B ids and ends) of a text, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = tok.a.encode(" " + text, add_special_tokens=False).ids
    b = tok.b.encode(text)
    if b"".join(tok.bytes_a[x] for x in a) != raw or b"".join(tok.bytes_b[x] for x in b) != raw:
        return None
    return [(ids, ends(ids, of)) for ids, of in ((a, tok.bytes_a), (b, tok.bytes_b))]


def ends(ids, of):
    out, n = [], 0
    for x in ids:
        n += len(of[x])
        out.append(n)
    return out


def expected(tok, rows):
    per, count = [], Counter()
    for d, text in rows:
        t = tokens(tok, text)
        if t is None:
            per.append((d, 0, 0, [], ""))
            continue
        (a, ea), (b, eb) = t
        at_a, at_b = dict(zip(ea, range(len(ea)))), dict(zip(eb, range(len(eb))))
        both = sorted(at_a.keys() & at_b.keys())
        links, groups = [(a[at_a[e]], b[at_b[e]]) for e in both], []
        x = y = 0
        for e in both:
            groups.append(",".join(map(str, a[x:at_a[e] + 1])) + "|" + ",".join(map(str, b[y:at_b[e] + 1])))
            x, y = at_a[e] + 1, at_b[e] + 1
        count.update(links)
        per.append((d, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), c in count.items():
        best[b] = max(best[b], c)
    return sorted(((d, na, nb, len(ls), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), h) for d, na, nb, ls, h in per), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


ODD = ["<|endoftext|> and <s> </s> <unk>", "a ▁ b", "tab\there\r\nline \n next\n\n  two", " lead", "trail  ", " ", "\n", "é ﬁ ▁", " nbsp 　wide",
       "新闻，報道。", "\U0001F600\U0001F468‍\U0001F469", "don't, it's. we'll...x,.y", "0x1F 12,345.67", "\x00nul\x1c \x85", "," * 50, "a" * 3000, "x\n,y .z", "ﷺ ﻿ bom"]


@pytest.mark.parametrize("fan", [64, 2])  # 2: several rounds of merging
def test_counts_are_those_of_whole_texts(spark, tok, monkeypatch, fan):
    monkeypatch.setattr(alignment, "FAN", fan)
    rows = [(r[0], r[1]) for r in documents(n=30)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, keys string, block int").repartition(7)
    assert got(alignment.align(d, *PATHS)) == expected(tok, rows)


def test_segments_are_cut_where_no_token_crosses(tok):
    rng = random.Random(4)
    odd = [chr(c) for c in (9, 10, 11, 12, 13, 28, 32, 32, 32, 44, 46, 39, 0x85, 0xA0, 0x180E, 0x2003, 0x200B, 0x301, 0x3000, 0xFEFF)]
    for _ in range(400):
        text = " " + "".join(rng.choice(odd) if rng.random() < 0.5 else rng.choice(["ab", "C", "é", "7", "字", "s", chr(rng.randrange(0xE000, 0x10FFFF))]) for _ in range(30))
        cut = alignment.segments(text)
        assert "".join(cut) == text
        assert [x for s in tok.ids_a(cut) for x in s] == tok.ids_a([text])[0]
        assert [x for s in tok.ids_b(cut) for x in s] == tok.b.encode(text[1:])


def test_a_full_memory_forgets_and_goes_on(tok, monkeypatch):
    texts = [r[1] for r in documents(n=20)] + ODD
    free = alignment.Segments(tok)
    want = free.read(texts)
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 40)
    own = alignment.Segments(tok)
    for _ in range(2):
        have = own.read(texts)
        assert (have[0] == want[0]).all() and have[1] == want[1] and (have[2] == want[2]).all() and (have[3] == want[3]).all()


def test_pairs_are_bounded_by_the_vocabularies(tok):
    most = alignment.most_pairs(tok)
    own = alignment.Segments(tok)
    _, _, links, _ = own.read([r[1] for r in documents()])
    for x in set(links.tolist()):
        a, b = tok.bytes_a[x & 0xFFFF], tok.bytes_b[x >> 16]
        assert a.endswith(b) or b.endswith(a)
    assert len(set(links.tolist())) <= most < 1_000_000


def test_runs_come_back_and_merge():
    import numpy as np
    x, y = np.array([3, 5 << 16, (5 << 16) + 1]), np.array([1, 2, 2])
    assert [c.tolist() for c in alignment.unpack(alignment.pack(x, y))] == [x.tolist(), y.tolist()]
    u = np.array([0, 7, 1 << 63, (1 << 64) - 1], np.uint64)
    back = alignment.unpack(alignment.pack(u, np.array([0.5, -1.25]), u[:0]))
    assert back[0].tolist() == u.tolist() and back[1].tolist() == [0.5, -1.25] and not len(back[2])
    run = alignment.pack(np.diff(x, prepend=0), y)
    pairs, counts, best = alignment.merge([run, run, alignment.pack(x[:0], y[:0])])
    assert pairs.tolist() == x.tolist() and counts.tolist() == [2, 4, 4] and best.tolist() == [True, True, True]


def test_empty_table(spark):
    assert alignment.align(empty(spark), *PATHS).count() == 0
    rows = documents()
    assert alignment.align(frame(spark, rows), *PATHS).count() == len(rows)
