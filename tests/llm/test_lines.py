import random

import numpy as np
from util import documents, empty, frame

from sparkqa.llm import groups, line_dedup as ld


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def edited(rng, s, n):
    t = list(s)
    for _ in range(n):
        i, o = rng.randrange(len(t) + 1), rng.random()
        if o < 0.33:
            t.insert(i, rng.choice("abç"))
        elif t and o < 0.66:
            t.pop(min(i, len(t) - 1))
        elif t:
            t[min(i, len(t) - 1)] = rng.choice("abü")
    return "".join(t)


def test_banded_distance_equals_dynamic_programming():
    rng = random.Random(5)
    a = ["".join(rng.choice("abé\U0001F600") for _ in range(rng.randrange(30))) for _ in range(1500)] + ["", "x"]
    b = [edited(rng, s, rng.randrange(5)) for s in a]
    for k in (1, 2, 3):
        assert (ld.within([ld.code_points(x) for x in a], [ld.code_points(x) for x in b], k) == [lev(x, y) <= k for x, y in zip(a, b)]).all()


def test_lines_within_the_threshold_always_share_a_signature():
    rng = random.Random(6)
    for _ in range(800):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(8, 30)))
        b = edited(rng, a, rng.randrange(3))
        if min(len(a), len(b)) < 6 or lev(a, b) > 2:
            continue
        data, cut = np.frombuffer((a + b).encode(), np.uint8), len(a.encode())
        s, line, order = ld.signatures(data, np.array([0, cut]), np.array([cut, len(data)]), 2, 4)
        side = lambda k, o: {int(x) for x, y, z in zip(s, line, order) if y == k and z <= o}
        assert side(0, 0) & side(1, 1) or side(1, 0) & side(0, 1)


def brute(rows, edits, min_chars):
    at = {}
    for i, t, *_ in rows:
        for j, x in enumerate((t or "").split("\n")):
            x = x.strip(" \t\r")
            if x:
                at.setdefault(x, []).append(((i is None, i or 0), j, i))
    lines, group = list(at), {x: {x} for x in at}
    for a in lines:
        for b in lines:
            if a < b and min(len(a), len(b)) >= min_chars and lev(a, b) <= edits and group[a] is not group[b]:
                group[a] |= group[b]
                for y in group[b]:
                    group[y] = group[a]
    gone = {}
    for x, places in at.items():
        first = min(p[:2] for y in group[x] for p in at[y])
        for p in places:
            if p[:2] != first:
                gone.setdefault(p[2], set()).add((p[1], first[0][1], first[1]))
    return gone


def test_removed_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(groups.linked, "__defaults__", (4,))  # groups larger than a block
    rng = random.Random(7)
    rows = [r for r in documents(2, 30) if r[0] != 200]
    base = "a line that is shared by many documents of the set"
    for i in range(14):  # variants of one line, some only linked through others
        rows.append((300 + i, edited(rng, base, i % 4) + "\nown line number " + "xyz" * i, "en", "s"))
    rows += [(400, "short\nshort one", "en", "s"), (401, "short\nshort two", "en", "s"), (402, base + "\n" + base, "en", "s")]
    want = brute(rows, 2, 20)
    got = ld.removed(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert {(x["line"], x["doc_id"], x["first_line"]) for x in r["removed"]} == want.get(r["doc_id"], set()), r
        assert r["n_removed"] == len(r["removed"])


def test_empty_table_and_dropping(spark):
    assert ld.removed(empty(spark)).count() == 0
    d = spark.createDataFrame([(1, "a\nb\nc", [0, 2]), (2, None, None), (3, "x\n\ny", None)], "doc_id long, text string, gone array<int>")
    assert [(r["doc_id"], r["text"]) for r in ld.drop_lines(d, "text", "gone").orderBy("doc_id").collect()] == [(1, "b"), (2, None), (3, "x\n\ny")]


def met(spark, rows, *most):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(size, 7)  # signatures span batches
    try:
        return sorted(map(tuple, groups.stars(spark.createDataFrame(rows, "sig long, ref long, own long"), *most).collect()))
    finally:
        spark.conf.unset(size)


def test_unrelated_lines_that_share_a_segment_do_not_meet(spark, monkeypatch):
    seen = []
    whole = groups.stars
    monkeypatch.setattr(ld, "stars", lambda rows: seen.append(whole(rows)) or seen[-1])
    rng = random.Random(8)
    own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé ") for _ in range(38)) + "z" for _ in range(150)]
    lines = ["the same beginning, and " + x for x in own] + ["the same beginning, and " + own[0][:9] + "#" + own[0][10:]]
    docs = spark.createDataFrame([(i, i, x) for i, x in enumerate(lines)], "doc_id long, text_hash long, text string")
    edges = ld.near_edges(docs, 2, 20).collect()
    assert len(edges) == 1
    assert {(r["ref"], r["lead"]) for r in seen[0].collect()} <= {(e["u"], e["v"]) for e in edges} | {(e["v"], e["u"]) for e in edges}


def test_sketches_of_lines_within_the_threshold_differ_in_few_bits():
    rng = random.Random(9)
    for _ in range(2000):
        a = "".join(rng.choice("abé中\U0001F600 ") for _ in range(rng.randrange(1, 30)))
        k = rng.randrange(4)
        b = edited(rng, a, k) or "x"
        data, cut = np.frombuffer((a + b).encode(), np.uint8), len(a.encode())
        x, y = ld.sketches(data, np.array([0, cut]), np.array([cut, len(data)]))
        assert (int(x) ^ int(y)).bit_count() <= 4 * lev(a, b)


def test_rows_of_a_signature_meet_where_sketches_join_them(spark):
    rng = random.Random(10)
    rows, ref = [], 0
    for sig in range(60):  # some signatures have more rows than are paired at once
        for _ in range(rng.choice([1, 2, 5, 30, 90])):
            ref += 1
            own = groups.packed(np.array([rng.random() < 0.4]), 2, np.array([rng.choice([0, 0b11 << 20, 0b1111 << 40]) ^ 1 << rng.randrange(12)]))
            rows += [(sig, ref, int(own[0]))] * rng.randrange(1, 4)

    def brute():
        want = set()
        for sig in range(60):
            own = sorted({(o, r) for s, r, o in rows if s == sig})
            left = list(own)
            while left:
                seed = left.pop(0)
                todo, part = [seed], [seed]
                while todo:
                    t = todo.pop()
                    near = [x for x in left if ((x[0] ^ t[0]) & (1 << 56) - 1).bit_count() <= 2 and (x[0] >> 62 == 0 or t[0] >> 62 == 0)]
                    left = [x for x in left if x not in near]
                    todo += near
                    part += near
                want |= {(r, seed[1]) for o, r in part if r != seed[1]}
        return want

    got = met(spark, rows)
    assert {x[1:] for x in got} == brute() and len(got) == len(set(got))
    assert len({(s, x) for s, _, x in got}) == len({x for _, _, x in got})  # a group for each lead
    first = {s: min((o, r) for z, r, o in rows if z == s) for s in range(60)}
    many = {s for s in range(60) if len({r for z, r, _ in rows if z == s}) > 30}
    wide = {x[1:] for x in met(spark, rows, 20)}  # beyond that the rows of a signature meet its first
    assert wide >= {(r, first[s][1]) for s, r, _ in rows if s in many and r != first[s][1] and first[s][0] >> 62 == 0}
    assert many and {x[0] for x in brute()} <= {x[0] for x in wide}
