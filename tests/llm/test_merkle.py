"""The manifest against a recursive version in plain Python."""

import hashlib
import zlib

import pytest

from sparkqa.llm import merkle

from util import documents, empty, frame


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Levels of digests, from the given one to a single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    return levels


def steps(levels, i):
    out = []
    for x in levels[:-1]:
        first = i - i % 2
        out.append(("".join(x[first:i]), "".join(x[i + 1:first + 2])))
        i //= 2
    return out


def expected(rows):
    """rows: doc_id, text, lang, source, n_chars"""
    by_lang = {}
    for d, text, lang, source, n in rows:
        tampered = n is not None and d is not None and zlib.crc32(str(d).encode()) % 7 == 0
        by_lang.setdefault(lang, []).append((d is not None, d or 0, leaf(d, source, lang, n, text), leaf(d, source, lang, n + 1, text) if tampered else None, d))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = [climb([x[2] for x in sorted(by_lang[k], key=lambda x: x[:3])]) for k in langs]
    top = climb([t[-1][0] for t in trees])
    out = []
    for j, k in enumerate(langs):
        for i, (_, _, own, other, d) in enumerate(sorted(by_lang[k], key=lambda x: x[:3])):
            path = steps(trees[j], i) + steps(top, j)
            x = other or own
            for a, b in path:
                x = sha(a + x + b)
            out.append((d, own, trees[j][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), x, x == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest_is_that_of_a_recursive_version(spark, bits):
    rows = documents()
    d = frame(spark, rows)
    full = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in d.collect()]
    assert got(merkle.proven(d, bits)) == expected(full)


def test_tampering_is_found_and_only_it(spark):
    rows = [(i, f"text {i}", "en", "s", 7) for i in range(300)]
    d = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, steps string, node string")
    for r in merkle.proven(d).collect():
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0)


def test_nulls_single_rows_and_empty_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    assert merkle.proven(empty(spark)).count() == 0
    for rows in ([(None, None, None, None, None)], [(5, "a", "en", None, None)], [(5, "a", "en", "s", 1)] * 5, [(1, "a", x, "s", None) for x in ("b", None, "", "é")]):
        assert got(merkle.proven(spark.createDataFrame(rows, kind))) == expected(rows)
