import re

import pytest
from util import documents, empty, frame, words

from sparkqa.llm import licenses


def grams(t):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return list(zip(w, w[1:]))


def brute(text, threshold=0.8):
    """The best Dice of any stretch against any notice."""
    g, best = grams(text), 0.0
    for texts in licenses.NOTICES.values():
        for t in texts:
            s = set(grams(t))
            for a in range(len(g)):
                for b in range(a + 1, min(len(g), a + 2 * len(s)) + 1):
                    k = len(set(g[a:b]) & s)
                    best = max(best, 2 * k / (sum(x not in s for x in g[a:b]) + k + len(s)))
    return best if best >= threshold else None


def test_best_stretch_equals_brute_force(spark):
    rng = __import__("random").Random(1)
    rows = [r for r in documents(8, 12) if r[0] != 200]
    for i, (name, texts) in enumerate(licenses.NOTICES.items()):
        for j, t in enumerate(texts):
            w = t.split(" ")
            w[rng.randrange(len(w))] = "other"
            rows.append((500 + 10 * i + j, " ".join(words(rng, 20)) + " " + t.upper() + " " + " ".join(words(rng, 20)), "en", name))
            rows.append((800 + 10 * i + j, " ".join(words(rng, 5)) + "\n" + " ".join(w), "en", "edited"))
    got = licenses.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    text, want = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows if r[0] is not None and 500 <= r[0] < 800}
    for r in got:
        best = brute(text[r["doc_id"]])
        assert (r["dice"] is None) == (best is None) and (best is None or r["dice"] == pytest.approx(best)), r
        if r["doc_id"] in want:
            assert r["license"] == want[r["doc_id"]] and r["dice"] == 1.0
    assert licenses.scan(empty(spark)).count() == 0


def test_clean_text_and_long_runs(spark):
    rows = [(1, "the license of the " * 50_000, "en", "s"), (2, "nothing of the kind under the sun", "en", "s"), (3, None, "en", "s"), (4, "!!! ...", "en", "s")]
    assert [r["license"] for r in licenses.scan(frame(spark, rows)).collect()] == [None] * 4


TEXTS = licenses.licence_texts()


def found(spark, rows):
    return {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_whole_texts_are_known_and_variants_told_apart(spark):
    rng = __import__("random").Random(2)
    rows = []
    for i, (name, t) in enumerate(TEXTS.items()):
        noise = " ".join(words(rng, 30))
        rows.append((i, f"{noise}\nCopyright (c) 2020 Some Body\nAll rights reserved.\n{t}\n{noise}"))
    apache = TEXTS["Apache-2.0"]
    rows += [(100, apache[:apache.index("APPENDIX")]), (101, TEXTS["BSD-2-Clause"].replace("1.", "*").replace("2.", "*")),
             (102, TEXTS["BSD-3-Clause"].replace("copyright holder", "University")), (103, TEXTS["ISC"].replace("and/or", "and").lower()),
             (104, "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                   "which is available at https://www.eclipse.org/legal/epl-2.0/"),
             (105, "Licensed under CC BY-NC-SA 4.0."), (106, "Licensed under CC BY-NC 4.0."), (107, "Licensed under CC BY 3.0."),
             (108, TEXTS["MIT"] + " between " * 40 + TEXTS["Zlib"]), (109, TEXTS["GPL-3.0"][:9000])]
    got = found(spark, rows)
    for i, name in enumerate(TEXTS):
        assert got[i]["license"] == name and got[i]["dice"] > 0.97, (name, got[i])
    assert [got[i]["license"] for i in range(100, 108)] == ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "EPL-2.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-4.0", "CC-BY-3.0"]
    assert [m["license"] for m in got[108]["matches"]] == ["MIT", "Zlib"]
    assert got[109]["license"] is None  # a quarter of a licence


def test_a_text_full_of_notices_is_scanned_in_time(spark):
    import time
    start = time.time()
    r = found(spark, [(1, "Released under the MIT License. something else entirely " * 100_000)])[1]
    assert len(r["matches"]) == 100_000 and {m["license"] for m in r["matches"]} == {"MIT"}
    assert time.time() - start < 60
