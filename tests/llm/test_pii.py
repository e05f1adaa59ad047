import hashlib
import random
import re

import pytest
from util import documents, empty, frame

from sparkqa.llm import pii

# The base patterns as the contract gives them.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    out, n = [], []
    for k, p in BASE.items():
        a = []
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if k == "email" or k == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or k == "card" and 13 <= len(d) <= 19 and luhn(d) \
                    or k == "phone" and 9 <= len(d) <= 15:
                a.append(f"{k}:{m.start()}:{m.end()}")
        out += a
        n.append(len(a))
    return n, ",".join(out)


@pytest.fixture(scope="module")
def fitted(spark):
    return pii.fit(spark)


def test_base_spans_equal_the_patterns(spark, fitted):
    odd = ["é\U0001F600 a.b@c.d, x@y", "a@b.cc_x@d.ee a@b..c @a.b a@b.c-@d.e", "1.2.3.4.5.6.7.8 300.1.1.1 001.0.0.000255 1.2.3",
           "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111x 12 34  5", "+1 (988) 555-2485. +12 +49 30 1234567 x +1+234567890",
           "+1 234 567 890 123 456 7", "9" * 30000, "a" * 30000, "a@" + "b." * 20000, "1." * 20000, "0000000000000 " * 40, "", None, "@.+ -"]
    rows = documents(4, 10) + [(500 + i, t, "en", "s") for i, t in enumerate(odd)]
    got = pii.detect(frame(spark, rows), fitted=fitted).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        n, spans = base(text[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == n, r
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r["spans"].split(","))
        order = [(("email", "ip", "card", "phone").index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert order == sorted(order)


def test_the_method_adds_spans_and_leaves_clean_text(spark, fitted):
    model, thresholds = fitted
    assert set(thresholds) == {"email", "ip", "card", "phone"} and all(0.5 < t <= 1 for t in thresholds.values())
    rows = [(1, "phone me at (555) 123-4567 please", 1), (2, "my email is mail77(at)host.com today", 1), (3, "order no 2024-01-02 and page 12/03/2021", 0),
            (4, "version 12.04.11, the other 10:20:30", 0), (5, "mail joe.77@mail3.example.com now", 0)]
    got = {r["doc_id"]: r for r in pii.detect(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), fitted=fitted).collect()}
    for i, t, added in rows:
        assert (got[i]["spans"] != base(t)[1]) == bool(added), got[i]
    assert got[1]["spans"] == "phone:12:26"
    assert pii.detect(empty(spark), fitted=fitted).count() == 0


ODD = ["bob at example dot com, ann [at] site (dot) org.au x@y z(at)w.de", "2001:db8::1 and fe80::1ff:fe23:4567:890a; 1:2:3:4:5:6:7:8 :: a::b 10:20:30:40",
       "5551234567 0123456 +15551234567 12,345,678 2024-05-06 1234567890123 555-1234567 x1234567", "4111.1111.1111.1111 (555) 123-4567 555 123 4567 01 23 45 67 89"]


def test_candidates_equal_the_loose_patterns(spark):
    """Every leftmost match of every generator, with its code point offsets."""
    rows = documents(6, 10) + [(500 + i, t, "en", "s") for i, t in enumerate(ODD + ["\U0001F600 " + " é ".join(ODD)])]
    cands = pii.candidates(frame(spark, rows))
    got = {}
    for r in pii.spans(cands).filter("not base").join(cands.select("uid", "doc_id"), "uid").collect():
        got.setdefault(r["doc_id"], []).append((r["kind"], r["start"], r["end"], r["match"]))
    for d, t, *_ in rows:
        if d is None or d == 7:  # 7 is there twice
            continue
        want = [(k, m.start(), m.end(), m[0]) for k, p in pii.LOOSE.items() for m in re.finditer(p, t or "")]
        assert sorted(got.get(d, [])) == sorted(want), d


def test_planted_data_of_every_kind_is_caught(spark, fitted):
    rng = random.Random(11)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def card():
        while True:
            x = d(16)
            if luhn(x):
                return x
    made = {
        "email": lambda: rng.choice([f"joe{d(2)}(at)mail.com", f"ann.lee [at] corp{d(1)} [dot] org", f"my email is bob{d(2)} at example dot com", f"al{d(3)}@site{d(1)}.net"]),
        "ip": lambda: rng.choice([":".join(h(4) for _ in range(8)), f"2001:{h(3)}::{h(1)}", f"fe80::{h(4)}:{h(3)}", f"10.{rng.randrange(256)}.3.{rng.randrange(256)}"]),
        "card": lambda: (lambda c: rng.choice([c, " ".join(c[i:i + 4] for i in range(0, 16, 4)), ".".join(c[i:i + 4] for i in range(0, 16, 4))]))(card()),
        "phone": lambda: rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"+1 {d(3)} {d(3)} {d(4)}", f"phone {d(10)}", f"call me on {d(7)}", f"{d(3)}-{d(3)}-{d(4)}"])}
    filler = lambda: " ".join(rng.choice("the of and to in that was hotel excellent recall".split()) for _ in range(rng.randrange(6, 15)))
    rows, want = [], {}
    for i in range(400):
        k = list(made)[i % 4]
        x = made[k]()
        lead = filler() + " "
        rows.append((i, lead + x + " " + filler()))
        part = re.search(r"(?:phone |call me on |my email is )?(.*)", x)
        want[i] = (k, len(lead) + part.start(1), len(lead) + part.end(1))
    clean = [f"{filler()} {x} {filler()}" for x in ("order no 1234567", "in 2024 and 1999", "excellent 1234567", "hotel 5551234", "page 12 of 30", "version 1.2.3", "10:20:30 it was",
                                                    "stay at home dot that", "it cost 12,345,678", "a total of 12345678", "chapter 3::4", "ref 2024-01-02")] * 5
    rows += [(1000 + i, t) for i, t in enumerate(clean)]
    got = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string"), fitted=fitted).collect()}
    caught = {k: 0 for k in made}
    for i, (k, a, b) in want.items():
        caught[k] += any(int(x) <= a and int(y) >= b for _, x, y in (z.split(":") for z in got[i].split(",") if z))
    assert all(n >= 90 for n in caught.values()), caught
    assert sum(bool(got[1000 + i]) for i in range(len(clean))) == 0, [(t, got[1000 + i]) for i, t in enumerate(clean) if got[1000 + i]][:5]
