import re

from test_ngrams import shingles
from util import documents, empty, frame

import corpus_pipeline as cp


def test_stages_and_columns():
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]


def test_each_stage_on_its_own_input(spark, tmp_path):
    rows = documents(9, 40)
    docs = frame(spark, rows)
    spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    q = cp.quality(spark, docs, sf)
    assert q.columns == docs.columns
    assert len({r["doc_id"] for r in q.collect()} & set(range(40))) >= 36 and q.filter("text is null").count() == 1
    x = cp.lines(spark, docs, sf)
    assert x.columns == docs.columns
    kept = [l.strip() for r in x.collect() for l in (r["text"] or "").split("\n") if l.strip()]
    all_lines = {l.strip() for _, t, *_ in rows for l in (t or "").split("\n") if l.strip()}
    twice = {l.strip() for l in rows[7][1].split("\n")}  # the repeated row keeps its lines twice
    assert all(kept.count(l) == 1 or l in twice for l in set(kept)) and set(kept) <= all_lines
    assert all(r["n_chars"] == len(r["text"]) for r in x.collect() if r["text"] is not None)
    n = cp.near_duplicates(spark, docs, sf)
    assert n.columns == docs.columns
    left = [r for r in n.collect() if r["doc_id"] is not None]
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in left}
    for a in sets:
        for b in sets:
            assert not (a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    m = cp.mix(spark, docs, sf)
    assert m.columns == docs.columns
    texts = {(r[0], r[1]) for r in rows}
    assert {(r["doc_id"], r["text"]) for r in m.collect()} <= texts
    for _, stage in cp.STAGES:
        assert stage(spark, empty(spark), sf).count() == 0


def test_one_row_of_each_group_stays(spark, tmp_path):
    text = lambda k, last="end": " ".join(f"{k}{i}" for i in range(80)) + f" {last}"
    groups = {"a": [(5, text("a"))] * 3, "b": [(7, text("b")), (7, text("b", "other"))], "c": [(None, text("c"))] * 2 + [(None, text("c", "other"))],
              "d": [(None, text("d")), (9, text("d", "other")), (8, text("d"))], "e": [(7, text("e"))]}
    docs = frame(spark, [(i, t, "en", k) for k, g in groups.items() for i, t in g] + [(None, None, "en", "n"), (None, "", "en", "n")])
    left = cp.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(r["source"] for r in left) == ["a", "b", "c", "d", "e", "n", "n"]
    assert {r["source"]: r["doc_id"] for r in left} == {"a": 5, "b": 7, "c": None, "d": 8, "e": 7, "n": None}


def test_run_over_the_small_tables(spark, sf_small):
    out = cp.run(spark, sf_small)
    seq = {}
    for r in out.collect():
        seq[r["sequence_id"]] = seq.get(r["sequence_id"], 0) + r["length"]
    assert max(seq.values()) <= 4096 and len(seq) == -(-sum(seq.values()) // 4096)
    assert re.match(".*pieces", cp.pack.__doc__, re.I)
