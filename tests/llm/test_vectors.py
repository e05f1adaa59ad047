import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkqa.llm import imi, rabitq


def vectors(n=300, dim=16, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, 60, 3):  # near copies, scaled copies, exact copies
        x[i + 1] = x[i] + rng.standard_normal(dim).astype(np.float32) * 0.05
        x[i + 2] = x[i] * np.float32(1 + i % 2)
    x[200:230] = x[199]
    rows = [(i, [float(v) for v in r], i % 3 if i < 199 else 1, "clash") for i, r in enumerate(x)]
    rows += [(1000, None, 1, "c"), (1001, [0.0] * dim, 1, "c"), (1002, [float("nan")] + [1.0] * (dim - 1), 1, "c"),
             (1003, [None] + [1.0] * (dim - 1), 1, "c"), (1004, [float("inf")] + [1.0] * (dim - 1), 1, "c"), (1020, rows[5][1], None, "c"),
             (None, rows[6][1], 1, "c")]
    random.Random(1).shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, rep string"


@pytest.mark.parametrize("blocks", [(4096, 16384), (3, 50)])
def test_search_equals_brute_force(spark, blocks):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = rabitq.search(df, F.col("vec_id") % 20 == 0, k=20, query_rows=blocks[0], code_rows=blocks[1]).collect()
    ok = {r[0]: np.array(r[1], float) for r in rows if r[0] is not None and r[0] < 300 or r[0] == 1020}
    found = total = 0
    for q in (i for i in ok if i % 20 == 0):
        score = lambda i: sum(float(a) * float(b) for a, b in zip(ok[q], ok[i]))  # noqa: E731, B023
        want = sorted(((-score(i), i) for i in ok if i != q))[:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        found += len({m[1] for m in mine} & {w[1] for w in want})
        total += 20
        assert all(abs(m[2] - score(m[1])) < 1e-9 for m in mine)
    assert found / total >= 0.99


def test_search_small_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1, ""), (1, [0.5, 0.5], 1, ""), (2, None, 1, "")], SCHEMA)
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rabitq.search(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0.5)]
    assert rabitq.search(few.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("block", [2048, 5])
def test_duplicates_equal_brute_force(spark, block):
    rows = vectors()
    got = {r["vec_id"]: r for r in imi.duplicates(spark.createDataFrame(rows, SCHEMA), threshold=0.93, codewords=4, block_rows=block).collect()}
    ok = {r[0]: (np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)), r[2]) for r in rows if r[0] is None or r[0] < 300}
    links = {i: {j for j in ok if j != i and ok[i][1] == ok[j][1] and ok[i][0] @ ok[j][0] >= 0.93} for i in ok}
    assert set(got) == {r[0] for r in rows}
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(map(len, links.values())) > 0
    for i, r in got.items():
        assert r["n_links"] <= len(links.get(i, ()))
        assert r["kept"] == (i is not None and r["component_id"] == i)
    for i in range(200, 230):
        assert got[i]["component_id"] == 199 and got[i]["n_links"] >= 30
    assert imi.duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_and_null_ids_are_vectors_of_their_own(spark):
    rng = np.random.default_rng(8)
    a, b, c = ([float(v) for v in rng.standard_normal(32)] for _ in range(3))
    near = lambda x: [v + 0.01 for v in x]
    rows = [(5, a), (5, b), (9, near(a)), (3, near(b)), (None, c), (None, near(c)), (None, a), (7, [0.0] * 32), (7, None), (8, c[:31] + [9.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    want = sorted([(5, 2, 5), (5, 1, 3), (9, 2, 5), (3, 1, 3), (None, 1, None), (None, 1, None), (None, 2, 5), (7, 0, 7), (7, 0, 7), (8, 0, 8)], key=str)
    for _ in range(2):
        got = imi.duplicates(df.repartition(4), threshold=0.93).collect()
        assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == want
        assert all(r["kept"] == (r["vec_id"] is not None and r["component_id"] == r["vec_id"]) for r in got)


def test_a_tight_cluster_in_the_sample_needs_no_pairs_in_memory():
    x = imi.unit(np.random.default_rng(1).standard_normal((1, 32)) + np.random.default_rng(2).standard_normal((6000, 32)) * 0.05)
    books = [imi.kmeans(x[:, :16], 16), imi.kmeans(x[:, 16:], 16)]
    tracemalloc.start()
    radius = imi.stop_radius(x, np.zeros(len(x)), books, 0.93, 0.999)
    assert tracemalloc.get_traced_memory()[1] < 400e6 and radius > 0
    tracemalloc.stop()
