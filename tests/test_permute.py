"""The keyed bijection, and epochs by it."""

import numpy as np
from pyspark.sql import functions as F

from sparkqa.functions import permute
from sparkqa.operators import training as tr


def place(x, n, keys):
    """Cycle walking, one place at a time."""
    y = int(permuted := permute.permuted(np.array([x]), n, keys)[0])
    while y >= n:
        y = int((permuted := permute.permuted(np.array([y]), n, keys))[0])
    return y


def test_every_row_once(spark):
    keys = permute.round_keys(5, 1)
    for n in [*range(1, 60), 997, 10_007]:
        got = [place(x, n, keys) for x in range(n)] if n < 60 else None
        x = np.arange(n)
        y = permute.permuted(x, n, keys)
        for _ in range(permute.passes(n, keys) - 1):
            y = np.where(y < n, y, permute.permuted(y, n, keys))
        assert sorted(y.tolist()) == list(range(n)) and (got is None or y.tolist() == got)


def test_columns_compute_the_same(spark):
    for n, epoch in ((1, 0), (2, 3), (17, 0), (1000, 1), (4099, 2)):
        keys = permute.round_keys(9, epoch)
        d = spark.range(n).select("id", tr._keyed_position(F.col("id"), n, 9, epoch).alias("p"))
        assert [r["p"] for r in d.orderBy("id").collect()] == [place(x, n, keys) for x in range(n)]


def test_large_numbers_stay_inside(spark):
    n = 10 ** 15 + 7
    keys = permute.round_keys(1, 1)
    a, b = permute.box(n)
    x = [0, 1, 2, 10 ** 9, n // 2, n - 1]
    d = spark.createDataFrame([(v,) for v in x], "x long")
    got = [r[1] for r in d.select("x", permute.position(F.col("x"), F.lit(n), F.lit(a), F.lit(b), keys, 6).alias("p")).orderBy("x").collect()]
    assert got == [place(v, n, keys) for v in x] and len(set(got)) == len(x)


def test_epochs_differ_and_look_shuffled():
    n = 5000
    orders = [[place(x, n, permute.round_keys(0, e)) for x in range(n)] for e in range(2)]
    assert orders[0] != orders[1]
    for o in orders:
        o = np.array(o)
        assert abs(np.corrcoef(np.arange(n), o)[0, 1]) < 0.05 and abs(np.corrcoef(o[1:], o[:-1])[0, 1]) < 0.05


def test_an_epoch_sorts_nothing(spark):
    d = tr.number_rows(spark.range(500).withColumnRenamed("id", "key"), "key")
    out = tr.epoch_shards(d, "key", 4, 16, seed=1, epoch=3, strict=True, number="number")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort [" not in plan
    rows = out.collect()
    assert {r["key"] for r in rows} == set(range(500))
    base = [r for r in rows if r["batch"] * 16 + r["slot"] < 125]
    assert len(base) == 500 and len({r["key"] for r in base}) == 500


def test_mixing_by_bijections(spark):
    d = spark.createDataFrame([(i, "a" if i < 40 else "b") for i in range(60)], "key long, src string")
    d = tr.number_rows(d, "key", "src")
    out = tr.mix_sources(d, "key", "src", {"a": 1.0, "b": 0.5}, 4, seed=0, epoch=0, number="number").collect()
    assert sorted({r.step for r in out}) == list(range(12)) and len(out) == 48
    assert sorted(r.key for r in out if r.source == "a") == list(range(40))
    for src in "ab":
        by_step = [b for _, b in sorted({(r.step, r.batch) for r in out if r.source == src})]
        assert by_step == list(range(len(by_step)))
