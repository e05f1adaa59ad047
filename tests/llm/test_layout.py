"""Sharding, mixing and packing."""

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pytest
from util import documents, empty, frame

from sparkqa.llm import mixing, packing, sharding
from sparkqa.llm.queries import tokenizer_path


def test_shards_are_whole_and_even(spark, tmp_path):
    rows = documents(5, 400)
    got = sharding.shard(frame(spark, rows), shards=5, map_path=str(tmp_path / "map")).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) == set(range(5))
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    load = [sum(r["size"] for r in part) for part in by.values()]
    assert max(load) - min(load) <= max(len((t or "").encode()) + 16 for _, t, *_ in rows)
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard(empty(spark), shards=5).count() == 0
    # versions: both are kept, growing moves slots only into the new shard
    old = sharding.load_map(spark, str(tmp_path / "map"))
    assert sharding.load_map(spark, str(tmp_path / "map"), 0).count() == old.count()
    even = [r for r in rows if r[0] != 200]
    old = sharding.rebalance(sharding.first_map(sharding.slot_bytes(sharding.records(frame(spark, even))), 5), 5)
    moved = sharding.changes(old, sharding.grow(old, 5)).collect()
    assert moved and {r["shard"] for r in moved} == {5}


def test_a_saved_map_is_edited_not_made_anew(spark, tmp_path):
    path = str(tmp_path / "map")
    rows = [(i, "x" * (37 * i % 501), "en", "s") for i in range(600)]
    first = sorted(map(tuple, sharding.shard(frame(spark, rows), shards=6, slots=64, map_path=path).collect()))
    assert len(first) == 600
    newest = {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, path).collect()}
    again = sorted(map(tuple, sharding.shard(frame(spark, rows), shards=6, slots=64, map_path=path).collect()))
    assert again == first and {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, path).collect()} == newest
    with pytest.raises(Exception, match="(?i)exists"):
        sharding.save_map(sharding.load_map(spark, path), path, 0)
    # more records in some slots: only what is over moves
    more = rows + [(1000 + i, "y" * 4000, "en", "s") for i in range(40)]
    sizes = sharding.slot_bytes(sharding.records(frame(spark, more), slots=64))
    before = sharding.with_sizes(sharding.load_map(spark, path), sizes, 6)
    after = sharding.rebalance(before, 6)
    load = lambda m: {r["shard"]: r["b"] for r in m.groupBy("shard").agg({"bytes": "sum"}).withColumnRenamed("sum(bytes)", "b").collect()}
    was, now = load(before), load(after)
    share = sum(was.values()) / 6
    moved = sum(r["bytes"] for r in sharding.changes(before, after).collect())
    assert 0 < moved <= sum(max(b - share, 0) for b in was.values()) and max(now.values()) < max(was.values())
    grown = sharding.grow(after, 6)
    edited = sharding.rebalance(grown, 7)
    over = sum(max(b - sum(was.values()) / 7, 0) for b in load(grown).values())
    assert sum(r["bytes"] for r in sharding.changes(grown, edited).collect()) <= over


def test_mix_meets_its_targets(spark):
    rows = documents(6, 200)
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and len(r["positions"]) == -(-r["taken"] // r["size"] if r["size"] else 0)
        assert all(0 <= p <= 1 for p in r["positions"])
    # water filling, by rounds
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, want = 1.5 * sum(size.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * size[s]}
        for s in full or open_:
            want[s] = 2 * size[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(want[s] for s in full)
        open_ -= full
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(frame(spark, rows).repartition(7)).collect()))
    assert mixing.mix(empty(spark)).count() == 0


def test_positions_invert_the_schedules():
    for knots in mixing.SCHEDULES:
        seg = mixing.segments(knots)
        t0, t1, d0, d1, before = seg[-1]
        assert before + (t1 - t0) * (d0 + d1) / 2 == pytest.approx(1)


def test_curriculum_moves_sources_over_time(spark):
    rows = [(i, "a b c", "en", "abc"[i % 3]) for i in range(900)]
    mixed = mixing.mix(frame(spark, rows), share=0.5)
    order = [r["source"] for r in mixing.curriculum(mixed).collect()]
    half = len(order) // 2
    assert order[:half].count("a") > order[half:].count("a") and order[:half].count("c") < order[half:].count("c")


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokenizer_path())
    rows = documents(7, 80) + [(600, "It's Don't, 3.5kg a.b. x, ( y. Ünï, é. <|endoftext|> <|startoftext|>. ΑΣ ΑΣ.", "en", "s"),
                               (601, "tab\tnew\nline nbsp em\u0085nel café, ́x", "en", "s"), (602, "w " * 4095, "en", "s")]
    got = packing.pack(frame(spark, rows), tokenizer_path()).collect()
    want = []
    for i, t, *_ in rows:
        ids = full.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(str(i), k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for part in by.values():
        end = 0
        for o, n in sorted(part):
            assert o == end
            end += n
        assert end <= 4096
    assert len(by) <= -(-sum(r["length"] for r in got) // 4096) + 1
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_texts_with_more_words_than_the_store(monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    full, store = Tokenizer.from_file(tokenizer_path()), packing.WordTokens(tokenizer_path())
    for text in ("old words stay. w1 w2, w3", " ".join(f"w{i}" for i in range(120)) + " old words", "w1 old new.", " ".join(f"x{i}" for i in range(49)) + " w1"):
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, at = store.lookup(raw, np.array([0, len(raw)]))
        assert ids.tolist() == full.encode(text, add_special_tokens=False).ids and at.tolist() == [0, len(ids)]


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_whole_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = {0: rng.integers(1, 4097, 3000), 1: (rng.lognormal(6, 1, 5000).astype(int) + 1).clip(1, 4096), 2: np.full(1000, 1366), 3: np.array([4096] * 5 + [1]),
               4: rng.choice([1400, 1300, 700, 650, 40], 4000), 5: np.zeros(0, int)}[seed]
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    runs, used = packing.plan(histogram), defaultdict(int)
    for n, pattern in runs:
        assert n > 0 and sum(x * m for x, m in pattern.items()) <= 4096
        for x, m in pattern.items():
            used[x] += n * m
    assert used == histogram
    bins = []  # no more sequences than plain best fit, longest first
    for x in sorted(lengths.tolist(), reverse=True):
        i = bisect.bisect_left(bins, x)
        bisect.insort(bins, (bins.pop(i) if i < len(bins) else 4096) - x)
    assert sum(n for n, _ in runs) <= len(bins) * 1.002


def test_pricing_is_an_exact_knapsack():
    rng = np.random.default_rng(0)
    for _ in range(20):
        v = rng.random(6)
        best = [0.0] * 13
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - k - 1] + v[k] for k in range(6) if k < c])
        count = packing.price(v, 12)
        assert (count * np.arange(1, 7)).sum() <= 12 and (count * v).sum() == pytest.approx(best[12])
