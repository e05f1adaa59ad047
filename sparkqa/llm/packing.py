"""Packing documents into sequences by a configuration linear program over the length histogram.

Documents become token ids with an end id; longer ones are cut into full sequences.  The
histogram of piece lengths (at most ``capacity`` rows, whatever the input) is all the planner sees.
Lengths are grouped into size classes; a configuration says how many pieces of each class share a
sequence.  Multiplicative weights solve the fractional program: every round prices the classes by
how little they are covered, a knapsack dynamic program finds the most valuable configuration, and
a step of it is taken.  Amounts are rounded down, realised with exact lengths, and the pieces left
over go where they fit best.  The plan (runs of equal sequences) places piece number r of each
length; Spark numbers the pieces and looks the place up.

Edge cases: a null or empty text is just the end id (one piece); equal rows are packed each; null
ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import chunks, hash_ranges, materialize, salted_row_number, word_hashes

CAPACITY, END_ID, UNIT, WASTE = 4096, 1, 16, 16
CACHE_WORDS = 600_000


class WordTokens:
    """Token ids of whitespace-separated words, remembered by hash for the life of a worker.

    The tokenizer drops white space and never joins words, so a text's ids are its words' ids in
    order.  One comma or full stop after an ASCII letter at the end of a word is a token of its own.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker a core
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.marks = {c: self.ids([chr(c)])[0] for c in (44, 46)}
        self.clear()

    def clear(self) -> None:
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.full.encode_batch_fast(words, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        got: list = [None] * len(words)
        rest = []
        model = self.full.model
        for i, w in enumerate(words):
            if w.isalpha():  # bytes: ASCII letters only, one pre-token that is its own byte form
                got[i] = [t.id for t in model.tokenize(w.decode().lower())]
            else:
                rest.append(i)
        for i, x in zip(rest, self.ids([words[i].decode("utf-8", "replace") for i in rest])):
            got[i] = x
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        place = np.arange(len(hashes)) + len(self.starts) - 1
        self.flat = np.concatenate([self.flat, np.fromiter((t for x in got for t in x), np.uint32, int(sizes.sum()))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        h = np.concatenate([self.hashes, hashes])
        at = np.concatenate([self.at, place])
        o = np.argsort(h, kind="stable")
        self.hashes, self.at = h[o], at[o]

    def lookup(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's texts in order, and the ``len(offs)`` offsets of the texts' ids."""
        _, starts, ends, words = word_hashes(data, offs, lower=True)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        last, prior = data[ends - 1], data[np.maximum(ends - 2, starts)] | 32
        mark = np.where(((last == 44) | (last == 46)) & (ends - starts > 1) & (prior >= 97) & (prior <= 122), last, 0)
        h = hash_ranges(data, starts, ends - (mark > 0))
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        pos = np.searchsorted(self.hashes, distinct)
        known = (pos < len(self.hashes)) & (self.hashes[np.minimum(pos, max(len(self.hashes) - 1, 0))] == distinct) if len(self.hashes) \
            else np.zeros(len(distinct), bool)
        if not known.all():
            miss = np.flatnonzero(~known)
            if len(self.hashes) + len(miss) > CACHE_WORDS:  # all words of the chunk anew, however many they are
                self.clear()
                miss = np.arange(len(distinct))
            raw = data.tobytes()
            cut = (ends - (mark > 0))[first]
            self.learn(distinct[miss], [raw[starts[first[i]]:cut[i]] for i in miss])
            pos = np.searchsorted(self.hashes, distinct)
        slot = self.at[pos][back]
        begin, size = self.starts[slot], self.starts[slot + 1] - self.starts[slot]
        total = size + (mark > 0)
        out_end = np.cumsum(total)
        out = np.empty(int(out_end[-1]), np.uint32)
        src = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        dst = np.repeat(out_end - total - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[dst] = self.flat[src]
        for c, i in self.marks.items():
            own = mark == c
            out[out_end[own] - 1] = i[0]
        text_offs = np.concatenate(([0], out_end))[words]
        return out, text_offs


_kept: dict[str, WordTokens] = {}  # of this worker process, which runs many tasks


def word_tokens(path: str) -> WordTokens:
    """The worker's word store of a tokenizer; one at a time."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = WordTokens(path)
    return _kept[path]


def pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: key, piece, start, length, ids_crc32."""
    kind = dict(df.dtypes)[key]

    def run(batches):
        words = word_tokens(tokenizer)
        for batch in batches:
            for part, data, offs in chunks(batch):
                ids, at = words.lookup(data, offs)
                n = np.diff(at) + 1
                count = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = piece * capacity
                length = np.minimum(capacity, n[row] - begin)
                end_bytes = np.array([END_ID], "<u4").tobytes()
                crc = np.empty(len(row), np.int64)
                ids = ids.astype("<u4", copy=False)
                for k, (r, b, size) in enumerate(zip(row, begin, length)):
                    s = at[r] + b
                    has_end = b + size == n[r]
                    c = zlib.crc32(ids[s:s + size - has_end].tobytes())
                    crc[k] = zlib.crc32(end_bytes, c) if has_end else c
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc)], [key, "piece", "start", "length", "ids_crc32"])

    return df.select(key, F.col(text).alias("text")).mapInArrow(
        run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long")


# --- the plan: bounded by the capacity, not by the data ----------------------------------------------

def price(values: np.ndarray, room: int) -> np.ndarray:
    """The most valuable configuration: unbounded knapsack over classes 1..len(values) (class k takes k
    units of ``room``) by dynamic programming.  Returns the count of each class."""
    k = len(values)
    best, choice = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for c in range(1, room + 1):
        m = min(c, k)
        v = values[:m] + best[c - 1::-1][:m]
        j = int(v.argmax())
        if v[j] > best[c - 1]:
            best[c], choice[c] = v[j], j + 1
        else:
            best[c] = best[c - 1]
    count, c = np.zeros(k, np.int64), room
    while c > 0:
        if choice[c]:
            count[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return count


def solve(demand: np.ndarray, room: int, step: float = 0.1, sharpness: float = 30.0, rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """Fractional amounts of configurations that cover ``demand`` (by class), by multiplicative weights."""
    need = demand > 0
    cover, amount = np.zeros(len(demand)), {}
    for _ in range(rounds):
        if not need.any() or cover[need].min() >= 1:
            break
        low = cover[need].min()
        values = np.where(need & (cover < 1.0 + step), np.exp(-sharpness * (cover - low)) / np.maximum(demand, 1), 0.0)
        config = price(values, room)
        used = config > 0
        if not used.any():
            break
        size = step * (demand[used] / config[used]).min()
        cover[used] += size * config[used] / demand[used]
        key = config.tobytes()
        amount[key] = (config, amount.get(key, (None, 0.0))[1] + size)
    return list(amount.values())


def plan(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT, waste: int = WASTE) -> list[tuple[int, dict[int, int]]]:
    """Runs of equal sequences: (number of sequences, {length: pieces in each})."""
    left = {length: n for length, n in histogram.items() if n > 0}
    runs: list[tuple[int, dict[int, int]]] = []
    if capacity in left:
        runs.append((left.pop(capacity), {capacity: 1}))
    room = capacity // unit
    by_class: dict[int, list[int]] = {}
    for length in sorted(left, reverse=True):
        by_class.setdefault(min(-(-length // unit), room), []).append(length)
    demand = np.zeros(room)
    for k, lengths in by_class.items():
        demand[k - 1] = sum(left[x] for x in lengths)
    remaining = dict(left)
    there = sorted(left)  # lengths with pieces left

    def realise(config: np.ndarray, copies: int) -> None:
        """Copies of a configuration with exact lengths: its classes from the largest, the longest piece
        of each; in place of its last and smallest one, whatever fits the room best, until none fits.
        Copies that would waste more than ``waste`` are left to best fit."""
        classes = [k + 1 for k in np.flatnonzero(config)[::-1] for _ in range(int(config[k]))][:-1]
        while copies:
            pattern: dict[int, int] = {}
            gap = capacity
            for k in classes:
                x = next((x for x in by_class.get(k, ()) if remaining[x] > pattern.get(x, 0)), None)
                if x is None:
                    return
                pattern[x] = pattern.get(x, 0) + 1
                gap -= x
            i = bisect.bisect_right(there, gap)
            while i:
                x = there[i - 1]
                own = min(gap // x, remaining[x] - pattern.get(x, 0))
                if own > 0:
                    pattern[x] = pattern.get(x, 0) + own
                    gap -= own * x
                i = min(i - 1, bisect.bisect_right(there, gap))
            if not pattern or gap > waste:
                return
            fit = min(copies, min(remaining[x] // m for x, m in pattern.items()))
            for x, m in pattern.items():
                remaining[x] -= m * fit
                if not remaining[x]:
                    there.pop(bisect.bisect_left(there, x))
                    by_class[min(-(-x // unit), room)].remove(x)
            runs.append((fit, pattern))
            copies -= fit

    for config, amount in sorted(solve(demand, room), key=lambda x: (-int(np.flatnonzero(x[0])[-1]), -x[1])):
        realise(config, int(amount))
    # What rounding down has left: best fit, longest first, a run of equal sequences at a time.
    groups = {i: [n, p, capacity - sum(x * m for x, m in p.items())] for i, (n, p) in enumerate(runs)}
    free = sorted((g[2], i) for i, g in groups.items() if g[2])
    for x in sorted(remaining, reverse=True):
        n = remaining[x]
        while n:
            j = bisect.bisect_left(free, (x, -1))
            if j == len(free):
                each = capacity // x
                size, m = (n // each, each) if n >= each else (1, n)
                i, pattern = len(groups), {x: m}
                n -= size * m
            else:
                gap, g = free.pop(j)
                had, old, _ = groups[g]
                each = gap // x
                size, m = (min(had, n // each), each) if n >= each else (1, n)
                pattern = dict(old)
                pattern[x] = pattern.get(x, 0) + m
                n -= size * m
                if size < had:
                    groups[g][0] = had - size
                    bisect.insort(free, (gap, g))
                    i = len(groups)
                else:
                    i = g
            gap = capacity - sum(y * c for y, c in pattern.items())
            groups[i] = [size, pattern, gap]
            if gap:
                bisect.insort(free, (gap, i))
    return [(n, p) for n, p, _ in groups.values() if n]


def places(runs: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The plan as a lookup by (length, number within the length): first number, sequence, repeats, offset."""
    used: dict[int, int] = {}
    rows, seq = [], 0
    for n, pattern in runs:
        offset = 0
        for x in sorted(pattern, reverse=True):
            m = pattern[x]
            rows.append((x, used.get(x, 0), seq, m, offset))
            used[x] = used.get(x, 0) + n * m
            offset += x * m
        seq += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"length": a[:, 0], "first": a[:, 1], "seq": a[:, 2], "each": a[:, 3], "offset": a[:, 4]}


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row a piece, with its sequence and offset."""
    p = materialize(pieces(df, tokenizer, key, text, capacity), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    at = places(plan(histogram, capacity))
    numbered = salted_row_number(p, ["length"], [key, "piece", "ids_crc32"], key, "nr")
    shift = 1 << 44
    keys = at["length"] * shift + at["first"]

    def run(batches):
        for b in batches:
            length, nr = np.asarray(b.column("length")), np.asarray(b.column("nr"))
            i = np.searchsorted(keys, length * shift + nr, "right") - 1
            j = nr - at["first"][i]
            seq, off = at["seq"][i] + j // at["each"][i], at["offset"][i] + (j % at["each"][i]) * length
            cols = [b.column(x) for x in range(5)] + [pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:5], "sequence_id", "offset"])

    kind = dict(df.dtypes)[key]
    return numbered.mapInArrow(run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
