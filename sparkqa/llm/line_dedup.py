"""Line dedup by a segment-partition edit join.

A line of length l is split into edits + 1 even segments.  Two lines within ``edits`` edits share one
segment of the shorter, at a place in the longer that is nearly the same; so every line's segments
are an index by (length, segment number, content), and it is probed with the few substrings of a line
whose place fits (the multi-match-aware window).  Short segments are shared by chance, so lines meet only if their sketches
(the parities of their pairs of neighbouring characters, in 56 counters) differ in no more bits than ``edits`` edits can change.
Lines that meet are verified by a banded
bit-parallel edit distance: for each number of edits a word of 2 * edits + 1 bits says which
diagonals of the band are alive.

First every line is verified against the first line that it meets by a signature, which is linear in the number
of meetings; only lines of signatures that still hold several components go through all the others
of their group, in blocks.  So a signature shared by thousands of lines never yields its pairs.  All lines linked,
directly or through others, are one class; the class keeps its first line (by id, then line number).

Edge cases: a null or empty text has no lines; blank lines are never removed; lines compare trimmed of
space, tab and carriage return; lines under ``min_chars`` code points are duplicates only when equal;
rows that share an id and a text are one document (all keep the same lines); a null id sorts last;
an empty table gives an empty result; extra columns are passed over.  Lines are known by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import chunks, hash_between, hash_ranges, materialize, mix64, running
from sparkqa.llm.components import components
from sparkqa.llm.groups import SKETCH, packed, settle, stars

EDITS, MIN_CHARS, BAG, FEW = 2, 20, 32, 8_000_000
_ONE = np.int64(1) << np.random.default_rng(78).integers(0, SKETCH, 1 << 16)
_K = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def line_ranges(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number, start and end byte of every trimmed line that is not blank."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e, e
    breaks = np.flatnonzero(data == 10)
    inner = offs[1:-1]
    cuts = np.unique(np.concatenate([breaks, [n]]))
    starts = np.unique(np.concatenate([[0], breaks + 1, inner]))
    starts = starts[starts < n]
    # a line ends at the next break or text border
    borders = np.unique(np.concatenate([cuts, inner]))
    ends = borders[np.searchsorted(borders, starts)]
    own = np.searchsorted(borders, starts)
    # an inner border at the start itself opens the line; it does not end it
    again = (ends == starts) & (data[starts] != 10)
    ends = np.where(again, borders[np.minimum(own + 1, len(borders) - 1)], ends)
    text = np.searchsorted(offs, starts, "right") - 1
    first = np.searchsorted(starts, offs[text])
    number = np.arange(len(starts)) - first
    ink = np.flatnonzero(~((data == 32) | (data == 9) | (data == 13) | (data == 10)))
    a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
    full = b > a
    return text[full], number[full], ink[a[full]], ink[b[full] - 1] + 1


def signatures(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, edits: int, min_chars: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature, line and order (0 index, 1 probe) of every segment and every fitting substring."""
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
    chars = lead[ends] - lead[starts]
    byte_of = np.concatenate((np.flatnonzero((data & 0xC0) != 0x80), [len(data)]))  # byte where a code point starts
    lines = np.flatnonzero(chars >= min_chars)
    run = running(data, lower=False)
    k = edits + 1
    sig, line, order = [], [], []
    for d in range(edits + 1):  # lengths of the indexed line: the own and up to ``edits`` less
        own = lines[chars[lines] - d >= min_chars]
        size = chars[own] - d
        base, extra = size // k, size % k
        for i in range(k):
            seg = base + (i >= k - extra)
            at = i * base + np.maximum(0, i - (k - extra))
            low = np.maximum(np.maximum(at - i, at + d - (edits - i)), 0)
            high = np.minimum(np.minimum(at + i, at + d + (edits - i)), chars[own] - seg)
            for shift in range(2 * edits + 1):
                pos = low + shift
                fit = pos <= high
                if not fit.any():
                    break
                o, p, s = own[fit], pos[fit], seg[fit]
                b = lead[starts[o]]
                h = hash_between(run, byte_of[b + p], byte_of[b + p + s])
                sig.append(mix64(h + size[fit].astype(np.uint64) * _K[0] + _K[1 + i]))
                line.append(o)
                order.append(np.where((d == 0) & (p == at[fit]), 0, 1))
    if not sig:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e
    return np.concatenate(sig), np.concatenate(line), np.concatenate(order)


def sketches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every line, whether the pairs of neighbouring characters that fall to each of ``SKETCH`` counters are odd in number.
    One edit takes and adds two pairs at most, so it changes four bits at most."""
    if not len(data):
        return np.zeros(len(starts), np.int64)
    x, at = data.astype(np.uint16), None
    if data.max() > 127:  # a character is known by its first three bytes
        more = (data & 0xC0) == 0x80
        first = np.flatnonzero(~more)
        at = np.concatenate(([0], np.cumsum(~more)))
        second = np.where(more[1:], x[1:], np.uint16(0))
        third = np.where(more[1:-1] & more[2:], x[2:], np.uint16(0))
        x[:-1] += second * np.uint16(1031)
        x[:-2] += third * np.uint16(24029)
        x = x[first]
    run = np.zeros(max(len(x), 1), np.int64)
    np.bitwise_xor.accumulate(_ONE[x[:-1] * np.uint16(40503) + x[1:]], out=run[1:])
    a, z = (starts, ends) if at is None else (at[starts], at[ends])
    return run[np.maximum(z - 1, a)] ^ run[a]


def code_points(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def within(a: list[np.ndarray], b: list[np.ndarray], edits: int) -> np.ndarray:
    """Whether each pair of texts (code points) is within ``edits`` edits: banded, bit-parallel, all
    pairs at once.

    Bit j of a word stands for the diagonal j - edits.  Reading the next character of the longer
    string, a diagonal stays alive on a match, or with one more edit by replacing, inserting
    (one diagonal down) or deleting (one diagonal up).
    """
    n = len(a)
    out = np.zeros(n, bool)
    la, lb = np.fromiter(map(len, a), np.int64, n), np.fromiter(map(len, b), np.int64, n)
    swap = la > lb
    short, long = np.minimum(la, lb), np.maximum(la, lb)
    live = np.flatnonzero(long - short <= edits)
    live = live[np.argsort(long[live], kind="stable")]
    i = 0
    while i < len(live):
        room = max(1, (1 << 21) // (int(long[live[i]]) + 1))
        part = live[i:i + room]
        while len(part) > 1 and len(part) * int(long[part[-1]]) > 1 << 22:
            part = part[:len(part) // 2]
        i += len(part)
        m = int(long[part[-1]])
        p = np.zeros((m + 2 * edits + 1, len(part)), np.uint32)  # shorter, shifted by ``edits``
        t = np.full((m, len(part)), 0xFFFFFFFF, np.uint32)
        for c, x in enumerate(part):
            s, w = (b[x], a[x]) if swap[x] else (a[x], b[x])
            p[:edits, c] = 0xFFFFFFFE
            p[edits + len(s):, c] = 0xFFFFFFFE
            p[edits:edits + len(s), c] = s
            t[:len(w), c] = w
        band = 2 * edits + 1
        mask, mid = np.uint32((1 << band) - 1), edits
        state = [np.full(len(part), ((1 << (e + 1)) - 1) << mid, np.uint32) & mask for e in range(edits + 1)]
        # with e edits the first e characters of the shorter may be deleted before any is read
        goal = np.uint32(1) << (mid + short[part] - long[part]).astype(np.uint32)
        size, done = long[part], long[part] == 0
        for r in range(m):
            match = np.zeros(len(part), np.uint32)
            for j in range(band):
                match |= (p[r + j] == t[r]).astype(np.uint32) << np.uint32(j)
            new = [state[0] & match]
            for e in range(1, edits + 1):
                x = (state[e] & match) | state[e - 1] | (state[e - 1] >> np.uint32(1)) | (new[e - 1] << np.uint32(1))
                new.append(x & mask)
            state = new
            end = size == r + 1
            if end.any():
                done |= end & ((state[edits] & goal) > 0)
        out[part] = done
    return out


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line (number), h (hash of the trimmed line)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                text, number, s, e = line_ranges(data, offs)
                h = hash_ranges(data, s, e, lower=False) if len(s) else np.zeros(0, np.uint64)
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(number.astype(np.int32)),
                                                  pa.array(h.view(np.int64))], ["doc_id", "text_hash", "line", "h"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, line int, h long")


def near_edges(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """Edges u, v between hashes of lines: they join all lines linked by at most ``edits`` edits."""

    def distinct(part, data, offs):
        _, _, s, e = line_ranges(data, offs)
        h, first = np.unique(hash_ranges(data, s, e, lower=False) if len(s) else np.zeros(0, np.uint64), return_index=True)
        return h, s[first], e[first]

    def meet(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                h, s, e = distinct(part, data, offs)
                sig, line, order = signatures(data, s, e, edits, min_chars)
                own = packed(order, 4 * edits, sketches(data, s, e)[line])
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(h[line].view(np.int64)), pa.array(own)], ["sig", "ref", "own"])

    met = materialize(stars(docs.mapInArrow(meet, "sig long, ref long, own long")), "ld-met", free=True)
    wanted = materialize(met.select(F.col("ref").alias("node")).union(met.select("lead")).distinct(), "ld-wanted")
    few = wanted.count() <= FEW  # eight bytes a line that meets another: the others' texts stay where they are
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(np.asarray(wanted.toArrow().column(0).combine_chunks()))) if few else None

    def lines(batches):
        for batch in batches:
            for part, data, offs in chunks(batch):
                h, s, e = distinct(part, data, offs)
                h = h.view(np.int64)
                if shared is not None:
                    at = np.minimum(np.searchsorted(shared.value, h), max(len(shared.value) - 1, 0))
                    take = np.flatnonzero(shared.value[at] == h) if len(shared.value) else np.zeros(0, np.int64)
                    h, s, e = h[take], s[take], e[take]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([data[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(s, e)], pa.string())], ["node", "data"])

    texts = docs.mapInArrow(lines, "node long, data string")
    if not few:
        texts = texts.join(wanted, "node", "left_semi")
    texts = materialize(texts.groupBy("node").agg(F.min("data").alias("data")), "ld-texts")

    def link(t: pa.Table, a: np.ndarray, b: np.ndarray | None):
        if _last[0] is not t:
            line = [code_points(x) for x in t["data"].to_pylist()]
            bags = np.array([np.bincount(x % BAG, minlength=BAG) for x in line], np.int32).reshape(-1, BAG)
            _last[:] = [t, line, np.fromiter(map(len, line), np.int64, len(line)), bags]
        _, _, size, bags = _last
        may = np.abs(size[a][:, None] - size[a if b is None else b][None, :]) <= edits
        if b is None:
            may &= np.arange(len(a))[:, None] < np.arange(len(a))[None, :]
        p, q = np.nonzero(may)
        p, q = a[p], (a if b is None else b)[q]
        # an edit changes the counts of at most two characters by one
        like = [np.abs(bags[p[i:i + (1 << 15)]] - bags[q[i:i + (1 << 15)]]).sum(1) <= 2 * edits for i in range(0, len(p), 1 << 15)]
        like = np.concatenate(like) if like else np.zeros(0, bool)
        return p[like], q[like]

    def sure(t: pa.Table, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        line = _last[1]  # of the same table
        return np.concatenate([np.zeros(0, bool), *(within([line[j] for j in p[i:i + (1 << 15)]], [line[j] for j in q[i:i + (1 << 15)]], edits)
                                                     for i in range(0, len(p), 1 << 15))])

    def slices(line):
        n = F.char_length(line)
        return F.array_distinct(F.array(F.floor(n / 16), F.floor((n + edits) / 16)))

    return settle(met, texts, lambda x, y: within([code_points(i) for i in x], [code_points(i) for i in y], edits), link, slices, sure, 1024)


_last: list = [None] * 4  # a task asks for the lines of one table group by group


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row a line: doc_id, text_hash, line, first_doc, first_line (where its class occurs first)."""
    docs = df.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    lines = materialize(line_table(docs), "ld-lines")
    comp = materialize(components(near_edges(docs, edits, min_chars)), "ld-classes")
    # the first line of every hash, then of every class: two partial aggregates, no hot group in a task
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")
    firsts = lines.groupBy("h").agg(F.min(at).alias("first")).join(comp, F.col("h") == F.col("node"), "left") \
        .select("h", "first", F.coalesce("component", "h").alias("class"))
    firsts = materialize(firsts, "ld-hashes")
    best = firsts.groupBy("class").agg(F.min("first").alias("first"))
    answer = materialize(firsts.select("h", "class").join(best, "class").select("h", "first"), "ld-first-lines")
    return lines.join(answer, "h").select("doc_id", "text_hash", "line", F.col("first.doc_id").alias("first_doc"),
                                          F.col("first.text_hash").alias("first_hash"), F.col("first.line").alias("first_line"))


def removed(df: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row a document: doc_id, text_hash, n_lines, n_removed, ``removed`` (line, and where its class
    occurs first, in line order)."""
    c = classes(df, key, text, edits, min_chars)
    kept = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_hash")) & (F.col("line") == F.col("first_line"))
    item = F.struct("line", F.col("first_doc").alias("doc_id"), "first_line")
    per = c.dropDuplicates(["doc_id", "text_hash", "line"]).groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(~kept).alias("n_removed"),
        F.array_sort(F.collect_list(F.when(~kept, item))).alias("removed"))
    d = df.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    p = per.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "n_lines", "n_removed", "removed")
    return d.join(p, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left").select(
        "doc_id", "text_hash", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<struct<line:int,doc_id:bigint,first_line:int>>")).alias("removed"))


def drop_lines(df: DataFrame, text: str, gone: str) -> DataFrame:
    """``df`` without column ``gone`` (numbers of the lines to drop, or null) and without those lines."""
    out = df.drop(gone)
    names = out.columns

    def run(batches):
        for b in batches:
            drop = b.column(b.schema.get_field_index(gone)).to_pylist()
            col = b.column(b.schema.get_field_index(text))
            if any(drop):
                col = pa.array([x.as_py() if not d else "\n".join(y for i, y in enumerate(x.as_py().split("\n")) if i not in d)
                                for x, d in zip(col, (set(d or ()) for d in drop))], col.type)
            yield pa.RecordBatch.from_arrays([col if n == text else b.column(b.schema.get_field_index(n)) for n in names], names)

    return df.mapInArrow(run, out.schema)
