"""Cross-tokenizer alignment: which tokens of a byte-level tokenizer (A) and of a piece tokenizer (B) end together,
and how often each pair of ids does over the whole corpus.

Counting is external.  Texts are read in blocks.  A block's records (pair, document, times) are radix-partitioned
by B id and written as zstd runs in side-major order: by B id, then A id, then document.  Each
run has a short companion, its totals by pair.  The totals of a radix are merged by a heap, ``FAN`` runs
at a time, round after round, until one run a radix is left; as that run comes out in side-major order, a B id's
highest count is known when its last pair has passed.  Then every block's records stream against the counted
pairs, in the same order, and what they contribute goes back to their documents.  The records stay where they are
written: only totals travel, and no task holds a hot pair's documents.

The counted pairs have a bound that no corpus changes: of two tokens that end together, the shorter one's
bytes end the longer one's (``most_pairs`` counts these pairs of the vocabularies).  So they are broadcast.

Tokenizing goes by segments, cut where white space that is a space, or a single line feed, follows
something else, and where a comma or full stop follows an ASCII letter: no token of either vocabulary
crosses such a place (a vocabulary with one that does is refused).  A worker remembers the segments
it has met, up to ``CACHE_SEGMENTS`` and ``CACHE_CHARS``; beyond, it forgets them all and goes on.

Edge cases: null and empty texts, and texts that either tokenizer does not give back byte for byte,
have no tokens: zeros and an empty digest; repeated rows count as often as they are there; null ids are kept;
a text of any length is read whole, in a block of its own if need be; an empty table gives an empty
result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize
from sparkqa.llm.packed import pack, unpack

BLOCK_CHARS = 4 << 20
RADIXES, FAN = 16, 64
CACHE_SEGMENTS, CACHE_CHARS = 400_000, 8 << 20
_RUN = r"(?:[^\s,.]+|(?<![A-Za-z])[,.])"
_SEGMENT = re.compile(rf"(?:\s+{_RUN}+|[,.]{_RUN}*)(?:(?! |\n\S)\s+{_RUN}+)*")
_CROSSES = re.compile(r"\S |[A-Za-z][,.]|\n.|.\n", re.S)  # what no token may hold


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker a core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(x): x for x in printable}
        byte_of |= {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(printable)))}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(_CROSSES.search(p) for p in (x.decode("utf-8", "replace").lstrip(" ") for x in self.bytes_b)):
            raise ValueError("a piece of this vocabulary crosses the places where texts are cut")
        self.lead = self.b.encode("\n")  # the space that the tokenizer adds, and a line feed, which joins with nothing
        self.shift = max(len(pieces) - 1, 1).bit_length() - (RADIXES - 1).bit_length()

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        """Of texts that start with the space that the tokenizer adds, or without one."""
        got = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        n = len(self.lead)
        return [g if t[0] == " " else g[n:] if g[:n] == self.lead else [] for t, g in zip(texts, got)]


def most_pairs(t: Tokenizers) -> int:
    """How many pairs of ids could ever end together: of which one's bytes end the other's."""
    def by_bytes(tokens):
        out: dict[bytes, int] = {}
        for x in tokens:
            out[x] = out.get(x, 0) + 1
        return out
    in_a, in_b = by_bytes(t.bytes_a), by_bytes(t.bytes_b)
    n = sum(in_b.get(x[i:], 0) for x in t.bytes_a for i in range(len(x)))
    return n + sum(in_a.get(x[i:], 0) for x in t.bytes_b for i in range(1, len(x)))


def segments(joined: str) -> list[str]:
    """Pieces of a text that starts with a space, cut where no token crosses."""
    out = _SEGMENT.findall(joined)
    left = len(joined) - sum(map(len, out))
    if left:  # white space at the end stays with what is before it
        tail = joined[-left:]
        out[-1:] = [out[-1] + tail] if out else [tail]
    return out


class Segments:
    """The tokens, groups and links of segments, remembered for the life of a worker."""

    def __init__(self, t: Tokenizers):
        self.t = t
        self.names_a, self.names_b = [list(map(str, range(len(x)))) for x in (t.bytes_a, t.bytes_b)]
        self.size_a, self.size_b = [np.array([len(x) for x in y], np.int64) for y in (t.bytes_a, t.bytes_b)]
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.facts = np.zeros((0, 4), np.int64)  # n_a, n_b, links, whole
        self.first, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def find(self, wanted: set[str]) -> None:
        """Learn what is not known; all of ``wanted`` anew when that would be too much."""
        miss = [s for s in wanted if s not in self.place]
        if len(self.place) + len(miss) > CACHE_SEGMENTS or self.chars + sum(map(len, miss)) > CACHE_CHARS:
            self.clear()
            miss = list(wanted)
        for i in range(0, len(miss), 20_000):
            self.learn(miss[i:i + 20_000])

    def learn(self, miss: list[str]) -> None:
        if not miss:
            return
        got_a, got_b = self.t.ids_a(miss), self.t.ids_b(miss)
        raws = [s.encode("utf-8") for s in miss]
        back = [[b"".join(map(of.__getitem__, g)) for g in got] for of, got in ((self.t.bytes_a, got_a), (self.t.bytes_b, got_b))]
        if back[0] != raws or back[1] != raws:
            for i, raw in enumerate(raws):
                if back[0][i] != raw or back[1][i] != raw:
                    got_a[i] = got_b[i] = []
        n_a, n_b = (np.fromiter(map(len, g), np.int64, len(miss)) for g in (got_a, got_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(g), np.int64, int(n.sum())) for g, n in ((got_a, n_a), (got_b, n_b)))
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        at_a, at_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        off_a, off_b = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
        cut = np.searchsorted(at_a, off_a)  # groups before each segment
        a, b, to_a, to_b = ([self.names_a[x] for x in flat_a], [self.names_b[x] for x in flat_b], (at_a + 1).tolist(), (at_b + 1).tolist())
        names, x, y = [], 0, 0
        for u, v in zip(to_a, to_b):  # a segment's end is a group's
            names.append(",".join(a[x:u]) + "|" + ",".join(b[y:v]))
            x, y = u, v
        ends = cut.tolist()
        for i, s in enumerate(miss):
            self.place[s] = len(self.groups)
            self.groups.append(";".join(names[ends[i]:ends[i + 1]]))
            self.chars += len(s)
        self.facts = np.concatenate([self.facts, np.stack([n_a, n_b, np.diff(cut), n_a > 0], 1)])
        self.first = np.concatenate([self.first, self.first[-1] + cut[1:]])
        self.links = np.concatenate([self.links, (flat_b[at_b] << 16) | flat_a[at_a]])

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text n_a, n_b and the number of links (also that of groups), and its digest; and the links, with the text of each."""
        cut = [segments(" " + t) if t else [] for t in texts]
        self.find(set().union(*cut))
        place = [np.fromiter(map(self.place.__getitem__, c), np.int64, len(c)) for c in cut]
        odd = [i for i, p in enumerate(place) if len(p) and not self.facts[p, 3].all()]
        if odd:  # once more as one segment, to be sure that it is the text that does not come back
            whole = {" " + texts[i] for i in odd}
            self.find(whole.union(*cut))
            place = [np.fromiter(map(self.place.__getitem__, c), np.int64, len(c)) for c in cut]
            for i in odd:
                p = np.array([self.place[" " + texts[i]]])
                place[i] = p if self.facts[p, 3].all() else p[:0]
        n = np.fromiter(map(len, place), np.int64, len(place))
        at = np.concatenate(place) if len(place) else np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(n)), n)
        facts = np.zeros((len(n), 3), np.int64)
        np.add.at(facts, text, self.facts[at, :3])
        digests = []
        for p in place:
            h = hashlib.sha256()
            for i in range(0, len(p), 10_000):
                h.update((";" if i else "").encode() + ";".join(map(self.groups.__getitem__, p[i:i + 10_000].tolist())).encode())
            digests.append(h.hexdigest() if len(p) else "")
        many = self.facts[at, 2]
        ends = np.cumsum(many)
        src = np.repeat(self.first[at] - (ends - many), many) + np.arange(int(many.sum()))
        return facts, digests, self.links[src], np.repeat(text, many)


# --- runs ---------------------------------------------------------------------------------------------

def spill(links: np.ndarray, text: np.ndarray, texts: int, shift: int) -> tuple[list[bytes], list[bytes]]:
    """A block's runs, one a radix: records (steps between pairs, records a pair, text, times) and totals (pair, times)."""
    key, times = np.unique(links * max(texts, 1) + text, return_counts=True)
    pair, doc = np.divmod(key, max(texts, 1))
    edge = np.searchsorted(pair, (np.arange(RADIXES + 1) << (16 + shift)))
    records, totals = [], []
    for x, y in zip(edge[:-1], edge[1:]):
        p, first, n = np.unique(pair[x:y], return_index=True, return_counts=True)
        step = np.diff(p, prepend=0)
        records.append(pack(step, n, doc[x:y], times[x:y]))
        totals.append(pack(step, np.add.reduceat(times[x:y], first) if len(p) else p))
    return records, totals


def merge(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs' pairs in side-major order, their counts, and whether a pair's is the highest of its B id."""

    def pairs(run):
        step, times = unpack(run)
        return zip(np.cumsum(step).tolist(), times.tolist())

    keys, counts, best = [], [], []
    last, side, most, since = -1, -1, 0, 0

    def settle() -> None:
        best.extend([c == most for c in counts[since:]])

    for pair, times in heapq.merge(*map(pairs, runs)):
        if pair == last:
            counts[-1] += times
        else:
            if keys:
                most = max(most, counts[-1])
            if pair >> 16 != side:  # all pairs of the B id before have passed
                settle()
                side, most, since = pair >> 16, 0, len(keys)
            keys.append(pair)
            counts.append(times)
            last = pair
    if keys:
        most = max(most, counts[-1])
    settle()
    return np.array(keys, np.int64), np.array(counts, np.int64), np.array(best, bool)


_kept: dict = {}


def _segments(path_a: str, path_b: str) -> Segments:
    if (path_a, path_b) not in _kept:
        _kept.clear()
        _kept[path_a, path_b] = Segments(Tokenizers(path_a, path_b))
    return _kept[path_a, path_b]


def blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a block: block, keys, n_a, n_b, n_groups, groups_sha256 (arrays over its texts), records and totals (a run a radix)."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        from pyspark import TaskContext
        own = _segments(path_a, path_b)
        block = TaskContext.get().partitionId() << 32  # the same in a task run again
        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.utf8_length(batch.column(1)), 0), dtype=np.int64)
            ends, i = np.cumsum(sizes), 0
            while i < len(sizes):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK_CHARS, "right")))
                facts, digests, links, at = own.read(batch.column(1).slice(i, j - i).to_pylist())
                records, totals = spill(links, at, j - i, own.t.shift)
                one = lambda x, t: pa.array([x], pa.list_(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(0).slice(i, j - i)),
                     *(one(facts[:, k], pa.int64()) for k in range(3)), one(digests, pa.string()), one(records, pa.binary()), one(totals, pa.binary())],
                    ["block", "keys", "n_a", "n_b", "n_groups", "groups_sha256", "records", "totals"])
                block, i = block + 1, j

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(
        run, f"block long, keys array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
             "records array<binary>, totals array<binary>")


def counted(made: DataFrame) -> DataFrame:
    """radix, run: the pairs of each radix with their counts and whether they are the best of their B id, from the totals of ``blocks``."""
    runs = made.select(F.posexplode("totals").alias("radix", "run"), "block")
    n = made.count()

    def fold(last: bool):
        def run(group: pa.Table) -> pa.Table:
            pairs, counts, best = merge(group.column("run").to_pylist())
            step = np.diff(pairs, prepend=0)
            one = pack(step, counts, best) if last else pack(step, counts)
            return pa.table({"radix": pa.array([group.column("radix")[0].as_py()], pa.int32()), "block": pa.array([group.column("part")[0].as_py()]),
                             "run": pa.array([one], pa.binary())})
        return run

    while True:
        n = -(-n // FAN)
        dealt = runs.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n)) if n > 1 else F.lit(0).cast("bigint"))
        runs = dealt.groupBy("radix", "part").applyInArrow(fold(n <= 1), "radix int, block long, run binary")
        runs = materialize(runs, "align-runs")
        if n <= 1:
            return runs.select("radix", "run")


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    made = materialize(blocks(docs, path_a, path_b, key, text), "align-blocks")
    table = {r["radix"]: bytes(r["run"]) for r in counted(made).collect()}  # at most ``most_pairs`` pairs, whatever the corpus
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        found = {}
        for radix, x in shared.value.items():
            step, counts, best = unpack(x)
            found[radix] = (np.cumsum(step), counts, best)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                n = len(row["keys"])
                sums, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for radix, x in enumerate(row["records"]):
                    step, many, doc, times = unpack(x.as_py())
                    if not len(doc):
                        continue
                    pairs, counts, top = found[radix]
                    at = np.repeat(np.searchsorted(pairs, np.cumsum(step)), many)
                    np.add.at(sums, doc, counts[at] * times)
                    np.add.at(best, doc, top[at] * times)
                yield pa.RecordBatch.from_arrays([row["keys"].values, *(row[c].values for c in ("n_a", "n_b", "n_groups", "n_groups")),
                                                  pa.array(best), pa.array(sums), row["groups_sha256"].values],
                                                 [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return made.drop("totals", "block").mapInArrow(
        run, f"{key} {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
