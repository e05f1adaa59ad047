"""Shared pieces of the training-data operators: storage, hot keys, hashing of words in Arrow buffers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.operators.util import materialize

__all__ = ["materialize", "table", "chunks", "word_hashes", "mix64", "salted_row_number", "parallel", "release"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parallel(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def salted_row_number(df: DataFrame, key: list[str], order: list[str], salt_by: str, name: str,
                      salts: int = 256) -> DataFrame:
    """Numbers from 0, without gaps, inside each ``key``; a key may hold any share of the rows.

    Rows of a key are dealt to ``salts`` parts by the hash of ``salt_by``, numbered inside their
    part, and shifted by the rows of the parts before.  No task holds a whole hot key; the table
    of part sizes has ``salts`` rows a key.
    """
    from pyspark.sql import Window
    d = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    parts = d.groupBy(*key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_salt").alias("_s"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*key, "_salt").orderBy(*order)
    d = d.withColumn("_rn", F.row_number().over(inner) - 1)
    same = F.col("_salt") == F.col("_s")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return d.join(parts, same).withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")) \
        .select(*df.columns, name)


# --- words as 64-bit hashes, straight from Arrow buffers --------------------------------------------
# A word is a maximal run of bytes outside space and 0x09-0x0D.  Its hash is a polynomial over
# random values of its bytes (A-Z as a-z on request), read off one running sum over the chunk.
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_state: dict = {}


def _tables(n: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_state.get("pow", ())) < n + 1:
        m = max(n + 1, CHUNK_BYTES + 1)
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in (("pow", _BASE), ("inv", inv)):
            f = np.full(m, b, np.uint64)
            f[0] = 1
            _state[k] = np.multiply.accumulate(f)
    if lower not in _state:
        t = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            t[65:91] = t[97:123]
        _state[lower] = t
    return _state["pow"], _state["inv"], _state[lower]


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch whose texts sum to about ``most`` bytes, each with the texts' bytes and the
    ``len + 1`` offsets into them.  A null text is empty.  Texts are never cut."""
    i = 0
    col = batch.column(batch.schema.get_field_index(column))
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1] \
        if len(col) else np.zeros(1, np.int64)
    if len(col) and col.null_count:
        sizes = np.where(np.asarray(col.is_null()), 0, np.diff(offs))
    else:
        sizes = np.diff(offs)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    ends = np.cumsum(sizes)
    while i < len(col):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + most, "right")))
        own = np.zeros(j - i + 1, np.int64)
        np.cumsum(sizes[i:j], out=own[1:])
        if own[-1] == offs[j] - offs[i]:
            part = data[offs[i]:offs[j]]
        else:  # null slots that still hold bytes
            part = np.concatenate([data[offs[k]:offs[k] + sizes[k]] for k in range(i, j)] or [data[:0]])
        yield batch.slice(i, j - i), part, own
        i = j
    release()


def release() -> None:
    """Give memory that is no longer used back to the machine: a Python worker lives on beside others after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start byte and end byte of every word, and the ``len(offs)`` offsets of the texts' words."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, np.zeros(len(offs), np.int64)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return hash_ranges(data, starts, ends, lower), starts, ends, np.searchsorted(starts, offs)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of byte ranges of a chunk; equal bytes (A-Z as a-z on request) hash alike anywhere."""
    return hash_between(running(data, lower), starts, ends)


def running(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """The running sum that the hashes of all ranges of a chunk are read off."""
    power, _, values = _tables(len(data), lower)
    run = np.empty(len(data) + 1, np.uint64)
    run[0] = 0
    np.cumsum(values[data] * power[:len(data)], out=run[1:])
    return run


def hash_between(run: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = (ends - starts).astype(np.uint64)
    return mix64((run[ends] - run[starts]) * _state["inv"][starts] + size * np.uint64(0xD6E8FEB86659FD93))
