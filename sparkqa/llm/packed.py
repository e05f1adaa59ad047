"""Columns of numbers packed into one value, for rows that stand for many."""

from __future__ import annotations

import numpy as np
import zstandard

_KINDS = (np.dtype("<i8"), np.dtype("<u8"), np.dtype("<f8"))


def pack(*columns: np.ndarray) -> bytes:
    """Columns as one zstd frame, each with its type and length before it and written byte by byte: the first bytes of
    all numbers, then the second ones.  Unsigned numbers are sorted keys and are kept as their differences."""
    parts = []
    for c in columns:
        kind = {"u": 1, "f": 2}.get(c.dtype.kind, 0)
        c = np.ascontiguousarray(c, _KINDS[kind])
        if kind == 1 and len(c):
            c = np.diff(c, prepend=np.uint64(0))
        parts += [np.array([kind, len(c)], "<i8").tobytes(), c.view(np.uint8).reshape(-1, 8).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(frame: bytes) -> list[np.ndarray]:
    raw, out, i = zstandard.ZstdDecompressor().decompress(frame), [], 0
    while i < len(raw):
        kind, n = np.frombuffer(raw, "<i8", 2, i).tolist()
        i += 16
        c = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, i).reshape(8, n).T).view(_KINDS[kind]).reshape(-1)
        out.append(np.cumsum(c, dtype=np.uint64) if kind == 1 else c)
        i += 8 * n
    return out
