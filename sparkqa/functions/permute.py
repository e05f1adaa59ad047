"""A keyed bijection of 0..n-1, computed in place: where row x stands in an epoch, without sorting anything.

x is written as (l, r) in a box of ``a * b >= n`` places, ``a`` and ``b`` near the square root of n.  Rounds add a
keyed function of one coordinate to the other, which can be undone, so the box is permuted whatever the
function.  A place outside 0..n-1 is permuted again until it is inside (cycle walking); the box has less than
``a`` such places, and the longest walk over them is found beforehand.  All numbers stay below 2 ** 62, for n up to 2 ** 60.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647  # 2 ** 31 - 1
HALF_ROUNDS = 8


def round_keys(seed: int, epoch: int) -> list[tuple[int, int, int]]:
    """Three numbers a half-round, from 1 to PRIME - 1, by MD5 of ``seed + epoch`` and the round."""
    out = []
    for i in range(HALF_ROUNDS):
        h = hashlib.md5(f"{seed + epoch}:{i}".encode()).hexdigest()
        out.append(tuple(int(h[j:j + 8], 16) % (PRIME - 1) + 1 for j in (0, 8, 16)))
    return out


def box(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(-(-n // a), 1)


def _mixed(v, k):
    t = (v * k[0] + k[1]) % PRIME
    return ((t ^ (t >> 15)) * k[2]) % PRIME


def permuted(x: np.ndarray, n: int, keys: list) -> np.ndarray:
    """One pass over places of the box."""
    a, b = box(n)
    lo, r = np.divmod(np.asarray(x, np.int64), b)
    for i, k in enumerate(keys):
        if i % 2 == 0:
            lo = (lo + _mixed(r, k)) % a
        else:
            r = (r + _mixed(lo, k)) % b
    return lo * b + r


def passes(n: int, keys: list) -> int:
    """How many passes bring every place of 0..n-1 back inside: 1, and 1 more for each step of the longest walk outside."""
    a, b = box(n)
    outside = np.arange(n, a * b, dtype=np.int64)
    image = permuted(outside, n, keys)
    walk = outside[~np.isin(outside, image)]  # entered from inside; the others are walked from these, or never
    count = 1
    while len(walk):
        walk = permuted(walk, n, keys)
        walk = walk[walk >= n]
        count += 1
    return count


def position(x: Column, n: Column, a: Column, b: Column, keys: list, walks: int) -> Column:
    """The place of row ``x`` (0..n-1) among n, with ``box(n)`` = (a, b) and ``walks`` >= ``passes(n)``."""
    long = lambda c: c.cast("bigint")
    rounds = F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip("uvw", k)], F.lit(i % 2 == 0).alias("first"))
                       for i, k in enumerate(keys)])

    def mixed(v, k):
        t = (v * k["u"] + k["v"]) % PRIME
        return (t.bitwiseXOR(F.shiftright(t, 15)) * k["w"]) % PRIME

    def turn(s, k):
        lo = F.when(k["first"], (s["l"] + mixed(s["r"], k)) % a).otherwise(s["l"])
        r = F.when(k["first"], s["r"]).otherwise((s["r"] + mixed(s["l"], k)) % b)
        return F.struct(long(lo).alias("l"), long(r).alias("r"))

    def once(y):
        start = F.struct(long(F.floor(y / b)).alias("l"), long(y % b).alias("r"))
        return F.aggregate(rounds, start, turn, lambda s: s["l"] * b + s["r"])

    y = once(long(x))
    if walks > 1:
        y = F.aggregate(F.array(*[F.lit(i) for i in range(walks - 1)]), y, lambda p, _: F.when(p < n, p).otherwise(once(p)))
    return y
