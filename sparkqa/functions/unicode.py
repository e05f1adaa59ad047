"""Unicode NFD, the one normalisation Spark has no built-in for (Arrow-batched).

Python UDFs are evaluated for every input row of their projection, so the functions return
ASCII strings untouched without calling the normaliser (``str.isascii`` is a fast check).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nfd(v):
    if not isinstance(v, str) or v.isascii():
        return v
    return unicodedata.normalize("NFD", v)


@F.pandas_udf(T.StringType())
def nfd(s: pd.Series) -> pd.Series:
    """NFD of each value; nulls stay null."""
    return s.map(_nfd)


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfd_array(s: pd.Series) -> pd.Series:
    """NFD of each element of an array of strings; null arrays stay null."""
    return s.map(lambda a: None if a is None else [_nfd(x) for x in a])


@F.pandas_udf(T.StringType())
def zlib_text(b: pd.Series) -> pd.Series:
    """Decompress zlib-compressed UTF-8 bytes (N16 with compressed meta); nulls stay null."""
    import zlib
    return b.map(lambda v: None if v is None else zlib.decompress(v).decode("utf-8"))


@F.pandas_udf(T.BinaryType())
def zlib_bytes(s: pd.Series) -> pd.Series:
    """zlib-compress UTF-8 text (writes compressed meta for the round trip)."""
    import zlib
    return s.map(lambda v: None if v is None else zlib.compress(v.encode("utf-8")))
