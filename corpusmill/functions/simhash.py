"""Fingerprints of texts: 32 votes over the hashed character 7-grams, the word doubled to 64 bits."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

SIZE = 7
BANDS, BAND_BITS = 3, 17


def shingle_hashes(text: str) -> np.ndarray:
    """The different hashes (s[0]*31^6 + ... + s[6], modulo 2^32) of all 7 UTF-16 units in a row."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint32)
    if len(units) < SIZE:
        return np.empty(0, np.uint32)
    n = len(units) - SIZE + 1
    h = np.zeros(n, np.uint32)
    for i in range(SIZE):
        h = h * np.uint32(31) + units[i : i + n]
    return np.unique(h)


def simhash_of(text: str | None) -> int | None:
    """The signed 64-bit fingerprint; a bit is set if more hashes have it than not. Texts under 7 units give 0."""
    if text is None:
        return None
    h = shingle_hashes(text)
    if not len(h):
        return 0
    votes = np.unpackbits(h.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little").sum(0, dtype=np.int64)
    low = int((votes * 2 > len(h)).astype(np.uint64) @ (np.uint64(1) << np.arange(32, dtype=np.uint64)))
    both = low | low << 32
    return both - (1 << 64) if both >> 63 else both


@F.pandas_udf(LongType())
def simhash(texts: pd.Series) -> pd.Series:
    return texts.map(simhash_of).astype("Int64")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def bands(h: Column) -> Column:
    """The three 17-bit bands of a fingerprint, from its lowest bit. Any two fingerprints that differ in at most three
    of 64 bits share one: their halves are equal, so at most one bit of a half differs, and a band misses it."""
    mask = (1 << BAND_BITS) - 1
    return F.array(*(F.shiftrightunsigned(h, BAND_BITS * i).bitwiseAND(F.lit(mask)).cast("int") for i in range(BANDS)))
