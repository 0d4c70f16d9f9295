"""A keyed permutation of 0 .. n-1 that needs no memory of the others.

A balanced Feistel network permutes the numbers of an even count of bits; what
falls outside 0 .. n-1 is sent through again until it is inside (cycle
walking), at most four times on average. The same seed and ``n`` give the same
permutation in every task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit values spread over all bits under a round key."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x


def permuted(numbers: np.ndarray, n: int, seed: str) -> np.ndarray:
    """Place of each number in a permutation of 0 .. n-1."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    digest = hashlib.sha256(f"{seed}|{n}".encode()).digest() * 2
    keys = [int.from_bytes(digest[8 * r : 8 * r + 8], "little") for r in range(ROUNDS)]

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for key in keys:
            left, right = right, left ^ (_mixed(right, key) & low)
        return left << np.uint64(half) | right

    out = network(np.asarray(numbers, dtype=np.uint64))
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def permutation(number: Column, n: int, seed: str) -> Column:
    """``permuted`` as a column expression over dense numbers."""

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    return place(number)
