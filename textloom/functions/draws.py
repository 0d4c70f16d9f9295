"""Random draws as hashes of row keys.

A draw depends only on the seed and the keys, never on partitioning, retries
or row order, so a lost executor recomputes the same values.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 1 << 32


def draw_key(seed: str, *keys) -> Column:
    """The text whose digest gives the draws."""
    parts = [F.lit(seed)] + [k.cast("string") if isinstance(k, Column) else F.col(k).cast("string") for k in keys]
    return F.concat_ws("|", *parts)


def draw_hex(seed: str, *keys) -> Column:
    """32 hex digits; each group of eight is an independent 32-bit draw."""
    return F.md5(draw_key(seed, *keys))


def draw_bits(digest: Column, part: int = 0) -> Column:
    """The ``part``-th 32-bit draw (0..3) of a digest as a long."""
    return F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("long")


def chance(digest: Column, probability: float, part: int = 0) -> Column:
    """True with the given probability."""
    return draw_bits(digest, part) < F.lit(int(probability * TWO32))


def pick(digest: Column, n, part: int = 0) -> Column:
    """Uniform integer in [0, n)."""
    size = n if isinstance(n, Column) else F.lit(n)
    return F.shiftright(draw_bits(digest, part) * size.cast("long"), 32)


def host_draw(part: int, *keys) -> int:
    """The same draw inside a Python task."""
    digest = hashlib.md5("|".join(str(k) for k in keys).encode()).hexdigest()
    return int(digest[8 * part : 8 * part + 8], 16)
