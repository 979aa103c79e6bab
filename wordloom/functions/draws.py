"""Seeded draws. A draw depends on (key, seed, index) only, so retries repeat it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN = 1 << 32


def draw(key: Column, seed: int, index: int) -> Column:
    """Uniform integer in [0, 2^32): eight hex digits of one md5; four draws share a digest."""
    block, slot = divmod(index, 4)
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(str(block))))
    return F.conv(F.substring(digest, slot * 8 + 1, 8), 16, 10).cast("bigint")


def chance(u: Column, probability: float) -> Column:
    return u < F.lit(int(probability * SPAN))


def below(u: Column, n: Column | int) -> Column:
    """Uniform integer in [0, n)."""
    return (u % n).cast("int")
