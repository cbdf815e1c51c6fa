"""Reproducible random numbers: a hash of seed and keys, so that draws don't depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw32(seed: int, *keys: Column | str) -> Column:
    """A number from 0 to 2**32 - 1."""
    parts = [F.lit(str(seed)), *(F.lit(k) if isinstance(k, str) else k.cast("string") for k in keys)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def draw(seed: int, *keys: Column | str, below: Column) -> Column:
    """A number from 0 to below - 1."""
    return draw32(seed, *keys) % below


def heads(flips: Column, seed: int, *keys: Column | str) -> Column:
    """How many of `flips` fair coins show heads: bits of as many 32-bit draws as it takes."""
    blocks = F.when(flips > 0, F.sequence(F.lit(0), F.ceil(flips / 32).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def add(total: Column, m: Column) -> Column:
        drop = (32 - F.least(F.lit(32), flips - 32 * m)).cast("int")
        return total + F.bit_count(F.call_function("shiftright", draw32(seed, *keys, m), drop))

    return F.aggregate(blocks, F.lit(0), add)
