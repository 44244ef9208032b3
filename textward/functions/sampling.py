"""Seeded, id-based sampling keys.

The key depends on the row's id only, so a sample stays the same under any partitioning, after a
lost executor, and in a stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(id_col: Column | str, seed: int = 42) -> Column:
    """Uniform 128-bit hex key; ordering by it is a seeded shuffle."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}|"), i.cast("string")))


def bernoulli(id_col: Column | str, rate: float, seed: int = 42) -> Column:
    """True for a share ``rate`` of the ids."""
    draw = F.conv(F.left(sample_key(id_col, seed), F.lit(8)), 16, 10).cast("bigint")
    return draw < F.lit(float(rate) * 2**32)
