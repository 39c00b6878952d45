"""Random draws that depend on a row's key and a seed, not on its partition.

``rand`` gives other numbers when the partitioning or a retry changes; a hash of
the key does not, so a lost task can be run again with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int | str, *key: Column) -> Column:
    """Uniform double in [0, 1) from the seed and the key."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draw_between(lo, hi, seed: int | str, *key: Column) -> Column:
    """Uniform double in [lo, hi)."""
    lo, hi = (F.lit(lo), F.lit(hi))
    return lo + draw(seed, *key) * (hi - lo)


def draw_index(n: Column, seed: int | str, *key: Column) -> Column:
    """Uniform integer in [0, n)."""
    return F.floor(draw(seed, *key) * n)
