"""Seeded draws: the same row gets the same draw whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 2**32


def draw32(seed, *keys: Column) -> Column:
    """A uniform integer in [0, 2**32) from the seed and the key columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[key.cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def pick(items: list[str], seed, *keys: Column) -> Column:
    """One of `items`, drawn by `draw32`."""
    index = F.pmod(draw32(seed, *keys), F.lit(len(items))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(item) for item in items]), index)
