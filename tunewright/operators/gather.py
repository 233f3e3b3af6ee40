"""Gathering the rows of a group into ordered arrays of bounded size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.operators.ranged import running

#: Octets of a part; a row counts with some more than its texts, which bounds the rows of a part too.
PART_OCTETS = 1 << 24
ROW_OCTETS = 64
#: More long groups than that are not broadcast.
MAX_LONG = 100_000


def row_octets(*texts: Column) -> Column:
    """What a row counts with: the octets of its texts, and some for itself."""
    total = F.lit(ROW_OCTETS).cast("bigint")
    for text in texts:
        total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def gather(
    df: DataFrame, key: str, order: str, payload: list[str], octets: Column, octets_per_part: int = PART_OCTETS
) -> DataFrame:
    """Rows `(key, part, slice, items)`: the payloads of each key as an array in `order`.

    A group's rows, laid end to end in `order`, are cut where their octets pass a multiple of
    `octets_per_part`; a part holds the rows that begin in it. So the parts of a group depend on its own
    rows only, and none is longer than that and one row. `slice` is always 0. A group is whole when
    its rows are read by part; its first row is in part 0. Rows of one `order` are in order of their
    payload within a part, and of their hash over parts.

    Groups of one part, which nearly all are, take one shuffle. Only the rows of longer ones are sorted by range, so
    that a group with a large share of all rows is never one task, and cut by their running octets.
    """
    sized = df.select(F.col(key).alias("key"), F.col(order).alias("order"), *payload, octets.alias("_octets"))
    long = sized.groupBy("key").agg(F.sum("_octets").alias("n")).where(F.col("n") > octets_per_part).select(F.col("key").alias("_long"))
    count = long.count()
    if not count:
        return _gathered(sized.withColumn("part", F.lit(0).cast("bigint")), key, payload)
    long = F.broadcast(long) if count <= MAX_LONG else long
    same = F.col("key").eqNullSafe(F.col("_long"))
    short = sized.join(long, same, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    placed = running(sized.join(long, same, "left_semi"), ["key"], ["order"], "_before", lambda _, before, *rest: before, pa.float64(), "_octets")
    cut = placed.withColumn("part", F.floor(F.col("_before") / octets_per_part)).drop("_before")
    return _gathered(short, key, payload).unionByName(_gathered(cut, key, payload))


def _gathered(placed: DataFrame, key: str, payload: list[str]) -> DataFrame:
    rows = placed.groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("order", *payload))).alias("rows"))
    return rows.select(
        F.col("key").alias(key), "part", F.lit(0).cast("bigint").alias("slice"),
        F.transform("rows", lambda r: F.struct(*[r[name] for name in payload])).alias("items"),
    )
