"""First rows of groups of any size, and of a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: More first rows than that are numbered over all tasks, fewer are one task's top rows.
TOP_ROWS = 100_000
#: Pieces that a group is cut into before its first rows are found.
PIECES = 32


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int, name: str, spread: Column) -> DataFrame:
    """The first `n` rows of each group in `order`, numbered by `name`.

    The first `n` of each of some pieces of a group are found first, by the hash of `spread`, so that
    no task sorts a whole group, however large `n` is; then the first `n` of those.
    """
    piece = F.pmod(F.xxhash64(spread), F.lit(PIECES))
    inside = Window.partitionBy(*by, "_piece").orderBy(*order)
    whole = Window.partitionBy(*by).orderBy(*order)
    some = df.withColumn("_piece", piece).withColumn(name, F.row_number().over(inside)).where(F.col(name) <= n)
    return some.drop("_piece").withColumn(name, F.row_number().over(whole)).where(F.col(name) <= n)


def first_by(df: DataFrame, order: str, offset: int, length: int) -> DataFrame:
    """`length` rows in `order` after the first `offset`, nulls first.

    The keys of the page are found over the key column alone, as top rows of every task. Whole rows
    are then read between the first and the last of them, so that a scan skips what its
    statistics rule out and only some more rows than the page are sorted.
    """
    key = F.col(f"`{order}`")
    keys = df.select(key.alias("k")).orderBy("k").offset(offset).limit(length)
    found = keys.agg(F.count("*").alias("n"), F.count("k").alias("solid"), F.min("k").alias("low"), F.max("k").alias("high")).first()
    if not found.n:
        return df.limit(0)
    if found.solid < found.n:  # some of the page have no key
        wanted = key.isNull() if not found.solid else key.isNull() | (key <= F.lit(found.high))
        return df.where(wanted).orderBy(key).offset(offset).limit(length)
    earlier = df.where(key.isNull() | (key < F.lit(found.low))).select(F.count("*").alias("n")).first().n if offset else 0
    return df.where((key >= F.lit(found.low)) & (key <= F.lit(found.high))).orderBy(key).offset(offset - earlier).limit(length)
