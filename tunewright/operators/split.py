"""Reproducible train/test splits, exact-size selection and first-n rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunewright.functions.draws import BUCKETS, draw32
from tunewright.operators.position import TOP_ROWS, first_by
from tunewright.operators.ranged import with_position

COARSE_BUCKETS = 2**18


def train_test_split(
    df: DataFrame, key: str, test_size: float = 0.1, seed: int = 42, exact: bool = False
) -> DataFrame:
    """Add `split`, 'train' or 'test', drawn from the row's key.

    The default compares a hash of the key with a threshold: no shuffle, the same answer under any
    partitioning, and appended rows never move an old one. `exact=True` puts
    `ceil(test_size * rows)` rows in test, those of the smallest hashes.
    """
    if test_size <= 0:
        return df.withColumn("split", F.lit("train"))
    if exact:
        marked = mark_smallest(df, key, "_test", fraction=test_size, seed=seed)
        return marked.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")
    in_test = draw32(seed, F.col(key)) < int(test_size * BUCKETS)
    return df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def mark_smallest(
    df: DataFrame, key: str, name: str, n: int | None = None, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Add `name`, true for exactly `n` rows of `df` (or `ceil(fraction * rows)`): those of the
    smallest hashed keys, and as many copies of the last key as are left. Null keys are never taken.

    A count per coarse hash bucket (at most 262,144 rows, whatever the table's size) finds the bucket
    the cut falls in; only that bucket's keys are ranked, and the cut comes to the driver as one row.
    Only where it falls among copies of a key are these numbered, by ranges that are written once.
    """
    bucket = F.expr(f"h div {BUCKETS // COARSE_BUCKETS}")
    hashed = df.select(draw32(seed, F.col(key)).alias("h"), F.col(key).alias("k"))
    coarse = hashed.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    # unpartitioned windows: over the bucket counts here, over one bucket's keys below
    all_buckets = Window.orderBy("b")
    through = F.sum("c").over(all_buckets.rowsBetween(Window.unboundedPreceding, 0))
    rows = F.sum("c").over(
        all_buckets.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    wanted = F.lit(n) if fraction is None else F.ceil(rows * F.lit(fraction))
    cut = (
        coarse.select("b", "c", through.alias("t"), F.least(wanted, rows).alias("wanted"))
        .where((F.col("t") >= F.col("wanted")) & (F.col("t") - F.col("c") < F.col("wanted")))
        .select(F.struct("b", (F.col("wanted") - F.col("t") + F.col("c")).alias("left")).alias("cut"))
        .scalar()
    )
    inside = hashed.where(bucket == cut["b"]).groupBy("h", "k").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(
        F.sum("c").over(Window.orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    last = (
        inside.withColumn("before", before)
        .where(F.col("before") < cut["left"])
        .agg(F.max(F.struct("h", "k", (cut["left"] - F.col("before")).alias("left"), "c")).alias("last"))
        .first()
        .last
    )
    if last is None:
        return df.withColumn(name, F.lit(False))
    own = F.struct(draw32(seed, F.col(key)).alias("h"), F.col(key).alias("k"))
    end = F.struct(F.lit(last.h).alias("h"), F.lit(last.k).cast(df.schema[key].dataType).alias("k"))
    if last.left >= last.c:
        return df.withColumn(name, F.coalesce(own <= end, F.lit(False)))
    tied = F.coalesce(own == end, F.lit(False))
    numbered = with_position(df.where(tied), [], key, "_number")
    copies = numbered.select(*df.columns, (F.col("_number") <= last.left).alias(name))
    return df.where(~tied).withColumn(name, F.coalesce(own < end, F.lit(False))).unionByName(copies)


def head(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first `min(n, rows)` rows in `order`: top rows for a small `n`, else rows numbered over all tasks."""
    if n <= TOP_ROWS:
        return first_by(df, order, 0, n)
    return with_position(df, [], order, "_position").where(F.col("_position") <= n).drop("_position")


def split_counts(df: DataFrame) -> DataFrame:
    """Train and test row counts; 0 and 0 without rows."""
    return df.agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )
