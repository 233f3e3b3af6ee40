"""Helpers shared by the operators: staged tables, bounded caches, batches of bounded size."""

from __future__ import annotations

import gc
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tunewright.session import fresh_dir, ship_package

#: Rows of an Arrow batch: whole texts can be long, so a batch stays some MB.
BATCH_ROWS = "512"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the workers and keep Arrow batches of long texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return _known(out, path)


def _known(df: DataFrame, path: str) -> DataFrame:
    df._staged_at = path
    for written in _REMEMBERED:
        written.append(df)
    return df


_REMEMBERED: list[list[DataFrame]] = []


@contextmanager
def remembered():
    """A list of all staged tables that are made within the block."""
    written: list[DataFrame] = []
    _REMEMBERED.append(written)
    try:
        yield written
    finally:
        _REMEMBERED.pop()  # blocks end in turn


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like `staged`, in files by the hash of a column, so that grouping by it needs no shuffle of these rows."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    known = f"{name}_{path.rsplit('-', 1)[-1]}"
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(known)
    out = _known(spark.table(known), path)
    spark.sql(f"DROP TABLE {known}")  # the catalogue's entry; the files stay
    return out


def release(*frames: DataFrame) -> None:
    """Delete the files of staged rows that nothing reads any more; anything else is left alone."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_KEPT: list[dict] = []
_SERVED = [""]


def kept(cache: dict) -> dict:
    """A cache of the module, which a worker process keeps from task to task of one operator."""
    _KEPT.append(cache)
    return cache


def serve(operator: str) -> None:
    """What a task's Python starts with: a worker that turns to another operator forgets what it kept for the last.

    Workers live on from query to query, so caches of one would else count against the memory of all that follow.
    """
    if _SERVED[0] != operator:
        _SERVED[0] = operator
        for cache in _KEPT:
            cache.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


class Memo(dict):
    """A cache of `make(key)` that starts anew when it holds `limit` keys."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value
