"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tunewright", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC, AQE and skew handling on; `conf` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # collect_list over many keys: keep hashing longer before the sort fallback
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
        # join wide texts with small partitions of the other side without sorting the texts
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        # streaming state larger than memory
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or the warehouse where unset.

    A session on one machine falls back to a temporary folder; a cluster without either is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] == "local":
        folder = tempfile.mkdtemp(prefix="tunewright-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
    if not warehouse or warehouse.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/tunewright"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created or overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_tunewright_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tunewright-"), "tunewright.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._tunewright_shipped = True
