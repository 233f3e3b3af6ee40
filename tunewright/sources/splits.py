"""Split datasets on disk: partitioned tables, named datasets and versions."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.session import setting

# a task keeps a file open per split instead of sorting its rows by split
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "8")


def write_split(
    df: DataFrame, path: str, mode: str = "errorifexists", max_rows_per_file: int = 5_000_000
) -> None:
    """Write a dataset with a `split` column, one directory per split: no shuffle and no sort."""
    with setting(df.sparkSession, *OPEN_FILES):
        (
            df.write.mode(mode)
            .partitionBy("split")
            .option("maxRecordsPerFile", max_rows_per_file)
            .parquet(path)
        )


def read_split(
    spark: SparkSession, path: str, split: str | None = None, schema: str | None = None
) -> DataFrame:
    """Read a split dataset; a named split reads only its own directory."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def load_dataset(spark: SparkSession, name: str, split: str | None = None) -> DataFrame:
    """One split of a named dataset: a catalogue table, or a Parquet path."""
    known = "/" not in name and spark.catalog.tableExists(name)
    df = spark.read.table(name) if known else spark.read.parquet(name)
    return df if split is None else df.where(F.col("split") == split)


def versions(spark: SparkSession, base: str) -> DataFrame | None:
    """The record of complete versions (version, saved_at, folder); none where nothing was saved yet.

    `folder` is where the version's attempt that won wrote its rows; versions saved without attempts have none.
    """
    try:
        record = spark.read.schema("version STRING, saved_at TIMESTAMP, folder STRING").parquet(f"{base}/complete")
        # a version may be recorded twice: by its winner, and by one that completed the record for it
        return record.groupBy("version").agg(F.min("saved_at").alias("saved_at"), F.max("folder").alias("folder"))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_complete(spark: SparkSession, base: str, version: str) -> bool:
    known = versions(spark, base)
    return known is not None and not known.where(F.col("version") == version).isEmpty()


def save_version(df: DataFrame, base: str, version: str) -> None:
    """Write a new version beside the older ones, then record it as complete.

    Every attempt writes to a folder of its own, so that two writers of one version, or a failed write
    and the next one, never mix files. An attempt is committed by creating the version's claim, which the
    file system lets one of them do; the other is an error, and readers never see its rows. The
    winner then adds the version and its folder to the record that readers go by. A winner that is lost
    between the two is found by its claim: saving the version again completes the record with the folder that
    the claim names, and is an error like any second save.
    """
    spark = df.sparkSession
    if is_complete(spark, base, version):
        raise ValueError(f"version {version} of {base} is complete already")
    folder = f"data/version={version}/attempt-{uuid.uuid4().hex}"
    if "split" in df.columns:
        write_split(df, f"{base}/{folder}")
    else:
        df.write.parquet(f"{base}/{folder}")
    winner = _claim(spark, f"{base}/claims/{version}", folder)
    if winner == folder or not is_complete(spark, base, version):
        _complete(spark, base, version, winner)
    if winner != folder:
        lost = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{folder}")
        lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)
        raise ValueError(f"version {version} of {base} is complete already")


def _claim(spark: SparkSession, path: str, folder: str) -> str:
    """The folder that the claim names: this one, if its file could be made, else that of an earlier attempt.

    The file gets its content under another name first and its own name by a rename, which fails where the name is taken.
    """
    names, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    claim, draft = names.Path(path), names.Path(f"{path}.{uuid.uuid4().hex}")
    system = claim.getFileSystem(conf)
    claim, draft = system.makeQualified(claim), system.makeQualified(draft)
    keep_what_is_there = spark.sparkContext._gateway.new_array(getattr(names, "Options$Rename"), 0)
    with_content = system.create(draft, False)
    with_content.write(folder.encode())
    with_content.close()
    try:
        names.FileContext.getFileContext(claim.toUri(), conf).rename(draft, claim, keep_what_is_there)
        return folder
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" not in problem.java_exception.toString():
            raise
        system.delete(draft, False)
    return spark.read.text(path).first().value


def _complete(spark: SparkSession, base: str, version: str, folder: str) -> None:
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("saved_at"), F.lit(folder).alias("folder"))
    row.write.mode("append").parquet(f"{base}/complete")


def latest_version(spark: SparkSession, base: str) -> str:
    """The version recorded last."""
    known = versions(spark, base)
    if known is None:
        raise ValueError(f"no version of {base} is complete")
    return known.agg(F.max_by("version", F.struct("saved_at", "version"))).first()[0]


def read_version(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    version = version or latest_version(spark, base)
    known = versions(spark, base)
    row = None if known is None else known.where(F.col("version") == version).agg(F.count("*").alias("n"), F.max("folder").alias("folder")).first()
    if row is None or not row.n:
        raise ValueError(f"version {version} of {base} is not complete")
    return spark.read.parquet(f"{base}/{row.folder or f'data/version={version}'}")
