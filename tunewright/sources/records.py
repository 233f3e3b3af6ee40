"""Reading and writing interview records as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.operators.ranged import with_position
from tunewright.operators.validate import parse_records
from tunewright.schemas import INTERVIEW_RECORD
from tunewright.sources.arrays import read_array


def read_records(
    spark: SparkSession, path: str, schema: str = INTERVIEW_RECORD, array: bool = False
) -> DataFrame:
    """Records of JSON Lines files, or of files that hold one JSON array each (`array=True`).

    Both are split among tasks; an array is cut at the borders of its elements.
    """
    if array:
        return read_with_rejects(spark, path, schema, array).drop("corrupt")
    return spark.read.schema(schema).json(path)


def read_raw(
    spark: SparkSession, path: str, array: bool = False, numbered: bool = False
) -> DataFrame:
    """Raw JSON text per record, so that a null value and a missing key stay apart.

    `numbered` adds the file and the 1-based `entry` number in it. Lines are numbered by ranges and
    shifted by the ranges before, so a large file is numbered by many tasks; elements of array
    files are always numbered.
    """
    if array:
        return read_array(spark, path).drop("number")
    lines = spark.read.text(path)
    if not numbered:
        return lines.withColumnRenamed("value", "raw")
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("raw"),
    )
    return with_position(placed, ["file"], ["_split", "_at"], "entry").select("file", "entry", "raw")


def read_with_rejects(
    spark: SparkSession, path: str, schema: str = INTERVIEW_RECORD, array: bool = False
) -> DataFrame:
    """Records with a `corrupt` column: the text of a malformed record, null for a good one."""
    if array:
        parsed = parse_records(read_array(spark, path).select("raw"), schema)
        return parsed.select("record.*", "corrupt")
    return (
        spark.read.schema(f"{schema}, corrupt STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "corrupt")
        .json(path)
    )


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records as JSON Lines; a missing value leaves its key out."""
    df.write.mode(mode).json(path)
