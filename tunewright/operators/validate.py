"""Validation: missing fields, reports and malformed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.constants import ENTRY_MISSING, ENTRY_VALID, REQUIRED_FIELDS
from tunewright.functions.text import fill


def missing_keys(raw: Column, required: list[str] = REQUIRED_FIELDS) -> Column:
    """Required keys a raw JSON object lacks, sorted. A key with a null value is present."""
    wanted = F.array(*[F.lit(name) for name in required])
    return F.array_sort(F.array_except(wanted, F.json_object_keys(raw)))


def missing_columns(required: list[str] = REQUIRED_FIELDS) -> Column:
    """Required columns that are null in a typed row, sorted."""
    absent = [F.when(F.col(name).isNull(), F.lit(name)) for name in sorted(required)]
    return F.array_compact(F.array(*absent))


def missing_fields(
    df: DataFrame, required: list[str] = REQUIRED_FIELDS, raw: str | None = None
) -> DataFrame:
    """Add `missing`, from the raw JSON column if one is named, else from the typed columns."""
    return df.withColumn(
        "missing", missing_keys(F.col(raw), required) if raw else missing_columns(required)
    )


def validation_report(
    df: DataFrame, entry: str, required: list[str] = REQUIRED_FIELDS, raw: str | None = None
) -> DataFrame:
    """Per entry: the missing fields, a status and a message."""
    names = F.array_join("missing", ", ")
    ok = F.size("missing") == 0
    number = F.col(entry)
    return missing_fields(df, required, raw).select(
        F.col(entry),
        names.alias("missing"),
        F.when(ok, F.lit("valid")).otherwise(F.lit("missing")).alias("status"),
        F.when(ok, fill(ENTRY_VALID, entry=number))
        .otherwise(fill(ENTRY_MISSING, entry=number, missing=names))
        .alias("message"),
    )


def validation_summary(report: DataFrame) -> DataFrame:
    """Entries per combination of missing fields."""
    return report.groupBy("status", "missing").agg(F.count(F.lit(1)).alias("entries"))


def parse_records(df: DataFrame, schema: str, raw: str = "raw") -> DataFrame:
    """Parse a raw JSON column into `record`, with the malformed text in `corrupt`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    parsed = df.withColumn(
        "record", F.from_json(F.col(raw), f"{schema}, corrupt STRING", options)
    ).withColumn("corrupt", F.col("record.corrupt"))
    return parsed.withColumn("record", F.col("record").dropFields("corrupt"))


def corrupt_rows(df: DataFrame, schema: str, raw: str = "raw") -> DataFrame:
    """The side table of malformed records."""
    return parse_records(df, schema, raw).where(F.col("corrupt").isNotNull()).drop("record")
