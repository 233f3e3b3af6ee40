"""Mapping records to training formats. Only the target columns remain after a mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.functions.text import record_completion, record_prompt, sft_text


#: The columns that mappings make, in order.
TARGETS = ["text", "prompt", "chosen", "rejected"]


def to_sft_text(
    df: DataFrame, prompt: str, response: str | None = None, context: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The `text` column of a prompt, a pair, or a pair with context."""
    text = sft_text(
        F.col(prompt),
        F.col(response) if response else None,
        F.col(context) if context and response else None,
    )
    return drop_source_columns(df, keep, text=text)


def to_dpo(
    df: DataFrame, prompt: str, chosen: str, rejected: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    return drop_source_columns(
        df, keep, prompt=F.col(prompt), chosen=F.col(chosen), rejected=F.col(rejected)
    )


def to_grpo(df: DataFrame, prompt: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return drop_source_columns(df, keep, prompt=F.col(prompt))


def to_prompt_completion(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prompt and completion of interview records."""
    return drop_source_columns(
        df,
        keep,
        prompt=record_prompt(F.col("category"), F.col("question")),
        completion=record_completion(F.col("example_answer"), F.col("correctness")),
    )


def drop_source_columns(df: DataFrame, keep: tuple[str, ...] = (), **targets: Column) -> DataFrame:
    """Only the target columns, and the named keys to keep."""
    return df.select(*keep, *[column.alias(name) for name, column in targets.items()])


def full_text(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return drop_source_columns(df, keep, text=F.concat("prompt", "completion"))


def apply_mapping(
    df: DataFrame, spec: DataFrame, method: str, keep: tuple[str, ...] = (), dataset: str | None = None
) -> DataFrame:
    """Apply one dataset's mapping rows for `method`; without rows the data stays as it is.

    `spec` may hold the rows of many datasets; `dataset` names the one to apply and is needed then.
    A target that has several expressions is an error. The rows of one dataset are a few.
    """
    rows = spec.where(F.col("method") == method)
    if dataset is not None:
        rows = rows.where(F.col("dataset") == dataset)
    found = rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min("expression").alias("expression")).collect()
    twice = sorted(row.target for row in found if row.n > 1)
    if twice:
        raise ValueError(f"several expressions for {', '.join(twice)}; name the dataset to apply")
    if not found:
        return df
    made = sorted(found, key=lambda row: TARGETS.index(row.target) if row.target in TARGETS else len(TARGETS))
    return df.select(*keep, *[F.expr(row.expression).alias(row.target) for row in made])
