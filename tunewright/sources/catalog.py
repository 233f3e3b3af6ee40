"""Configurations, splits and pages of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright.operators.position import TOP_ROWS, first_by
from tunewright.operators.ranged import with_position


def page_rows(df: DataFrame, order: str, offset: int = 0, length: int = 5) -> DataFrame:
    """A page of rows in `order`. Deep pages need no global sort by one task."""
    if offset + length <= TOP_ROWS:
        return first_by(df, order, offset, length)
    numbered = with_position(df, [], order, "_position")
    inside = (F.col("_position") > offset) & (F.col("_position") <= offset + length)
    return numbered.where(inside).drop("_position")


def split_catalog(df: DataFrame, config: str = "config", split: str = "split") -> DataFrame:
    """Rows per configuration and split."""
    return df.groupBy(F.col(config).alias("config"), F.col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("num_examples")
    )


def choose_config(catalog: DataFrame, config: str = "default", split: str = "train") -> DataFrame:
    """The asked configuration and split, or the first configuration by name if that pair is absent."""
    asked = (F.col("config") == config) & (F.col("split") == split)
    chosen = F.coalesce(F.max(F.when(asked, F.col("config"))), F.min("config"))
    return catalog.agg(
        chosen.alias("config"),
        F.lit(split).alias("split"),
        F.bool_or(asked).alias("found"),
    )


def distinct_configs(df: DataFrame, config: str = "config") -> DataFrame:
    return df.select(F.col(config).alias("config")).distinct()
