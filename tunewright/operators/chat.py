"""Conversations: from rows per turn to arrays, a standard form, and rendered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.constants import CONVERSATION_COLUMNS, ROLE_NAMES, TURN_END
from tunewright.functions.text import render_turns
from tunewright.operators.gather import PART_OCTETS, gather, row_octets


def turns_to_conversation(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    octets_per_part: int = PART_OCTETS,
) -> DataFrame:
    """One array of (role, content) per conversation, in turn order.

    A conversation of more octets than `octets_per_part` becomes several rows, in order by part, so that
    one with a large share of all turns is never one row or one task. Where it is cut depends on
    its own turns only.
    """
    named = turns.select(
        key, turn, F.col(role).alias("role"), F.col(content).alias("content")
    )
    octets = row_octets(F.col("role"), F.col("content"))
    return gather(named, key, turn, ["role", "content"], octets, octets_per_part).withColumnRenamed("items", "conversations")


def normalize_conversation_column(df: DataFrame) -> DataFrame:
    """Rename the first list-valued conversation column to `conversations`, in place of one so named."""
    for name in CONVERSATION_COLUMNS:
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType):
            if name == "conversations":
                return df
            return df.drop("conversations").withColumnRenamed(name, "conversations")
    return df


def standardize_turns(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Bring (from, value) turns to (role, content); (role, content) turns stay as they are."""
    fields = df.schema[column].dataType.elementType.names

    def either(t: Column, *names: str) -> Column:
        present = [t[name] for name in names if name in fields]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    def standard(t: Column) -> Column:
        speaker = either(t, "role", "from")
        known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
        return F.struct(
            F.coalesce(F.element_at(known, speaker), speaker).alias("role"),
            either(t, "content", "value").alias("content"),
        )

    return df.withColumn(column, F.transform(column, standard))


def render_chat(
    df: DataFrame, column: str = "conversations", bos: str = "", end: str = TURN_END
) -> DataFrame:
    """Replace the conversation column by its rendered `text`."""
    return df.withColumn("text", render_turns(F.col(column), bos, end)).drop(column)
