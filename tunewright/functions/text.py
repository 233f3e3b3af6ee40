"""Text expressions: record rendering, chat rendering and cell previews."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.constants import (
    DEFAULT_CORRECTNESS,
    LIST_PREVIEW,
    RECORD_COMPLETION,
    RECORD_PROMPT,
    SFT_CONTEXT_PART,
    SFT_PAIR,
    SFT_PROMPT_PART,
    SFT_RESPONSE_PART,
    TURN,
    TURN_END,
)


def fill(template: str, **columns: Column) -> Column:
    """A text with `{name}` places filled by columns; null where one of them is null."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [
        columns[part].cast("string") if i % 2 else F.lit(part) for i, part in enumerate(parts) if part
    ]
    return F.concat(*pieces)


def sft_text(prompt: Column, response: Column | None = None, context: Column | None = None) -> Column:
    """Training text of a prompt alone, of a pair, or of a pair with optional context."""
    if response is None:
        return prompt
    if context is None:
        return fill(SFT_PAIR, prompt=prompt, response=response)
    given = F.coalesce(context, F.lit("")) != ""
    return F.concat(
        fill(SFT_PROMPT_PART, prompt=prompt),
        F.when(given, fill(SFT_CONTEXT_PART, context=context)).otherwise(F.lit("")),
        fill(SFT_RESPONSE_PART, response=response),
    )


def default_correctness(correctness: Column) -> Column:
    return F.coalesce(correctness, F.lit(DEFAULT_CORRECTNESS))


def record_prompt(category: Column, question: Column) -> Column:
    return fill(RECORD_PROMPT, category=category, question=question)


def record_completion(answer: Column, correctness: Column) -> Column:
    return fill(RECORD_COMPLETION, answer=answer, correctness=default_correctness(correctness))


def render_turns(turns: Column, bos: str = "", end: str = TURN_END) -> Column:
    """Chat text of an array of (role, content), with one leading `bos` removed.

    Null where a turn lacks its role or content.
    """
    rendered = F.transform(
        turns, lambda t: fill(TURN + end, role=t["role"], content=t["content"])
    )
    lacking = F.exists(turns, lambda t: t["role"].isNull() | t["content"].isNull())
    return F.when(~lacking, remove_prefix(F.array_join(rendered, ""), bos))


def remove_prefix(text: Column, prefix: str) -> Column:
    if not prefix:
        return text
    cut = F.substring(text, F.lit(len(prefix) + 1), F.length(text))
    return F.when(F.startswith(text, F.lit(prefix)), cut).otherwise(text)


def clip(text: Column, max_chars: int) -> Column:
    """The text, or its first `max_chars` characters and an ellipsis."""
    return F.when(
        F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))
    ).otherwise(text)


def preview_cell(cell: Column, dtype: T.DataType, max_chars: int = 150) -> Column:
    """A short text for any cell: `None`, a clipped string, or a list's size and keys."""
    if isinstance(dtype, T.StringType):
        shown = clip(cell, max_chars)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        names = "[" + ", ".join(f"'{name}'" for name in dtype.elementType.names) + "]"
        keys = fill(LIST_PREVIEW, count=F.size(cell), keys=F.lit(names))
        shown = F.when(F.size(cell) > 0, keys).otherwise(clip(F.lit("[]"), max_chars))
    else:
        shown = clip(_literal(cell, dtype), max_chars)
    return F.when(cell.isNull(), F.lit("None")).otherwise(shown)


def _literal(cell: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.initcap(cell.cast("string"))
    if isinstance(dtype, T.ArrayType):
        quoted = isinstance(dtype.elementType, T.StringType)

        def item(x):
            text = _literal(x, dtype.elementType)
            if quoted:
                text = F.concat(F.lit("'"), text, F.lit("'"))
            return F.coalesce(text, F.lit("None"))

        return F.concat(F.lit("["), F.array_join(F.transform(cell, item), ", "), F.lit("]"))
    if isinstance(dtype, (T.StructType, T.MapType)):
        return F.to_json(cell, {"ignoreNullFields": "false"})
    return cell.cast("string")
