"""Tokenised training examples: ids, fixed length, label masks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.constants import IGNORE_LABEL, MAX_LENGTH, TURN, TURN_END
from tunewright.functions.text import fill
from tunewright.functions.tokens import first_token_lengths, mask_prompt, pad_truncate, token_lengths
from tunewright.operators.gather import PART_OCTETS, gather, row_octets
from tunewright.operators.infer import tokenize_both


def tokenize_examples(
    df: DataFrame,
    encode: Callable[[Column], Column] | None = None,
    max_length: int = MAX_LENGTH,
    pad=None,
    eos: int = 0,
    mask_pad: bool = False,
    keep: tuple[str, ...] = (),
    load: Callable | None = None,
) -> DataFrame:
    """`input_ids`, `labels` and `attention_mask` of prompt/completion rows, all `max_length` long.

    `encode` maps a text column to an id array: the built-in whitespace form (which reads no further
    than `max_length` tokens), or `infer.tokenize` around a model's tokenizer. The attention mask is
    1 on tokens and 0 on padding, whatever id pads.

    With `load` (see `infer.tokenize_both`) a model's tokenizer runs once per batch: the whole text gets its
    special tokens, and the prompt, whose tokens are not targets, is counted without them.
    """
    counted = _counted(df, encode, load, max_length, keep)
    padded = counted.select(
        *keep,
        pad_truncate(F.col("_ids"), max_length, pad, eos).alias("input_ids"),
        F.col("_prompt_len"),
        F.size("_ids").alias("_n"),
    )
    labels = mask_prompt(F.col("input_ids"), F.col("_prompt_len"), F.col("_n"), mask_pad)
    attention = F.transform("input_ids", lambda _, i: (i < F.col("_n")).cast("int"))
    return padded.select(*keep, "input_ids", labels.alias("labels"), attention.alias("attention_mask"))


def _counted(df, encode, load, max_length, keep) -> DataFrame:
    """(keep, _ids, _prompt_len) by one of the three kinds of encoder."""
    whole, prompt = F.concat("prompt", "completion"), F.col("prompt")
    if load is not None:
        both = df.select(*keep, tokenize_both(prompt, whole, load).alias("_both"))
        return both.select(*keep, F.col("_both.ids").alias("_ids"), F.col("_both.part_len").alias("_prompt_len"))
    encode = encode or (lambda text: first_token_lengths(text, max_length))
    return df.select(*keep, encode(whole).alias("_ids"), F.size(encode(prompt)).alias("_prompt_len"))


def mask_to_responses(
    turns: DataFrame,
    encode: Callable[[Column], Column] = token_lengths,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    octets_per_part: int = PART_OCTETS,
    end: str = TURN_END,
    load: Callable | None = None,
) -> DataFrame:
    """`input_ids` of each rendered conversation, and `labels` that keep only the assistant's tokens.

    What is encoded is the text that `chat.render_chat` gives, turn by turn: markers are tokens too,
    and the mark that ends an assistant's turn is a target, so that a model learns to stop. The
    encoder must not join tokens over a line feed. With `load` a model's tokenizer gives the ids of a
    turn and the length of its head in one call; it should add no special tokens to a turn. Turns are encoded as rows, so any tokenizer fits;
    then they are gathered in turn order, in the parts of `turns_to_conversation`.
    """
    head = fill(TURN, role=F.col(role), content=F.lit(""))
    whole = fill(TURN + end, role=F.col(role), content=F.col(content))
    octets = row_octets(F.col(role), F.col(content)).alias("octets")
    if load is not None:
        both = turns.select(key, turn, F.col(role).alias("_role"), octets, tokenize_both(head, whole, load).alias("_both"))
        ids, head_len = F.col("_both.ids"), F.col("_both.part_len")
        encoded = both.select(key, turn, ids.alias("ids"), F.when(F.col("_role") == "assistant", head_len).alias("target_from"), "octets")
    else:
        head_len = F.when(F.col(role) == "assistant", F.size(encode(head)))
        encoded = turns.select(key, turn, encode(whole).alias("ids"), head_len.alias("target_from"), octets)

    def label(t):
        return F.transform(
            t["ids"], lambda x, i: F.when(i >= t["target_from"], x).otherwise(F.lit(IGNORE_LABEL))
        )

    return gather(encoded, key, turn, ["ids", "target_from"], F.col("octets"), octets_per_part).select(
        key,
        "part",
        "slice",
        F.flatten(F.transform("items", lambda t: t["ids"])).alias("input_ids"),
        F.flatten(F.transform("items", label)).alias("labels"),
    )
