"""Token arrays: whitespace tokens, padding and label masks as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunewright.constants import IGNORE_LABEL, MAX_LENGTH


def whitespace_tokens(text: Column) -> Column:
    """The runs of non-space characters of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def token_lengths(text: Column) -> Column:
    """Whitespace tokens with the token's length as its id: an id any SQL engine can reproduce."""
    return F.transform(whitespace_tokens(text), lambda token: F.length(token))


def first_token_lengths(text: Column, n: int) -> Column:
    """As `token_lengths`, of the first `n` tokens: the rest of a long text is not split."""
    pieces = F.filter(F.split(text, r"\s+", n + 2), lambda piece: piece != "")
    return F.transform(F.slice(pieces, 1, n), lambda token: F.length(token))


def pad_truncate(ids: Column, max_length: int = MAX_LENGTH, pad=None, eos=0) -> Column:
    """Cut or pad an id array to `max_length`; without a pad id the end-of-text id pads."""
    fill = F.lit(eos if pad is None else pad).cast("int")
    return F.slice(F.concat(ids, F.array_repeat(fill, max_length)), 1, max_length)


def mask_prompt(
    ids: Column, prompt_len: Column, n_tokens: Column | None = None, mask_pad: bool = False
) -> Column:
    """Labels: ids with the prompt positions ignored; pad positions too where `mask_pad`."""

    def label(token, position):
        hidden = position < prompt_len
        if mask_pad:
            hidden = hidden | (position >= n_tokens)
        return F.when(hidden, F.lit(IGNORE_LABEL)).otherwise(token)

    return F.transform(ids, label)
