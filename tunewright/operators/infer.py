"""Prompts in batch through a user's tokenizer or model."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunewright.constants import MAX_NEW_TOKENS, TEMPERATURE

_loaded: dict = {}
#: Loaded objects that a worker keeps.
KEPT = 4


def load_once(key: str, load: Callable):
    """The object that `load` makes, made once in a Python worker; a failure is remembered as well."""
    if key not in _loaded:
        while len(_loaded) >= KEPT:  # a worker outlives queries
            del _loaded[next(iter(_loaded))]
        try:
            _loaded[key] = load(), None
        except Exception as problem:
            _loaded[key] = None, problem
    made, problem = _loaded[key]
    if problem is not None:
        raise problem
    return made


def loader_key() -> str:
    """A key of its own for every loader that an operator is given, as workers outlive queries."""
    return uuid.uuid4().hex


def tokenize(text: Column, load: Callable) -> Column:
    """Token ids of a text column; `load()` returns a function from a list of texts to id lists."""
    name = loader_key()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_once(name, load)
        for texts in batches:
            known = texts.notna()
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if known.any():
                out[known] = pd.Series(
                    list(encode(texts[known].tolist())), index=texts.index[known], dtype=object
                )
            yield out

    return ids(text)


def tokenize_both(part: Column, text: Column, load: Callable) -> Column:
    """`ids` of a text and `part_len`, the number of tokens of a part of it, from one call of Python per batch.

    `load()` returns a function of a list of texts and `add_special_tokens`. The text gets the special
    tokens that the tokenizer adds, the part none. A null text has no ids; a null part counts as empty.
    """
    name = loader_key()

    @F.pandas_udf("ids ARRAY<INT>, part_len INT")
    def both(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encode = load_once(name, load)
        for parts, texts in batches:
            known = texts.notna()
            ids = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if known.any():
                ids[known] = pd.Series(list(encode(texts[known].tolist(), True)), index=texts.index[known], dtype=object)
            counts = [len(p) for p in encode(parts.fillna("").tolist(), False)] if len(parts) else []
            yield pd.DataFrame({"ids": ids, "part_len": pd.Series(counts, index=texts.index, dtype="int32")})

    return both(part, text)


def map_rows(df: DataFrame, **targets: Column) -> DataFrame:
    """A row map given as expressions; only the targets remain."""
    return df.select(*[column.alias(name) for name, column in targets.items()])


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """A map over column batches, for a function no expression can state."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(apply, schema)


def prepare_requests(df: DataFrame) -> DataFrame:
    """Defaults and checks of requests `(id, prompt[, max_new_tokens, temperature])`."""
    given = df.columns
    tokens = F.col("max_new_tokens") if "max_new_tokens" in given else F.lit(None)
    heat = F.col("temperature") if "temperature" in given else F.lit(None)
    return (
        df.withColumn("max_new_tokens", F.coalesce(tokens.cast("int"), F.lit(MAX_NEW_TOKENS)))
        .withColumn("temperature", F.coalesce(heat.cast("double"), F.lit(TEMPERATURE)))
        .withColumn("do_sample", F.col("temperature") > 0)
        .withColumn(
            "error", F.when(F.coalesce("prompt", F.lit("")) == "", F.lit("missing prompt"))
        )
    )


GENERATED = "id BIGINT, generated STRING, error STRING, detail STRING"


def batch_generate(requests: DataFrame, load: Callable, generate: Callable, batch: int = 64) -> DataFrame:
    """Run prepared requests through a model; any failure becomes a row with an error.

    `load()` makes the model, once per worker. `generate(model, prompts, max_new_tokens, temperature,
    do_sample)` returns a text for each prompt of a list; the list has prompts of the same settings,
    at most `batch`. Where a list fails its prompts are tried one by one.
    """
    name = loader_key()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            out = []
            bad = some["error"].notna()
            out += [(row.id, None, row.error, None) for row in some[bad].itertuples(index=False)]
            good = some[~bad]
            for settings, rows in good.groupby(["max_new_tokens", "temperature", "do_sample"], sort=False):
                for at in range(0, len(rows), batch):
                    part = rows.iloc[at : at + batch]
                    out += answers(part["id"].tolist(), part["prompt"].tolist(), settings)
            yield pd.DataFrame(out, columns=["id", "generated", "error", "detail"])

    def answers(ids, prompts, settings):
        try:
            model = load_once(name, load)
        except Exception as problem:
            return [(i, None, "model not loaded", str(problem)) for i in ids]
        try:
            texts = list(generate(model, prompts, *settings))
            if len(texts) != len(prompts):
                raise ValueError(f"{len(texts)} texts for {len(prompts)} prompts")
            return [(i, text, None, None) for i, text in zip(ids, texts)]
        except Exception as problem:
            if len(ids) == 1:
                return [(ids[0], None, "generation_failed", str(problem))]
            return [row for i, prompt in zip(ids, prompts) for row in answers([i], [prompt], settings)]

    columns = ["id", "prompt", "max_new_tokens", "temperature", "do_sample", "error"]
    return requests.select(*columns).mapInPandas(run, GENERATED)
