"""The operators put together: records to tensors, turns to text and a step plan, a growing corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.constants import BATCH_SIZE, BATCH_TARGET, MAX_LENGTH
from tunewright.operators import chat, mapping, split, synth, tokens, validate
from tunewright.plans import sizing
from tunewright.sources import splits

NEEDED = ["category", "question", "example_answer"]


def with_rejects(records: DataFrame, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Complete records, and the others with the names of their missing fields."""
    checked = validate.missing_fields(records, required or NEEDED)
    complete = F.size("missing") == 0
    return checked.where(complete).drop("missing"), checked.where(~complete)


def records_to_tensors(
    records: DataFrame,
    key: str,
    encode: Callable[[Column], Column] | None = None,
    max_length: int = MAX_LENGTH,
    test_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Complete records as padded ids and masked labels with their split. A narrow map: no shuffle."""
    complete, _ = with_rejects(records)
    pairs = mapping.to_prompt_completion(complete, keep=(key,))
    parts = split.train_test_split(pairs, key, test_size, seed)
    return tokens.tokenize_examples(parts, encode, max_length, keep=(key, "split"))


def turns_to_text(
    turns: DataFrame, key: str = "conv_id", test_size: float = 0.1, seed: int = 42, bos: str = ""
) -> DataFrame:
    """Rendered conversations with their split."""
    rendered = chat.render_chat(chat.turns_to_conversation(turns, key), bos=bos)
    return split.train_test_split(rendered, key, test_size, seed)


def training_plan(
    examples: DataFrame, by: str = "split", batch: int = 2, accum: int = 4, epochs: float = 1
) -> DataFrame:
    """Steps and intervals for each group of examples."""
    return sizing.epoch_intervals(sizing.step_plan(examples, by, batch, accum, epochs=epochs))


def grow_corpus(
    spark: SparkSession, base: str, version: str, target: int = BATCH_TARGET, batch: int = BATCH_SIZE,
    seed: int = 42,
) -> int:
    """Write a new version of a stored corpus whose train split reaches `target`; returns the batches.

    All batches are one range, so the corpus is read and written once however many there are. Each
    row carries the number of its `batch`, 0 for the first corpus; new ones go on from the last.
    A version that is complete already is an error.
    """
    if splits.is_complete(spark, base, version):
        raise ValueError(f"version {version} of {base} is complete already")
    old = splits.read_version(spark, base)
    if "batch" not in old.columns:
        old = old.withColumn("batch", F.lit(0).cast("bigint"))
    last = old.agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]
    plan = synth.plan_batches(split.split_counts(old), target=target, batch=batch).first()
    numbers = spark.range(plan["batches"] * batch)
    new = synth.template_batch(numbers, start=plan["train"], batch=batch)
    new = new.withColumn("batch", F.expr(f"id div {batch}") + last + 1).drop("id")
    splits.save_version(synth.merge_batch(old, new, seed=seed), base, version)
    return plan["batches"]
