"""Synthetic records, corpus top-ups, template batches and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunewright.constants import (
    ANSWERS,
    BATCH_SIZE,
    BATCH_TARGET,
    CATEGORIES,
    CODE_PROMPT,
    CODE_TEMPLATES,
    DEFAULT_CORRECTNESS,
    DOCSTRING_LINE,
    FALLBACK_ANSWER,
    QUESTION_POOL,
    RUBRIC,
    SYNTHETIC_ANSWER,
    SYNTHETIC_QUESTION,
    TOP_UP_TARGET,
    TOPICS,
    TYPED_SIGNATURE,
    UNTYPED_SIGNATURE,
)
from tunewright.functions.draws import draw32, pick
from tunewright.functions.text import fill
from tunewright.operators.split import train_test_split


def _strings(items: list[str]) -> Column:
    return F.array(*[F.lit(item) for item in items])


def rubric() -> Column:
    return F.array(
        *[F.struct(F.lit(a).alias("aspect"), F.lit(w).alias("weight")) for a, w in RUBRIC]
    )


def attach_rubric(df: DataFrame) -> DataFrame:
    return df.withColumn("evaluation_criteria", rubric())


def example_answer(category: Column, question: Column) -> Column:
    """The answer text of a question, by its category."""
    known = [F.when(category == c, fill(text, question=question)) for c, text in ANSWERS.items()]
    return F.coalesce(*known, F.lit(FALLBACK_ANSWER))


def generate_round_robin(ids: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """One record per 0-based number in `key`: categories in turn, a drawn question of each.

    Pools are constants inside the expression, so this is a narrow map of any number of rows.
    """
    category = F.element_at(
        _strings(CATEGORIES), F.pmod(F.col(key), F.lit(len(CATEGORIES))).cast("int") + 1
    )
    pools = F.array(*[_strings(QUESTION_POOL[name]) for name in CATEGORIES])
    pool = F.element_at(pools, F.pmod(F.col(key), F.lit(len(CATEGORIES))).cast("int") + 1)
    draw = F.pmod(draw32(seed, F.col(key)), F.size(pool)).cast("int") + 1
    return (
        ids.select(key, category.alias("category"), F.element_at(pool, draw).alias("question"))
        .withColumn("example_answer", example_answer(F.col("category"), F.col("question")))
        .transform(attach_rubric)
        .withColumn("correctness", F.lit(DEFAULT_CORRECTNESS))
    )


def synthetic_rows(numbers: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """A record without `correctness` for every number in `key`."""
    category = pick(CATEGORIES, f"{seed}:category", F.col(key))
    topic = pick(TOPICS, f"{seed}:topic", F.col(key))
    return (
        numbers.select(key, category.alias("category"), topic.alias("_topic"))
        .withColumn(
            "question",
            fill(
                SYNTHETIC_QUESTION,
                number=F.col(key), category=F.col("category"), topic=F.col("_topic"),
            ),
        )
        .withColumn("example_answer", fill(SYNTHETIC_ANSWER, category=F.col("category")))
        .drop("_topic")
        .transform(attach_rubric)
    )


def top_up(
    existing: DataFrame, target: int = TOP_UP_TARGET, seed: int = 42, count: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """Append generated rows until the corpus has `target`, numbered `count + 1 .. target`.

    The count is one number (counted here unless given), so that the new rows are a parallel range.
    `number` keeps the new rows' numbers in that column; existing rows have their own or null.
    """
    count = existing.count() if count is None else count
    new = synthetic_rows(
        existing.sparkSession.range(count + 1, max(count, target) + 1).withColumnRenamed(
            "id", number or "id"
        ),
        number or "id",
        seed,
    )
    if number is None:
        new = new.drop("id")
    return existing.unionByName(new, allowMissingColumns=True)


def template_batch(ids: DataFrame, start: int, key: str = "id", batch: int | None = None) -> DataFrame:
    """A code example per 0-based number `k` in `key`, called example `start + k + 1`.

    Templates are taken in turn; with `batch` they begin anew in every batch of that size.
    """
    k = F.col(key)
    turn = F.pmod(k, F.lit(batch)) if batch else k
    which = F.pmod(turn, F.lit(len(CODE_TEMPLATES))).cast("int") + 1
    number = k + F.lit(start) + 1
    solution = F.element_at(_strings([s for _, s in CODE_TEMPLATES]), which)
    problem = F.element_at(_strings([p for p, _ in CODE_TEMPLATES]), which)
    typed = F.replace(solution, F.lit(UNTYPED_SIGNATURE), F.lit(TYPED_SIGNATURE))
    completion = (
        F.when(F.pmod(number, F.lit(5)) == 0, typed)
        .when(F.pmod(number, F.lit(7)) == 0, F.concat(F.lit(DOCSTRING_LINE), solution))
        .otherwise(solution)
    )
    prompt = fill(CODE_PROMPT, problem=problem, number=number)
    return ids.select(key, prompt.alias("prompt"), completion.alias("completion"))


def plan_batches(
    counts: DataFrame, count: str = "train", target=BATCH_TARGET, batch: int = BATCH_SIZE
) -> DataFrame:
    """Batches needed to reach `target` (a number or a column), and the size they lead to."""
    goal = target if isinstance(target, Column) else F.lit(target)
    short = F.greatest(F.lit(0).cast("bigint"), goal.cast("bigint") - F.col(count))
    planned = counts.withColumn("remaining", short).withColumn(
        "batches", F.expr(f"(remaining + {batch - 1}) div {batch}")
    )
    return planned.withColumn("final_count", F.col(count) + F.col("batches") * batch)


def merge_batch(
    old: DataFrame | None, batch: DataFrame, key: str | None = None, test_size: float = 0.1,
    seed: int = 42, leak_compat: bool = False,
) -> DataFrame:
    """Append a batch to train and leave test as it is; duplicates stay.

    Without old data the batch itself is split by `key`, so that no row is in both;
    `leak_compat=True` puts the whole batch in train and in test.
    """
    train = batch.withColumn("split", F.lit("train"))
    if old is not None:
        return old.unionByName(train, allowMissingColumns=True)
    if leak_compat:
        return train.unionByName(batch.withColumn("split", F.lit("test")))
    return train_test_split(batch, key, test_size, seed)


def concat(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, duplicates kept."""
    return first.unionByName(second)
