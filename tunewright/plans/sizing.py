"""Step plans, training hours, cost and memory of corpora and models.

Constant tables are arrays inside the expressions: a lookup is a narrow map, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.constants import (
    DEFAULT_DATASET_SIZE,
    DEFAULT_SIZE,
    GB_PER_BILLION,
    HARDWARE,
    HOURS_PER_1K,
    KNOWN_DATASET_SIZES,
    LARGE_MODEL_FLAVORS,
    LARGE_MODEL_PARAMS,
    LONG_HOURS,
    NAMED_SIZES,
    SIZE_BANDS,
    TIMEOUT_FACTOR,
)


def hardware_table(spark: SparkSession) -> DataFrame:
    """The constant hardware table, nine rows."""
    return spark.range(1).select(F.inline(_hardware()))


def _hardware() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(flavor).alias("flavor"),
                F.lit(rate).cast("double").alias("usd_per_hour"),
                F.lit(mult).cast("double").alias("mult"),
                F.lit(mem).alias("mem_gb"),
            )
            for flavor, rate, mult, mem in HARDWARE
        ]
    )


def lookup_hardware(jobs: DataFrame, hardware: DataFrame) -> DataFrame:
    """Add rate and time multiplier by flavour; jobs of a flavour without a rate are left out."""
    rated = hardware.where(F.col("usd_per_hour").isNotNull()).select(
        "flavor", "usd_per_hour", F.coalesce("mult", F.lit(1.0)).alias("mult")
    )
    return jobs.join(rated, "flavor")


#: A table of sizes of at most so many rows is broadcast; of more, jobs meet it in salted shuffles.
FEW_DATASETS = 100_000
#: Jobs of one dataset that one task of a shuffle takes.
JOBS_PER_SALT = 500_000


def lookup_size(
    jobs: DataFrame, sizes: DataFrame | None = None, explicit: str = "dataset_size"
) -> DataFrame:
    """Add `examples`: the job's own size, else the dataset's known size, else 10,000.

    `sizes(dataset, num_examples)` holds counted corpora, one row per dataset. Its rows are counted
    first. A small table goes to the jobs, which are not shuffled. A large one is met by dataset
    and salt: a dataset with more jobs than one task should take is repeated for each of its salts, and
    its jobs are dealt to them.
    """
    known = F.lit(None).cast("bigint")
    for name, size in KNOWN_DATASET_SIZES.items():
        known = F.when(F.col("dataset") == name, F.lit(size).cast("bigint")).otherwise(known)
    counted = F.lit(None).cast("bigint")
    columns = jobs.columns
    if sizes is not None:
        jobs = _sized(jobs, sizes.select("dataset", F.col("num_examples").alias("_counted")))
        counted = F.col("_counted")
    examples = F.coalesce(
        F.col(explicit).cast("bigint"), counted, known, F.lit(DEFAULT_DATASET_SIZE).cast("bigint")
    )
    return jobs.select(*[c for c in columns if c != "examples"], examples.alias("examples"))


def _sized(jobs: DataFrame, sizes: DataFrame) -> DataFrame:
    if sizes.limit(FEW_DATASETS + 1).count() <= FEW_DATASETS:
        return jobs.join(F.broadcast(sizes), "dataset", "left")
    # few datasets can have so many jobs: the list of them is as long as all jobs / JOBS_PER_SALT at most
    busy = jobs.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > JOBS_PER_SALT)
    busy = F.broadcast(busy.select("dataset", F.ceil(F.col("n") / JOBS_PER_SALT).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    salts_or_any = F.when(F.col("dataset").isNull(), F.lit(1 << 20)).otherwise(salts)  # a null meets nothing, wherever it goes
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts_or_any).cast("int")
    dealt = jobs.join(busy, "dataset", "left").withColumn("_salt", salt).drop("_salts")
    repeated = sizes.join(busy, "dataset", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(repeated, ["dataset", "_salt"], "left").drop("_salt")


def model_size(name: Column, compat: bool = False) -> Column:
    """Billions of parameters said in a model name.

    By default the first number before a `B`. `compat=True` looks for five known sizes as
    substrings in turn (so `13B` is 3), then reads the name itself as a number.
    """
    if not compat:
        said = F.regexp_extract(name, r"(?<![0-9.])([0-9]+(?:\.[0-9]+)?)B(?![a-z])", 1)
        return F.coalesce(F.nullif(said, F.lit("")).try_cast("double"), F.lit(DEFAULT_SIZE))
    bare = F.replace(name, F.lit("B"), F.lit(""))
    number = F.rlike(bare, F.lit(r"^[-+]?[0-9.]+$")) & F.contains(name, F.lit("B"))
    found = F.when(number, bare.try_cast("double"))
    size = F.coalesce(found, F.lit(DEFAULT_SIZE))
    for text, billions in reversed(NAMED_SIZES):
        size = F.when(F.contains(name, F.lit(text)), F.lit(billions)).otherwise(size)
    return size


def train_hours(params: Column, examples: Column, epochs, multiplier: Column) -> Column:
    epochs = epochs if isinstance(epochs, Column) else F.lit(epochs)
    return F.lit(HOURS_PER_1K) * params * (examples / 1000) * epochs * multiplier


def job_report(jobs: DataFrame) -> DataFrame:
    """Hours, cost and timeout of jobs with `params`, `examples`, `epochs`, `mult`, `usd_per_hour`."""
    hours = train_hours(F.col("params"), F.col("examples"), F.col("epochs"), F.col("mult"))
    return (
        jobs.withColumn("hours", hours)
        .withColumn("cost", F.col("hours") * F.col("usd_per_hour"))
        .withColumn("timeout_hours", F.col("hours") * TIMEOUT_FACTOR)
    )


def cost_report(corpora: DataFrame, by: str, model: str, epochs: int = 3, compat: bool = False) -> DataFrame:
    """Hours, cost and timeout per corpus and rated flavour, from the corpora's row counts."""
    counted = corpora.groupBy(F.col(by).alias("dataset")).agg(F.count(F.lit(1)).alias("examples"))
    rated = F.filter(_hardware(), lambda h: h["usd_per_hour"].isNotNull())
    jobs = counted.select("dataset", "examples", F.inline(rated)).select(
        "dataset",
        "examples",
        "flavor",
        "usd_per_hour",
        F.coalesce("mult", F.lit(1.0)).alias("mult"),
        model_size(F.lit(model), compat).alias("params"),
        F.lit(epochs).alias("epochs"),
    )
    return job_report(jobs)


def cost_warnings(report: DataFrame) -> DataFrame:
    """Add flags for long jobs and for large models on small hardware."""
    return report.withColumn("long_warning", F.col("hours") > LONG_HOURS).withColumn(
        "large_model_warning",
        (F.col("params") >= LARGE_MODEL_PARAMS) & ~F.col("flavor").isin(LARGE_MODEL_FLAVORS),
    )


def memory_fit(models: DataFrame, params: str = "params", tuning: str = "full") -> DataFrame:
    """Memory a model needs, and the smallest flavour that has it (null if none has)."""
    need = F.col(params) * F.lit(float(GB_PER_BILLION[tuning]))
    choice = F.array_min(
        F.transform(
            F.filter(_hardware(), lambda h: h["mem_gb"] >= need),
            lambda h: F.struct(
                h["mem_gb"], F.coalesce(h["usd_per_hour"], F.lit(float("inf"))).alias("rate"), h["flavor"]
            ),
        )
    )
    return models.withColumn("need_gb", need).withColumn("fits", choice["flavor"])


def flavor_tier(models: DataFrame, params: str = "params") -> DataFrame:
    """The flavour of the size band a model is in."""
    tier = F.lit(None).cast("string")
    for low, high, flavor in SIZE_BANDS:
        inside = F.col(params) >= low
        if high is not None:
            inside = inside & (F.col(params) < high)
        tier = F.when(inside, F.lit(flavor)).otherwise(tier)
    return models.withColumn("tier", tier)


def step_plan(
    corpora: DataFrame, by: str | list[str], batch: int = 2, accum: int = 4, gpus: int = 1,
    epochs: float = 1,
) -> DataFrame:
    """Effective batch, steps per epoch and total steps of every corpus."""
    by = [by] if isinstance(by, str) else by
    effective = batch * accum * gpus
    return (
        corpora.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("examples"))
        .withColumn("effective_batch", F.lit(effective))
        .withColumn("steps_per_epoch", F.expr(f"examples div {effective}"))
        .withColumn("total_steps", (F.col("steps_per_epoch") * F.lit(epochs)).cast("bigint"))
    )


def _at_least_one(column: str, divisor: int) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.expr(f"`{column}` div {divisor}"))


def epoch_intervals(plan: DataFrame, steps: str = "steps_per_epoch") -> DataFrame:
    """Steps between log lines and between saves when training runs for epochs."""
    return plan.withColumn("log_steps", _at_least_one(steps, 10)).withColumn(
        "save_steps", _at_least_one(steps, 4)
    )


def step_intervals(plan: DataFrame, max_steps: str = "max_steps") -> DataFrame:
    """Steps between log lines, saves and evaluations when training runs for `max_steps`."""
    return (
        plan.withColumn("log_steps", _at_least_one(max_steps, 20))
        .withColumn("save_steps", _at_least_one(max_steps, 4))
        .withColumn("eval_steps", _at_least_one(max_steps, 5))
    )
