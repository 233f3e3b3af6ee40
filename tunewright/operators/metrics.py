"""Run metrics `(project, run, grp, step, ts, metric, value)` and checkpoint listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunewright.constants import CHECKPOINT_PATTERN, OVERFIT_RATIO
from tunewright.operators.position import first_rows
from tunewright.operators.ranged import trailing_mean

TRAIN_LOSS = "train_loss"
EVAL_LOSS = "eval_loss"
MICROS = 1_000_000


def last_value(metric: str) -> Column:
    """The metric's value at its highest step, as one aggregate of a run."""
    return F.max_by("value", F.when(F.col("metric") == metric, F.col("step")))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def throughput(metrics: DataFrame, by: str = "run", steps: Column | None = None) -> DataFrame:
    """Steps, seconds, minutes and steps per second of each run."""
    steps = F.max("step") if steps is None else steps
    return (
        metrics.groupBy(by)
        .agg(
            steps.alias("total_steps"),
            ((_micros(F.max("ts")) - _micros(F.min("ts"))) / MICROS).alias("seconds"),
        )
        .withColumn("minutes", F.col("seconds") / 60)
        .withColumn("steps_per_second", F.try_divide("total_steps", "seconds"))
    )


def overfit_check(metrics: DataFrame, by: str = "run", limit: float = OVERFIT_RATIO) -> DataFrame:
    """Ratio of the last eval loss to the last train loss; no verdict if either is missing or zero."""
    usable = (F.col("train_loss") != 0) & (F.col("eval_loss") != 0)
    return (
        metrics.groupBy(by)
        .agg(last_value(TRAIN_LOSS).alias("train_loss"), last_value(EVAL_LOSS).alias("eval_loss"))
        .withColumn("ratio", F.when(usable, F.try_divide("eval_loss", "train_loss")))
        .withColumn("overfitting", F.col("ratio") > limit)
    )


def filter_project(metrics: DataFrame, project: str) -> DataFrame:
    return metrics.where(F.col("project") == project)


def compare_runs(metrics: DataFrame, names: list[str], by: str = "run") -> DataFrame:
    """Runs side by side: one column per metric with its last value. One shuffle."""
    return metrics.groupBy(by).agg(*[last_value(name).alias(name) for name in names])


def group_runs(metrics: DataFrame, metric: str = TRAIN_LOSS) -> DataFrame:
    """Per group label: its runs, and the spread of their last value of one metric."""
    runs = metrics.groupBy("grp", "run").agg(
        last_value(metric).alias("last"), F.count(F.lit(1)).alias("points")
    )
    return runs.groupBy("grp").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("points").alias("points"),
        F.min("last").alias("best"),
        F.max("last").alias("worst"),
        F.avg("last").alias("mean"),
    )


def smooth(
    metrics: DataFrame, k: int, keys: tuple[str, ...] = ("run", "metric"), order: str = "step", value: str = "value"
) -> DataFrame:
    """Add `smoothed`, the mean of the last `k` points of a curve.

    Points are sorted by range over all tasks, however long a curve is; a range starts with the last
    `k - 1` points that the ranges before it leave.
    """
    return trailing_mean(metrics, list(keys), [order, value], value, k, "smoothed")


def checkpoint_step(path: Column) -> Column:
    """N of a path that ends in `checkpoint-N`, null for any other path."""
    number = F.nullif(F.regexp_extract(path, CHECKPOINT_PATTERN, 1), F.lit(""))
    return F.when(F.contains(path, F.lit("checkpoint-")), number.try_cast("bigint"))


def latest_checkpoint(listing: DataFrame, by: str = "run") -> DataFrame:
    """The path of the highest checkpoint of each run, null for a run without one.

    The highest step is found over numbers; its path is met afterwards. Of several paths the greatest counts.
    """
    steps = listing.select(by, "path", checkpoint_step(F.col("path")).alias("step"))
    last = steps.groupBy(by).agg(F.max("step").alias("step"))
    known = steps.where(F.col("step").isNotNull()).alias("s")
    same = F.col(f"l.{by}").eqNullSafe(F.col(f"s.{by}")) & (F.col("l.step") == F.col("s.step"))
    met = last.alias("l").join(known, same, "left").groupBy(F.col(f"l.{by}").alias(by), F.col("l.step").alias("step"))
    return met.agg(F.max("s.path").alias("path")).select(by, "path", "step")


def retained_checkpoints(listing: DataFrame, k: int = 3, by: str = "run") -> DataFrame:
    """The newest `k` checkpoints of each run, found piece by piece and then of the pieces' newest."""
    steps = listing.withColumn("step", checkpoint_step(F.col("path"))).where(F.col("step").isNotNull())
    return first_rows(steps, [by], [F.col("step").desc(), F.col("path").desc()], k, "rank", F.col("step"))
