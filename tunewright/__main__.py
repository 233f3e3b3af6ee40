"""Command line: `spark-submit` or `python -m tunewright <command> ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright import constants
from tunewright.operators import inspect as inspection
from tunewright.operators import mapping, split, synth, validate
from tunewright.plans import flows, sizing
from tunewright.session import build_session
from tunewright.sources import records, splits


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tunewright")
    commands = parser.add_subparsers(dest="command", required=True)

    one = commands.add_parser("inspect", help="which training formats a dataset fits")
    one.add_argument("dataset", help="a table, or a Parquet path")
    one.add_argument("--order", help="column that says which row is first; default the first column")
    one.add_argument("--config", default="default")
    one.add_argument("--split", default="train")
    one.add_argument("--preview", type=int, default=150)
    one.add_argument("--json", action="store_true")

    one = commands.add_parser("validate", help="required keys of JSON records")
    one.add_argument("path")
    one.add_argument("--array", action="store_true", help="files hold one JSON array each")
    one.add_argument("--report", help="write every entry's result here as Parquet")

    one = commands.add_parser("preprocess", help="records to prompt/completion with a split")
    one.add_argument("path")
    one.add_argument("out")
    one.add_argument("--array", action="store_true")
    one.add_argument("--rejects", help="write incomplete records here as JSON")
    one.add_argument("--test-size", type=float, default=0.1)
    one.add_argument("--seed", type=int, default=42)

    one = commands.add_parser("generate", help="generated records, categories in turn")
    one.add_argument("out")
    one.add_argument("--count", type=int, default=100)
    one.add_argument("--seed", type=int, default=42)

    one = commands.add_parser("top-up", help="records plus generated ones up to a target")
    one.add_argument("path")
    one.add_argument("out")
    one.add_argument("--array", action="store_true")
    one.add_argument("--target", type=int, default=constants.TOP_UP_TARGET)
    one.add_argument("--seed", type=int, default=42)

    one = commands.add_parser("grow", help="a new version of a stored corpus, batches added")
    one.add_argument("base")
    one.add_argument("version")
    one.add_argument("--target", type=int, default=constants.BATCH_TARGET)
    one.add_argument("--batch", type=int, default=constants.BATCH_SIZE)

    one = commands.add_parser("estimate", help="hours and cost of a training job")
    one.add_argument("--model", required=True)
    one.add_argument("--dataset", required=True, help="a name, or a Parquet path that is counted")
    one.add_argument("--hardware", required=True)
    one.add_argument("--dataset-size", type=int)
    one.add_argument("--epochs", type=int, default=3)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Do the command; the result is a small table that says what was done."""
    return {
        "inspect": inspect, "validate": check, "preprocess": preprocess, "generate": generate,
        "top-up": top_up, "grow": grow, "estimate": estimate,
    }[args.command](spark, args)


def inspect(spark, args):
    df = splits.load_dataset(spark, args.dataset)
    order = args.order or df.columns[0]
    if {"config", "split"} <= set(df.columns):
        report = inspection.inspect_split(
            spark, df, args.dataset, order, args.config, args.split, max_chars=args.preview
        )
    else:
        if "split" in df.columns:
            df = df.where(F.col("split") == args.split).drop("split")
        report = inspection.inspect(
            spark, df, args.dataset, order, args.config, args.split, args.preview
        )
    return inspection.report_json(report) if args.json else inspection.report_text(report)


def check(spark, args):
    if args.report:
        raw = records.read_raw(spark, args.path, args.array, numbered=True)
        validate.validation_report(raw, "entry", raw="raw").write.parquet(args.report)
    raw = records.read_raw(spark, args.path, args.array).withColumn("entry", F.lit(0))
    return validate.validation_summary(validate.validation_report(raw, "entry", raw="raw"))


def preprocess(spark, args):
    """Complete records to a split dataset; malformed and incomplete ones are counted, and kept as raw text if asked."""
    read = records.read_with_rejects(spark, args.path, array=args.array)
    checked = validate.missing_fields(read, flows.NEEDED)
    complete = F.col("corrupt").isNull() & (F.size("missing") == 0)
    pairs = mapping.to_prompt_completion(checked.where(complete))
    splits.write_split(
        split.train_test_split(pairs, "prompt", args.test_size, args.seed), args.out
    )
    whole = [c for c in read.columns if c != "corrupt"]
    rejects = checked.where(~complete).select(
        F.coalesce("corrupt", F.to_json(F.struct(*whole))).alias("raw"),
        F.col("corrupt").isNotNull().alias("malformed"),
        "missing",
    )
    if args.rejects:
        records.write_records(rejects, args.rejects)
    counts = split.split_counts(splits.read_split(spark, args.out)).first()
    return spark.range(1).select(
        F.lit(counts.train).alias("train"), F.lit(counts.test).alias("test"),
        F.lit(rejects.count()).alias("rejected"),
    )


def generate(spark, args):
    made = synth.generate_round_robin(spark.range(args.count), seed=args.seed).drop("id")
    records.write_records(made, args.out)
    return _written(spark, args.out)


def top_up(spark, args):
    existing = records.read_records(spark, args.path, array=args.array)
    records.write_records(synth.top_up(existing, args.target, args.seed), args.out)
    return _written(spark, args.out)


def grow(spark, args):
    flows.grow_corpus(spark, args.base, args.version, args.target, args.batch)
    return split.split_counts(splits.read_version(spark, args.base))


def estimate(spark, args):
    size = args.dataset_size
    if size is None and "/" in args.dataset and args.dataset not in constants.KNOWN_DATASET_SIZES:
        size = splits.load_dataset(spark, args.dataset).count()
    job = spark.range(1).select(
        F.lit(args.model).alias("model"),
        F.lit(args.dataset).alias("dataset"),
        F.lit(args.hardware).alias("flavor"),
        F.lit(size).cast("bigint").alias("dataset_size"),
        F.lit(args.epochs).alias("epochs"),
        sizing.model_size(F.lit(args.model)).alias("params"),
    )
    rated = sizing.lookup_size(sizing.lookup_hardware(job, sizing.hardware_table(spark)))
    return sizing.cost_warnings(sizing.job_report(rated)).select(
        "model", "params", "dataset", "examples", "flavor", "epochs", "hours", "cost",
        "timeout_hours", "long_warning", "large_model_warning",
    )


def _written(spark, path):
    return records.read_records(spark, path).agg(F.count(F.lit(1)).alias("records"))


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    done = run(build_session(), args)
    if done.columns == ["dataset", "report"]:
        for row in done.toLocalIterator():
            print(row.report)
    else:
        done.show(truncate=False)


if __name__ == "__main__":
    main()
