"""Generated rows, merges, step plans, cost and memory."""

import json

import pytest
from pyspark.sql import functions as F

from tunewright import constants
from tunewright.operators import synth
from tunewright.plans import sizing
from tunewright.session import setting


def test_round_robin(spark):
    rows = synth.generate_round_robin(spark.range(70)).orderBy("id").collect()
    assert [r.category for r in rows[:8]] == [
        "HTML", "CSS", "JavaScript", "Node.js", "Express", "React", "MySQL", "HTML",
    ]
    assert all(r.question in constants.QUESTION_POOL[r.category] for r in rows)
    assert [tuple(c) for c in rows[0].evaluation_criteria] == constants.RUBRIC
    assert rows[1].example_answer == "CSS snippet: /* example CSS */\n" + rows[1].question
    assert rows[6].example_answer == "SQL Example: -- example query for " + rows[6].question
    again = synth.generate_round_robin(spark.range(70).repartition(5)).orderBy("id").collect()
    assert again == rows
    assert synth.generate_round_robin(spark.range(70), seed=1).orderBy("id").collect() != rows


def test_unknown_category_has_the_fallback_answer(spark):
    row = spark.range(1).select(synth.example_answer(F.lit("Go"), F.lit("q")).alias("a")).first()
    assert row.a == "Example answer"


def test_top_up(spark):
    old = synth.generate_round_robin(spark.range(100)).drop("id")
    full = synth.top_up(old, 5000)
    assert full.count() == 5000
    new = full.where(F.col("correctness").isNull())
    numbers = new.select(F.regexp_extract("question", r"Question (\d+) for", 1).cast("int").alias("n"))
    assert tuple(numbers.agg(F.count("*"), F.min("n"), F.max("n")).first()) == (4900, 101, 5000)
    topics = {r.question.split(": ")[1] for r in new.collect()}
    assert topics == set(constants.TOPICS)
    assert synth.top_up(synth.generate_round_robin(spark.range(60)).drop("id"), 50).count() == 60


def _examples(spark, start, n):
    rows = synth.template_batch(spark.range(n), start).orderBy("id").collect()
    return {start + r.id + 1: r for r in rows}


def test_template_batch(spark):
    at_90 = _examples(spark, 90, 30)
    assert at_90[91].completion.startswith('"""Simple implementation"""\ndef add(a, b):')
    assert at_90[91].prompt == (
        "### Problem: Write a Python function to add two numbers (example 91)\n### Solution:\n"
    )
    # multiples of five meet templates without the signature: no hints
    assert at_90[95].completion == constants.CODE_TEMPLATES[4][1]
    assert at_90[105].completion == constants.CODE_TEMPLATES[4][1]
    at_3 = _examples(spark, 3, 5)
    assert at_3[5].completion.startswith("def sub(a: int, b: int) -> int:")


@pytest.mark.parametrize("count, batches, final", [(90, 5, 590), (500, 0, 500), (401, 1, 501), (900, 0, 900)])
def test_plan_batches(spark, count, batches, final):
    counts = spark.range(1).select(F.lit(count).cast("bigint").alias("train"))
    row = synth.plan_batches(counts).first()
    assert (row.batches, row.final_count) == (batches, final)


def test_merge_leaves_test_as_it_is(spark):
    old = spark.range(20).selectExpr("id", "if(id < 15, 'train', 'test') AS split")
    merged = synth.merge_batch(old, spark.range(15, 25))
    assert merged.where("split = 'test'").count() == 5
    assert merged.where("split = 'train'").count() == 25  # duplicates stay


def test_first_batch_does_not_leak_unless_asked(spark):
    fresh = synth.merge_batch(None, spark.range(500), key="id")
    assert fresh.count() == 500 and fresh.select("id").distinct().count() == 500
    leaked = synth.merge_batch(None, spark.range(500), leak_compat=True)
    assert leaked.groupBy("split").count().orderBy("split").collect() == [("test", 500), ("train", 500)]


# ---- sizing ----


def _one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


@pytest.mark.parametrize("n, steps, log, save", [(1000, 125, 12, 31), (5, 0, 1, 1)])
def test_step_plan(spark, n, steps, log, save):
    corpus = spark.range(n).withColumn("d", F.lit("x"))
    row = sizing.epoch_intervals(sizing.step_plan(corpus, "d")).first()
    assert (row.effective_batch, row.steps_per_epoch, row.total_steps) == (8, steps, steps)
    assert (row.log_steps, row.save_steps) == (log, save)


def test_steps_with_more_gpus_and_part_epochs(spark):
    corpus = spark.range(1000).withColumn("d", F.lit("x"))
    row = sizing.step_plan(corpus, "d", gpus=2, epochs=1.5).first()
    assert (row.effective_batch, row.steps_per_epoch, row.total_steps) == (16, 62, 93)


def test_step_intervals(spark):
    row = sizing.step_intervals(_one(spark, max_steps=500)).first()
    assert (row.log_steps, row.save_steps, row.eval_steps) == (25, 125, 100)


@pytest.mark.parametrize(
    "name, compat, size",
    [
        ("org/model2.5-0.5B", 0.5, 0.5), ("13B", 3.0, 13.0), ("model3-0.6B", 1.0, 0.6),
        ("4B", 4.0, 4.0), ("no-size", 1.0, 1.0), ("Base", 1.0, 1.0), ("x-7B-chat", 7.0, 7.0),
    ],
)
def test_model_size(spark, name, compat, size):
    row = spark.range(1).select(
        sizing.model_size(F.lit(name), compat=True).alias("compat"),
        sizing.model_size(F.lit(name)).alias("size"),
    ).first()
    assert (row.compat, row.size) == (compat, size)


def _report(spark, model, examples, flavor):
    jobs = _one(spark, model=model, dataset="d", flavor=flavor, dataset_size=examples, epochs=3)
    rated = sizing.lookup_size(sizing.lookup_hardware(jobs, sizing.hardware_table(spark)))
    sized = rated.withColumn("params", sizing.model_size(F.col("model")))
    return sizing.cost_warnings(sizing.job_report(sized)).first()


def test_cost(spark):
    small = _report(spark, "m-0.5B", 16000, "a10g-large")
    assert small.hours == pytest.approx(2.4) and small.cost == pytest.approx(12.0)
    assert small.timeout_hours == pytest.approx(3.12)
    assert not small.long_warning and not small.large_model_warning
    large = _report(spark, "m-7B", 160000, "t4-small")
    assert large.hours == pytest.approx(672) and large.cost == pytest.approx(504)
    assert large.timeout_hours == pytest.approx(873.6)
    assert large.long_warning and large.large_model_warning

@pytest.mark.parametrize("few", [100_000, 1])
def test_sizes_meet_jobs_whatever_their_number(spark, monkeypatch, few):
    monkeypatch.setattr(sizing, "FEW_DATASETS", few)
    monkeypatch.setattr(sizing, "JOBS_PER_SALT", 100)
    jobs = spark.range(1500).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'd' || id % 40 END AS dataset",
        "CASE WHEN id % 50 = 0 THEN 7 END AS dataset_size", "id AS num_examples",
    )
    sizes = spark.createDataFrame([("hot", 5), *((f"d{i}", i) for i in range(30))], "dataset STRING, num_examples BIGINT")
    got = sizing.lookup_size(jobs, sizes)
    want = {}
    for i in range(1500):
        name = "hot" if i % 3 == 0 else f"d{i % 40}" if i % 3 == 1 else None
        size = 5 if name == "hot" else i % 40 if name and i % 40 < 30 else 10_000
        want[i] = 7 if i % 50 == 0 else size
    assert {r.id: r.examples for r in got.collect()} == want and got.columns == [*jobs.columns, "examples"]


def test_no_task_holds_all_jobs_of_a_dataset(spark, monkeypatch):
    monkeypatch.setattr(sizing, "FEW_DATASETS", 1)
    monkeypatch.setattr(sizing, "JOBS_PER_SALT", 5000)
    jobs = spark.range(100_000).selectExpr("id", "'one' AS dataset", "CAST(NULL AS INT) AS dataset_size")
    sizes = spark.createDataFrame([("one", 5), ("two", 6)], "dataset STRING, num_examples BIGINT")
    with setting(spark, "spark.sql.adaptive.enabled", "false"), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        got = sizing.lookup_size(jobs, sizes)
        tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 100_000 and max(r["count"] for r in tasks) < 60_000


def test_lookups(spark):
    jobs = spark.createDataFrame(
        [("trl-lib/Capybara", None), ("mine", None), ("counted", None), ("counted", 5)],
        "dataset STRING, dataset_size BIGINT",
    )
    sizes = spark.createDataFrame([("counted", 77)], "dataset STRING, num_examples BIGINT")
    got = sorted((r.dataset, r.examples) for r in sizing.lookup_size(jobs, sizes).collect())
    assert got == [("counted", 5), ("counted", 77), ("mine", 10000), ("trl-lib/Capybara", 16000)]
    flavors = spark.createDataFrame([("t4-small",), ("l4x4",), ("other",)], "flavor STRING")
    known = sizing.lookup_hardware(flavors, sizing.hardware_table(spark)).collect()
    assert [r.flavor for r in known] == ["t4-small"]


def test_cost_report_covers_every_rated_flavor(spark, plan):
    corpus = spark.range(10).withColumn("d", F.col("id") % 2)
    report = sizing.cost_report(corpus, "d", "7B")
    assert report.count() == 16
    assert "NestedLoop" not in plan(report) and "Cartesian" not in plan(report)


@pytest.mark.parametrize(
    "params, tuning, need, fits",
    [
        (0.5, "full", 10, "t4-small"), (1.5, "adapters", 6, "t4-small"),
        (7.0, "adapters", 28, "a100-large"), (7.0, "full", 140, None), (2.0, "full", 40, "a100-large"),
    ],
)
def test_memory_fit(spark, params, tuning, need, fits):
    row = sizing.memory_fit(_one(spark, params=params), tuning=tuning).first()
    assert (row.need_gb, row.fits) == (need, fits)


@pytest.mark.parametrize(
    "params, tier",
    [
        (0.6, "t4-small"), (1.0, "a10g-small"), (3.0, "a10g-large"),
        (7.0, "a10g-large (LoRA) or a100-large"), (13.0, "a100-large (LoRA required)"),
    ],
)
def test_flavor_tier(spark, params, tier):
    assert sizing.flavor_tier(_one(spark, params=params)).first().tier == tier


def test_rubric_is_json_of_the_expected_form(spark):
    text = spark.range(1).select(F.to_json(synth.rubric()).alias("r")).first().r
    assert json.loads(text) == [{"aspect": a, "weight": w} for a, w in constants.RUBRIC]
