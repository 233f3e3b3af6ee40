"""The command line and the operators put together."""

import json

import pytest
from pyspark.sql import functions as F

from tunewright.__main__ import arguments, run
from tunewright.operators import monitor
from tunewright.plans import flows
from tunewright.sources import splits


@pytest.fixture
def do(spark):
    return lambda *words: run(spark, arguments([str(w) for w in words]))


def test_generated_records_become_a_split_dataset(spark, do, tmp_path):
    made, full, out = tmp_path / "made", tmp_path / "full", tmp_path / "out"
    assert do("generate", made, "--count", 70).first().records == 70
    assert do("top-up", made, full, "--target", 120).first().records == 120
    status = {(r.status, r.missing): r.entries for r in do("validate", full).collect()}
    assert status == {("valid", ""): 70, ("missing", "correctness"): 50}
    counts = do("preprocess", full, out, "--rejects", tmp_path / "rejects").first()
    assert counts.train + counts.test == 120 and counts.test > 0
    assert spark.read.json(str(tmp_path / "rejects") + "/*.json", schema="category STRING").count() == 0
    report = json.loads(do("inspect", out, "--json").first().report)
    assert report["columns"] == ["prompt", "completion"]
    assert report["recommended_methods"] == ["SFT", "GRPO"]
    assert report["compatibility"]["DPO"]["can_map"] is False
    assert "Recommended training methods: SFT, GRPO" in do("inspect", out).first().report


def test_validate_an_array_file(do, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"category": None}]))
    row = do("validate", path, "--array", "--report", tmp_path / "report").first()
    assert row.missing == "correctness, evaluation_criteria, example_answer, question"


def test_preprocess_counts_and_keeps_rejects(spark, do, tmp_path):
    path = tmp_path / "in.json"
    good = {"category": "CSS", "question": "q", "example_answer": "a", "correctness": "c"}
    path.write_text("\n".join([json.dumps(good), json.dumps({"category": "CSS"}), '{"category": "CS']))
    counts = do("preprocess", path, tmp_path / "out", "--rejects", tmp_path / "rejects").first()
    assert counts.train + counts.test == 1 and counts.rejected == 2
    kept = {r.raw: r.malformed for r in spark.read.json(str(tmp_path / "rejects")).collect()}
    assert kept == {'{"category":"CSS"}': False, '{"category": "CS': True}


def test_incomplete_records_are_rejected_and_the_rest_goes_on(spark):
    df = spark.createDataFrame(
        [(1, "CSS", "q", "a", None), (2, None, "q", "a", "c")],
        "id INT, category STRING, question STRING, example_answer STRING, correctness STRING",
    )
    complete, rejects = flows.with_rejects(df)
    assert [r.id for r in complete.collect()] == [1]
    assert [(r.id, r.missing) for r in rejects.collect()] == [(2, ["category"])]
    made = flows.records_to_tensors(df, "id").collect()
    assert len(made) == 1 and len(made[0].labels) == 256


def test_records_to_tensors_is_a_narrow_map(spark, plan):
    df = spark.createDataFrame(
        [(1, "CSS", "q", "a", None)],
        "id INT, category STRING, question STRING, example_answer STRING, correctness STRING",
    )
    assert "Exchange" not in plan(flows.records_to_tensors(df, "id"))


@pytest.mark.parametrize("rows, batches, train", [(90, 5, 590), (500, 0, 500)])
def test_corpus_grows_in_whole_batches(spark, do, tmp_path, rows, batches, train):
    base = str(tmp_path / "corpus")
    first = spark.range(rows + 7).select(
        F.concat(F.lit("p"), "id").alias("prompt"), F.lit("c").alias("completion"),
        F.when(F.col("id") < rows, "train").otherwise("test").alias("split"),
    )
    splits.save_version(first, base, "1")
    assert tuple(do("grow", base, "2").first()) == (train, 7)
    with pytest.raises(ValueError, match="complete already"):
        do("grow", base, "2")
    assert splits.read_version(spark, base).count() == train + 7
    assert splits.read_version(spark, base).where("split = 'train'").agg(F.max("batch")).first()[0] == (batches or 0)
    new = splits.read_version(spark, base).where("prompt LIKE '### Problem%'")
    assert new.count() == 100 * batches
    if batches:
        assert new.where(f"prompt LIKE '%(example {rows + 1})%'").count() == 1
        assert new.where(f"prompt LIKE '%(example {rows + 500})%'").count() == 1


def test_estimate(spark, do, tmp_path):
    row = do("estimate", "--model", "m-0.5B", "--dataset", "d", "--hardware", "a10g-large",
             "--dataset-size", 16000).first()
    assert row.hours == pytest.approx(2.4) and row.cost == pytest.approx(12)
    spark.range(2000).write.parquet(str(tmp_path / "rows"))
    counted = do("estimate", "--model", "1B", "--dataset", tmp_path / "rows", "--hardware", "t4-small")
    assert counted.first().examples == 2000


def test_snapshots_say_what_is_missing(spark):
    lines = spark.createDataFrame(
        [(1, "python train.py"), (2, "models/checkpoint-40"), (3, "models/checkpoint-7"), (20, "idle")],
        "minute INT, line STRING",
    ).selectExpr("minute AS seq", "timestamp'2024-01-01' + make_dt_interval(0, 0, minute) AS ts", "line")
    beats = monitor.heartbeat(lines, "15 minutes", extra=monitor.snapshot_parts("train[.]py", "grep"))
    first, second = monitor.snapshot_notes(beats).orderBy("window_start").collect()
    assert (first.processes, first.checkpoint, first.process_note, first.checkpoint_note) == (1, 40, None, None)
    assert (second.processes, second.process_note, second.checkpoint_note) == (
        0, "no training process", "no checkpoints",
    )
