"""Records: mapping, validation, files, tokens."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tunewright import constants
from tunewright.operators import chat, infer, mapping, tokens, validate
from tunewright.functions.tokens import first_token_lengths, mask_prompt, pad_truncate
from tunewright.queries.corpus import load_word_lengths
from tunewright.schemas import INTERVIEW_RECORD
from tunewright.session import setting
from tunewright.sources import records, splits

RECORD = {
    "category": "MySQL",
    "question": "Name all rows.",
    "example_answer": "SELECT name FROM rows;",
    "evaluation_criteria": [{"aspect": "Correctness", "weight": 0.6}],
    "correctness": "Query is right.",
}


def _frame(spark, *rows):
    return spark.createDataFrame([json.dumps(r) for r in rows], "string").select(
        F.col("value").alias("raw"), F.from_json("value", INTERVIEW_RECORD).alias("r")
    )


def test_prompt_and_completion(spark):
    partial = {k: v for k, v in RECORD.items() if k != "correctness"}
    rows = mapping.to_prompt_completion(_frame(spark, RECORD, partial).select("r.*")).collect()
    assert rows[0].prompt == "MySQL Question: Name all rows.\nAnswer:"
    assert rows[0].completion == " SELECT name FROM rows;\nEvaluation: Query is right."
    assert rows[1].completion.endswith("Evaluation: " + constants.DEFAULT_CORRECTNESS)


def test_missing_keys_and_nulls(spark):
    partial = {k: v for k, v in RECORD.items() if k != "correctness"}
    df = _frame(spark, RECORD, partial, {"category": None})
    raw = [r.missing for r in validate.missing_fields(df, raw="raw").collect()]
    assert raw == [
        [],
        ["correctness"],
        ["correctness", "evaluation_criteria", "example_answer", "question"],
    ]
    typed = [r.missing for r in validate.missing_fields(df.select("r.*")).collect()]
    assert typed[:2] == [[], ["correctness"]]
    assert typed[2] == sorted(constants.REQUIRED_FIELDS)


def test_array_file_keeps_entry_numbers_and_nulls(spark, tmp_path):
    partial = {k: v for k, v in RECORD.items() if k != "correctness"}
    path = tmp_path / "records.json"
    path.write_text(json.dumps([RECORD, partial, {"category": None}], indent=2))
    raw = records.read_raw(spark, str(path), array=True)
    report = validate.validation_report(raw, "entry", raw="raw").orderBy("entry").collect()
    assert [r.entry for r in report] == [1, 2, 3]
    assert [r.status for r in report] == ["valid", "missing", "missing"]
    assert report[1].message == "Entry 2 is missing fields: correctness"
    assert records.read_records(spark, str(path), array=True).count() == 3


def test_lines_are_numbered_across_input_splits(spark, tmp_path):
    for name, n in (("a", 500), ("b", 40)):
        (tmp_path / f"{name}.json").write_text("".join(f'{{"n": {i + 1}}}\n' for i in range(n)))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "700"):
        raw = records.read_raw(spark, str(tmp_path), numbered=True)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        rows = raw.select("entry", F.get_json_object("raw", "$.n").cast("bigint").alias("n")).collect()
    assert len(rows) == 540 and all(r.entry == r.n for r in rows)


def test_malformed_records_are_rejected_not_fatal(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text(json.dumps(RECORD) + "\n{\"category\": \n" + json.dumps(RECORD) + "\n")
    read = records.read_with_rejects(spark, str(path)).select("category", "corrupt").collect()
    assert [r.corrupt is None for r in read] == [True, False, True]
    bad = tmp_path / "bad.json"
    bad.write_text("[{\"category\": ")
    assert records.read_with_rejects(spark, str(bad), array=True).select(
        "category", "corrupt"
    ).first().corrupt


def test_records_survive_a_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = _frame(spark, RECORD).select("r.*")
    records.write_records(df, path)
    assert records.read_records(spark, path).collect() == df.collect()


def test_versions_are_read_once_complete(spark, tmp_path):
    base = str(tmp_path / "v")
    splits.save_version(spark.range(3), base, "20240101T000000")
    splits.save_version(splits.read_version(spark, base).union(spark.range(2)), base, "20240102T000000")
    spark.range(9).write.parquet(f"{base}/data/version=20240103T000000")  # never recorded
    assert splits.latest_version(spark, base) == "20240102T000000"
    assert splits.read_version(spark, base).count() == 5
    assert splits.read_version(spark, base, "20240101T000000").count() == 3


def test_of_two_writers_of_a_version_one_wins(spark, tmp_path):
    base = str(tmp_path / "v")
    frames = [spark.range(0, 4000, 1, 4).selectExpr(f"{i} AS writer", "id", "if(id % 9 = 0, 'test', 'train') AS split") for i in range(2)]
    with ThreadPoolExecutor(2) as pool:
        problems = [f.exception() for f in [pool.submit(splits.save_version, df, base, "20240101T000000") for df in frames]]
    assert sorted(type(p).__name__ for p in problems) == ["NoneType", "ValueError"]
    got = splits.read_version(spark, base)
    winner = problems.index(None)
    assert got.count() == 4000 and {r.writer for r in got.select("writer").distinct().collect()} == {winner}
    assert len(list((tmp_path / "v" / "data" / "version=20240101T000000").iterdir())) == 1  # the other's files are gone
    assert splits.versions(spark, base).count() == 1


def test_a_claim_whose_writer_was_lost_is_completed(spark, tmp_path):
    base = str(tmp_path / "v")
    first = "data/version=a/attempt-1"
    spark.range(3).write.parquet(f"{base}/{first}")
    assert splits._claim(spark, f"{base}/claims/a", first) == first  # and then it was lost
    with pytest.raises(ValueError):
        splits.read_version(spark, base, "a")
    with pytest.raises(ValueError):
        splits.save_version(spark.range(9), base, "a")
    assert splits.read_version(spark, base).count() == 3


def test_a_split_reads_its_own_directory(spark, tmp_path, plan):
    path = str(tmp_path / "s")
    splits.write_split(spark.range(10).selectExpr("id", "if(id < 7, 'train', 'test') AS split"), path)
    train = splits.read_split(spark, path, "train")
    assert train.count() == 7
    assert "PartitionFilters: [isnotnull(split" in plan(train)


def test_named_table(spark):
    spark.range(4).createOrReplaceTempView("some_dataset")
    assert splits.load_dataset(spark, "some_dataset").count() == 4


# ---- tokens ----


def _ids(spark, ids):
    return spark.createDataFrame([(ids,)], "ids ARRAY<INT>")


def test_pad_and_mask(spark):
    padded = pad_truncate(F.col("ids"), 5, 0)
    row = _ids(spark, [11, 12, 13, 14]).select(
        padded.alias("x"),
        mask_prompt(padded, F.lit(3)).alias("y"),
        mask_prompt(padded, F.lit(3), F.lit(4), mask_pad=True).alias("z"),
    ).first()
    assert row.x == [11, 12, 13, 14, 0]
    assert row.y == [-100, -100, -100, 14, 0]
    assert row.z == [-100, -100, -100, 14, -100]


def test_prompt_longer_than_the_example(spark):
    padded = pad_truncate(F.col("ids"), 5, 0)
    row = _ids(spark, [1, 2, 3, 4, 5, 6]).select(mask_prompt(padded, F.lit(9)).alias("y")).first()
    assert row.y == [-100] * 5


def test_padding_falls_back_to_the_end_token(spark):
    assert _ids(spark, [1]).select(pad_truncate(F.col("ids"), 3, eos=7).alias("x")).first().x == [1, 7, 7]


def test_labels_have_the_full_length_with_a_loaded_tokenizer(spark):
    df = spark.createDataFrame(
        [("a bb", " ccc dddd"), ("", "x"), ("p " * 300, "c")], "prompt STRING, completion STRING"
    )
    native = tokens.tokenize_examples(df).collect()
    loaded = tokens.tokenize_examples(
        df, lambda text: infer.tokenize(text, load_word_lengths)
    ).collect()
    assert native == loaded
    assert all(len(r.labels) == len(r.input_ids) == len(r.attention_mask) == 256 for r in native)
    assert native[0].attention_mask == [1] * 4 + [0] * 252
    assert native[0].input_ids[:5] == [1, 2, 3, 4, 0]
    assert native[0].labels[:5] == [-100, -100, 3, 4, 0]
    assert set(native[2].labels) == {-100}


def test_the_prompt_has_no_special_tokens_and_the_text_has(spark, plan):
    df = spark.createDataFrame([(1, "a bb", " ccc dddd"), (2, "", "x"), (3, None, "x")], "id INT, prompt STRING, completion STRING")

    def load():  # word lengths, after a start token where special tokens are asked for
        return lambda texts, special: [[99] * special + [len(w) for w in text.split()] for text in texts]

    examples = tokens.tokenize_examples(df, load=load, max_length=6, keep=("id",))
    rows = {r.id: r for r in examples.collect()}
    assert rows[1].input_ids == [99, 1, 2, 3, 4, 0] and rows[1].attention_mask == [1] * 5 + [0]
    assert rows[1].labels == [-100, -100, 2, 3, 4, 0]  # as many positions as the prompt has tokens of its own
    assert rows[2].labels == [99, 1, 0, 0, 0, 0] and rows[3].input_ids is None
    assert plan(examples).count("ArrowEvalPython") == 1


def test_responses_are_masked_in_one_call(spark, plan):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a bb"), (1, 1, "assistant", "ccc dd"), (2, 0, "assistant", None)], "conv_id INT, turn INT, role STRING, text STRING"
    )

    def load():
        return lambda texts, special: [[len(w) for w in text.split()] for text in texts]

    one = tokens.mask_to_responses(turns, load=load)
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert rows(one.where("conv_id = 1")) == rows(tokens.mask_to_responses(turns).where("conv_id = 1"))
    assert plan(one).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("n", [1, 2, 3, 256])
def test_first_tokens_are_those_of_the_whole_text(spark, n):
    texts = ["", " ", "a", "a b", "  a b", "a b  ", "\n a\t\tbb  ccc d ", "a b c", None, "x " * 600]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for r in df.select("t", first_token_lengths(F.col("t"), n).alias("ids")).collect():
        assert r.ids == (None if r.t is None else [len(w) for w in r.t.split()][:n])


def test_tokenizer_keeps_nulls(spark):
    df = spark.createDataFrame([("a b",), (None,)], "text STRING")
    got = df.select(infer.tokenize(F.col("text"), load_word_lengths).alias("ids")).collect()
    assert [r.ids for r in got] == [[1, 1], None]


def test_only_responses_are_targets(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "be kind"), (1, 1, "user", "a bb"), (1, 2, "assistant", "ccc"), (1, 3, "user", "")],
        "conv_id INT, turn INT, role STRING, text STRING",
    )
    row = tokens.mask_to_responses(turns).first()
    assert row.input_ids == [18, 2, 14, 16, 1, 12, 21, 13, 16, 10]
    assert row.labels == [-100] * 7 + [13] + [-100] * 2


# ---- conversations ----


def test_render_and_leading_mark(spark):
    df = spark.sql("SELECT array(struct('user' AS role, 'hi' AS content)) AS conversations")
    assert chat.render_chat(df).first().text == "<|im_start|>user\nhi<|im_end|>\n"
    assert chat.render_chat(df, bos="<|im_start|>", end="").first().text == "user\nhi"
    assert chat.render_chat(df, bos="<s>").first().text.startswith("<|im_start|>")


def test_a_turn_without_content_is_not_dropped_silently(spark):
    df = spark.sql(
        "SELECT array(struct('user' AS role, 'hi' AS content), struct('user' AS role, NULL AS content))"
        " AS conversations"
    )
    assert chat.render_chat(df).first().text is None


def test_conversation_column(spark):
    df = spark.sql("SELECT 'text' AS messages, array(struct('human' AS from, 'hi' AS value)) AS conversation")
    named = chat.normalize_conversation_column(df)
    assert named.columns == ["messages", "conversations"]
    standard = chat.standardize_turns(named).first().conversations
    assert [tuple(t) for t in standard] == [("user", "hi")]


@pytest.mark.parametrize("role", ["user", "tool"])
def test_standard_roles_stay(spark, role):
    df = spark.sql(f"SELECT array(struct('{role}' AS role, 'x' AS content)) AS conversations")
    assert chat.standardize_turns(df).first().conversations[0].role == role
