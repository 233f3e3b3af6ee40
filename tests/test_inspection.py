"""Format checks, recommendations, mappings and previews on hand-worked schemas."""

import pytest
from pyspark.sql import functions as F

from tunewright.operators import inspect as inspection
from tunewright.operators import mapping

CASES = [
    ("category,question,example_answer,evaluation_criteria,correctness",
     "SFT (needs mapping), GRPO (needs mapping)"),
    ("prompt,completion", "SFT, GRPO"),
    ("messages", "SFT"),
    ("messages,text", "SFT"),
    ("prompt,chosen,rejected", "SFT (needs mapping), DPO"),
    ("prompt,completion,label", "SFT, GRPO, KTO"),
    ("question,winner,loser",
     "SFT (needs mapping), DPO (needs mapping), GRPO (needs mapping)"),
    ("question,dispreferred,preferred",
     "SFT (needs mapping), DPO (needs mapping), GRPO (needs mapping)"),
    ("instruction,context,response", "SFT (needs mapping), GRPO (needs mapping)"),
    ("a,b", "None (dataset needs formatting)"),
]


@pytest.fixture(scope="module")
def checks(spark):
    rows = [(c, i, name) for c, _ in CASES for i, name in enumerate(c.split(","))]
    schemas = spark.createDataFrame(rows, "dataset STRING, pos INT, column STRING")
    return inspection.recommend(inspection.check_formats(schemas)).cache()


def test_recommendations(checks):
    got = {r.dataset: r.recommended for r in checks.collect()}
    assert got == dict(CASES)


def test_reasons_and_candidates(checks):
    rows = {r.dataset: r for r in checks.collect()}
    assert rows["messages,text"].sft_reason == "messages"
    assert rows["prompt,completion"].sft_reason == "prompt+completion"
    interview = rows["category,question,example_answer,evaluation_criteria,correctness"]
    assert (interview.prompt_col, interview.response_col) == ("question", "example_answer")
    assert not interview.has_context
    # a name that contains another pattern: the first column in order is taken
    assert rows["question,dispreferred,preferred"].chosen_col == "dispreferred"


def test_grpo_is_neither_ready_nor_mappable_with_preferences(checks):
    row = checks.where("dataset = 'prompt,chosen,rejected'").first()
    assert not row.grpo_ready and not row.grpo_can_map


def test_status_words(checks):
    row = inspection.method_status(checks).where("dataset = 'question,winner,loser'").first()
    assert (row.sft_status, row.dpo_status, row.grpo_status, row.kto_status) == (
        "NEEDS MAPPING", "NEEDS MAPPING", "NEEDS MAPPING", "INCOMPATIBLE",
    )


def test_single_checks(spark):
    df = spark.createDataFrame([("p", "c", True)], "prompt STRING, completion STRING, label BOOLEAN")
    schemas = inspection.schema_table(spark, {"d": df})
    assert inspection.check_sft(schemas).first().reason == "prompt+completion"
    assert not inspection.check_dpo(schemas).first().ready
    assert inspection.check_grpo(schemas).first().ready
    assert inspection.check_kto(schemas).first().ready


@pytest.mark.parametrize(
    "context, text",
    [
        ("c", "Instruction: p\n\nContext: c\n\nResponse: r"),
        ("", "Instruction: p\n\nResponse: r"),
        (None, "Instruction: p\n\nResponse: r"),
    ],
)
def test_mapping_found_and_applied(spark, context, text):
    df = spark.createDataFrame(
        [("p", context, "r")], "instruction STRING, context STRING, response STRING"
    )
    spec = inspection.mapping_spec(
        inspection.check_formats(inspection.schema_table(spark, {"d": df}))
    )
    mapped = mapping.apply_mapping(df, spec, "SFT")
    assert mapped.columns == ["text"]
    assert mapped.first().text == text
    assert mapping.to_sft_text(df, "instruction", "response", "context").first().text == text


def test_mapping_of_pair_prompt_and_preferences(spark):
    df = spark.createDataFrame([("p", "r")], "question STRING, answer STRING")
    assert mapping.to_sft_text(df, "question", "answer").first().text == "p\n\nr"
    assert mapping.to_sft_text(df, "question").first().text == "p"
    pairs = spark.createDataFrame([("q", "w", "l")], "question STRING, winner STRING, loser STRING")
    spec = inspection.mapping_spec(
        inspection.check_formats(inspection.schema_table(spark, {"d": pairs}))
    )
    assert tuple(mapping.apply_mapping(pairs, spec, "DPO").first()) == ("q", "w", "l")
    assert mapping.apply_mapping(pairs, spec, "GRPO").columns == ["prompt"]
    assert mapping.apply_mapping(pairs, spec, "KTO").columns == pairs.columns


def test_preview(spark):
    df = spark.sql(
        """SELECT CAST(NULL AS STRING) AS none, 'abcde' AS short, 'abcdef' AS long,
           array_repeat(named_struct('aspect', 'a', 'weight', 1.0D), 3) AS list,
           array(1, 2) AS numbers, array('x', NULL) AS words, true AS flag,
           CAST(array() AS ARRAY<STRUCT<a: INT>>) AS empty, 123456 AS number"""
    )
    row = inspection.preview(df, 5).first()
    assert row.none == "None"
    assert row.short == "abcde"
    assert row.long == "abcde..."
    assert row.list == "[3 items] Keys: ['aspect', 'weight']"
    assert row.numbers == "[1, 2..."
    assert row.words == "['x',..."
    assert row.flag == "True"
    assert row.empty == "[]"
    assert row.number == "12345..."


def test_count_has_separators(spark):
    assert inspection.count_examples(spark.range(1234567)).first()[0] == "1,234,567"


def test_inspect_reads_names_and_first_row(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id INT, text STRING")
    report = inspection.inspect(spark, df, "d", "id").first()
    assert report.columns == ["id", "text"]
    assert [tuple(c) for c in report.example] == [("id", "1"), ("text", "a")]
    assert report.total_examples == "2"
    assert report.recommended == "SFT"


def test_find_columns_keeps_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Output INT, x INT, my_response INT")
    found = inspection.find_columns(
        inspection.schema_table(spark, {"d": df}), ["response", "output"]
    )
    assert [r.column for r in found.orderBy(F.col("pos")).collect()] == ["Output", "my_response"]
