"""Schemas of the tables this package reads and writes, as DDL."""

from __future__ import annotations

INTERVIEW_RECORD = (
    "category STRING, question STRING, example_answer STRING, "
    "evaluation_criteria ARRAY<STRUCT<aspect: STRING, weight: DOUBLE>>, correctness STRING"
)
PROMPT_COMPLETION = "prompt STRING, completion STRING"
PREFERENCE_PAIR = "prompt STRING, chosen STRING, rejected STRING"
PROMPT_ONLY = "prompt STRING"
BINARY_LABEL = "prompt STRING, completion STRING, label BOOLEAN"
CONVERSATION = "conversations ARRAY<STRUCT<role: STRING, content: STRING>>"
SHAREGPT = "conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>"
MULTIMODAL = (
    "images ARRAY<STRING>, "
    "messages ARRAY<STRUCT<role: STRING, content: ARRAY<STRUCT<type: STRING, text: STRING>>>>"
)
TOKENISED = "input_ids ARRAY<INT>, labels ARRAY<INT>, attention_mask ARRAY<INT>"
CATALOG = "config STRING, split STRING, num_examples BIGINT"
JOB = "model STRING, dataset STRING, flavor STRING, dataset_size BIGINT, epochs INT"
METRIC = (
    "project STRING, run STRING, grp STRING, step BIGINT, ts TIMESTAMP, metric STRING, value DOUBLE"
)
LOG_LINE = "log STRING, seq BIGINT, ts TIMESTAMP, line STRING"
GPU = (
    "index INT, name STRING, util INT, mem_util INT, mem_total INT, mem_used INT, temp INT"
)
CHECKPOINT = "run STRING, path STRING"
REQUEST = "id BIGINT, prompt STRING, max_new_tokens INT, temperature DOUBLE"
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
