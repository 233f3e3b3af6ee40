"""Queries over conversations and documents: chat text, mappings, tokens, validation."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tunewright.operators import chat, infer, mapping, tokens, validate
from tunewright.operators import split as splits
from tunewright.operators import inspect as inspection
from tunewright.plans import flows
from tunewright.queries.adapt import (
    EXCHANGES_SQL,
    PAIRS_SQL,
    PLACED_SQL,
    PREFERENCES_SQL,
    PROMPTS_SQL,
    RECORDS_SQL,
    SHAPES_SQL,
    exchanges,
    preferences,
    prompts,
    records,
    shaped_records,
    table,
)
from tunewright.queries.registry import query, sql_split
from tunewright.session import fresh_dir
from tunewright.sources.arrays import read_array, write_array_text

CHAT_SQL = f"""
    SELECT conv_id, part, 0::BIGINT AS slice,
           string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                      ORDER BY turn) AS text
    FROM ({PLACED_SQL}) p GROUP BY conv_id, part"""


@query(f"SELECT *, {sql_split('conv_id')} AS split FROM ({CHAT_SQL}) c")
def chat_render_split(spark, folder):
    """Rows per turn to one rendered text per conversation, with its split."""
    return flows.turns_to_text(table(spark, folder, "conversations"))


@query(f"""
    SELECT conv_id, part, 0::BIGINT AS slice, count(*)::INTEGER AS n_turns,
           string_agg(role || ':' || text, chr(10) ORDER BY turn) AS turns
    FROM ({PLACED_SQL}) p GROUP BY conv_id, part""")
def conversation_standard(spark, folder):
    """(from, value) turns in a column of another name, brought to the standard form."""
    turns = table(spark, folder, "conversations")
    sharegpt = chat.turns_to_conversation(turns).select(
        "conv_id",
        "part",
        "slice",
        F.transform(
            "conversations",
            lambda t: F.struct(
                F.when(t["role"] == "user", F.lit("human"))
                .when(t["role"] == "assistant", F.lit("gpt"))
                .otherwise(t["role"])
                .alias("from"),
                t["content"].alias("value"),
            ),
        ).alias("conversation"),
    )
    standard = chat.standardize_turns(chat.normalize_conversation_column(sharegpt))
    return standard.select(
        "conv_id",
        "part",
        "slice",
        F.size("conversations").alias("n_turns"),
        F.array_join(
            F.transform("conversations", lambda t: F.concat_ws(":", t["role"], t["content"])), "\n"
        ).alias("turns"),
    )


@query(f"SELECT doc_id, prompt, completion FROM ({PAIRS_SQL}) p")
def prompt_completion(spark, folder):
    return mapping.to_prompt_completion(records(spark, folder), keep=("doc_id",))


@query(f"SELECT doc_id, prompt || completion AS text FROM ({PAIRS_SQL}) p")
def full_text(spark, folder):
    return mapping.full_text(prompt_completion(spark, folder), keep=("doc_id",))


@query(f"""
    SELECT conv_id, turn, 'Instruction: ' || prompt || chr(10) || chr(10)
           || CASE WHEN coalesce(context, '') != ''
                   THEN 'Context: ' || context || chr(10) || chr(10) ELSE '' END
           || 'Response: ' || response AS text
    FROM ({EXCHANGES_SQL}) f""")
def sft_text_context(spark, folder):
    turns = exchanges(table(spark, folder, "conversations"))
    return mapping.to_sft_text(turns, "prompt", "response", "context", keep=("conv_id", "turn"))


@query(f"""
    SELECT conv_id, turn, prompt || chr(10) || chr(10) || response AS text FROM ({EXCHANGES_SQL}) f""")
def sft_text_pair(spark, folder):
    turns = exchanges(table(spark, folder, "conversations"))
    return mapping.to_sft_text(turns, "prompt", "response", keep=("conv_id", "turn"))


@query(f"SELECT conv_id, turn, prompt AS text FROM ({PROMPTS_SQL}) f")
def sft_text_prompt(spark, folder):
    turns = prompts(table(spark, folder, "conversations"))
    return mapping.to_sft_text(turns, "prompt", keep=("conv_id", "turn"))


@query(f"""
    SELECT conv_id, turn, question AS prompt, winner AS chosen, loser AS rejected
    FROM ({PREFERENCES_SQL}) p""")
def dpo_map(spark, folder):
    pairs = preferences(table(spark, folder, "conversations"))
    return mapping.to_dpo(pairs, "question", "winner", "loser", keep=("conv_id", "turn"))


@query(PROMPTS_SQL)
def grpo_map(spark, folder):
    return mapping.to_grpo(prompts(table(spark, folder, "conversations")), "prompt", keep=("conv_id", "turn"))


@query(f"""
    SELECT conv_id, turn, question AS prompt, winner AS chosen, loser AS rejected
    FROM ({PREFERENCES_SQL}) p""")
def mapping_applied(spark, folder):
    """The mapping found from the columns, applied to the data."""
    pairs = preferences(table(spark, folder, "conversations"))
    checks = inspection.check_formats(inspection.schema_table(spark, {"pairs": pairs}))
    spec = inspection.mapping_spec(checks)
    return mapping.apply_mapping(pairs, spec, "DPO", keep=("conv_id", "turn"), dataset="pairs")


# ---- tokens ----

IDS_SQL = "list_transform(regexp_extract_all({0}, '\\S+'), lambda t: length(t))"


@query(f"""
    WITH t AS (
        SELECT doc_id, {IDS_SQL.format('prompt || completion')} AS ids,
               len({IDS_SQL.format('prompt')}) AS n
        FROM ({PAIRS_SQL}) p),
    u AS (SELECT doc_id, n, len(ids) AS m, list_resize(ids[1:256], 256, 0) AS ids FROM t)
    SELECT doc_id, array_to_string(ids, ' ') AS input_ids,
           array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= n THEN -100 ELSE x END), ' ')
               AS labels,
           array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= m THEN 1 ELSE 0 END), ' ')
               AS attention_mask
    FROM u""")
def pad_mask(spark, folder):
    """Records to fixed-length ids, labels and attention masks."""
    examples = tokens.tokenize_examples(prompt_completion(spark, folder), keep=("doc_id",))
    return _joined(examples, ("input_ids", "labels", "attention_mask"), "doc_id")


def _joined(examples, arrays, *keys):
    return examples.select(
        *keys, *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in arrays]
    )


TURN_SQL = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"


@query(f"""
    WITH t AS (
        SELECT conv_id, turn, part, role, {IDS_SQL.format(TURN_SQL)} AS ids,
               len({IDS_SQL.format("'<|im_start|>' || role || chr(10)")}) AS head
        FROM ({PLACED_SQL}) p)
    SELECT conv_id, part, 0::BIGINT AS slice,
           string_agg(array_to_string(ids, ' '), ' ' ORDER BY turn) AS input_ids,
           string_agg(array_to_string(list_transform(ids, lambda x, i: CASE
                          WHEN role = 'assistant' AND i > head THEN x ELSE -100 END), ' '), ' '
                      ORDER BY turn) AS labels
    FROM t GROUP BY conv_id, part""")
def response_mask(spark, folder):
    """Rendered conversations to ids, with the assistant's tokens and end marks as labels."""
    masked = tokens.mask_to_responses(table(spark, folder, "conversations"))
    return _joined(masked, ("input_ids", "labels"), "conv_id", "part", "slice")


def load_word_lengths():
    """A stand-in tokenizer: a word's id is its length."""
    word = re.compile(r"\S+", re.ASCII)

    def encode(texts):
        return [[len(w) for w in word.findall(text)] for text in texts]

    return encode


@query(f"""
    SELECT doc_id, len(ids)::INTEGER AS n_tokens, list_sum(ids)::BIGINT AS id_sum
    FROM (SELECT doc_id, {IDS_SQL.format('text')} AS ids FROM documents) t""")
def tokenize_batches(spark, folder):
    """Whole texts through a tokenizer that is loaded once per worker."""
    ids = infer.tokenize(F.col("text"), load_word_lengths)
    encoded = table(spark, folder, "documents").select("doc_id", ids.alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"),
    )


# ---- validation ----


@query(f"""
    SELECT doc_id, array_to_string(missing, ', ') AS missing,
           CASE WHEN len(missing) = 0 THEN 'valid' ELSE 'missing' END AS status,
           'Entry ' || doc_id::VARCHAR || CASE WHEN len(missing) = 0
               THEN ': All required fields are present.'
               ELSE ' is missing fields: ' || array_to_string(missing, ', ') END AS message
    FROM (SELECT doc_id, CASE WHEN correctness IS NULL THEN ['correctness'] ELSE [] END AS missing
          FROM ({RECORDS_SQL}) r) m""")
def validate_fields(spark, folder):
    """Typed records: required fields that are null."""
    typed = records(spark, folder)
    required = ["category", "question", "example_answer", "correctness"]
    return validate.validation_report(typed, "doc_id", required)


RAW_MISSING_SQL = """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL AND d.source != 'src0' THEN 'quality' ELSE '' END
        AS missing
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _raw_labelled(spark, folder):
    """Documents as raw JSON; only records of one source keep the key of a null."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    fields = F.struct("text", "lang", "quality")
    raw = F.when(
        F.col("source") == "src0", F.to_json(fields, {"ignoreNullFields": "false"})
    ).otherwise(F.to_json(fields))
    return documents.join(labels, "doc_id", "left").select("doc_id", raw.alias("raw"))


@query(f"""
    SELECT row_number() OVER (ORDER BY doc_id) AS entry, missing,
           CASE WHEN missing = '' THEN 'valid' ELSE 'missing' END AS status,
           CASE WHEN missing = '' THEN 'Entry ' || (row_number() OVER (ORDER BY doc_id))::VARCHAR || ': All required fields are present.'
                ELSE 'Entry ' || (row_number() OVER (ORDER BY doc_id))::VARCHAR || ' is missing fields: ' || missing END AS message
    FROM ({RAW_MISSING_SQL}) r""")
def validate_array(spark, folder):
    """Array files, of records in order of their key, validated by the number of their entries."""
    path = fresh_dir(spark, "array")
    raw = _raw_labelled(spark, folder).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    write_array_text(raw, "raw", path)
    read = read_array(spark, path).withColumn("entry", F.col("number"))
    return validate.validation_report(read, "entry", ["text", "lang", "quality"], raw="raw")


@query(RAW_MISSING_SQL)
def validate_raw(spark, folder):
    """Raw records: required keys that are absent, a null being present."""
    checked = validate.missing_fields(
        _raw_labelled(spark, folder), ["text", "lang", "quality"], raw="raw"
    )
    return checked.select("doc_id", F.array_join("missing", ", ").alias("missing"))


@query(f"""
    SELECT CASE WHEN missing = '' THEN 'valid' ELSE 'missing' END AS status, missing,
           count(*) AS entries
    FROM ({RAW_MISSING_SQL}) m GROUP BY ALL""")
def validation_summary(spark, folder):
    report = validate.validation_report(
        _raw_labelled(spark, folder), "doc_id", ["text", "lang", "quality"], raw="raw"
    )
    return validate.validation_summary(report)


DOCUMENT = "text STRING, lang STRING, n_chars BIGINT"


def damaged_json(spark, folder):
    """Documents as JSON, some without their closing brace."""
    whole = F.to_json(F.struct("text", "lang", "n_chars"))
    raw = F.when(
        F.pmod(F.col("n_chars"), F.lit(11)) == 0, F.regexp_replace(whole, r"\}$", "")
    ).otherwise(whole)
    return table(spark, folder, "documents").select("doc_id", raw.alias("raw"))


@query("""
    SELECT doc_id, n_chars % 11 = 0 AS is_corrupt,
           CASE WHEN n_chars % 11 != 0 THEN lang END AS lang,
           CASE WHEN n_chars % 11 != 0 THEN length(text) END AS text_length
    FROM documents""")
def parse_records(spark, folder):
    parsed = validate.parse_records(damaged_json(spark, folder), DOCUMENT)
    good = F.col("corrupt").isNull()
    return parsed.select(
        "doc_id",
        (~good).alias("is_corrupt"),
        F.when(good, F.col("record.lang")).alias("lang"),
        F.when(good, F.length("record.text")).cast("bigint").alias("text_length"),
    )


@query("SELECT doc_id FROM documents WHERE n_chars % 11 = 0")
def corrupt_rows(spark, folder):
    return validate.corrupt_rows(damaged_json(spark, folder), DOCUMENT).select("doc_id")


# ---- inspection ----


def _like(patterns):
    return "(" + " OR ".join(f"lower(\"column\") LIKE '%{p}%'" for p in patterns) + ")"


PROMPT = _like(["prompt", "instruction", "question", "input"])
RESPONSE = _like(["response", "completion", "output", "answer"])
CHOSEN = _like(["chosen", "preferred", "winner"])
REJECTED = _like(["rejected", "dispreferred", "loser"])


def _has(name):
    return f"bool_or(\"column\" = '{name}')"


CHECKS_SQL = f"""
    SELECT dataset, sft_reason IS NOT NULL AS sft_ready, sft_reason, prompt_col, response_col,
           has_context, p AND c AND r AS dpo_ready,
           prompt_col IS NOT NULL AND chosen_col IS NOT NULL AND rejected_col IS NOT NULL AS dpo_can_map,
           chosen_col, rejected_col, p AND NOT c AND NOT r AS grpo_ready,
           prompt_col IS NOT NULL AND NOT c AND NOT r AS grpo_can_map, p AND k AND l AS kto_ready
    FROM (
        SELECT dataset,
               CASE WHEN {_has('messages')} THEN 'messages' WHEN {_has('text')} THEN 'text'
                    WHEN {_has('prompt')} AND {_has('completion')} THEN 'prompt+completion' END
                   AS sft_reason,
               arg_min("column", pos) FILTER (WHERE {PROMPT}) AS prompt_col,
               arg_min("column", pos) FILTER (WHERE {RESPONSE}) AS response_col,
               arg_min("column", pos) FILTER (WHERE {CHOSEN}) AS chosen_col,
               arg_min("column", pos) FILTER (WHERE {REJECTED}) AS rejected_col,
               {_has('context')} AS has_context, {_has('prompt')} AS p, {_has('chosen')} AS c,
               {_has('rejected')} AS r, {_has('completion')} AS k, {_has('label')} AS l
        FROM ({SHAPES_SQL}) s GROUP BY dataset) f"""


def _schemas(spark, folder):
    return inspection.record_schemas(shaped_records(spark, folder), "source", "doc_id")


@query(CHECKS_SQL)
def schema_checks(spark, folder):
    """The four checks on the first record's keys of every dataset."""
    return inspection.check_formats(_schemas(spark, folder))


@query(f"SELECT dataset, pos, \"column\" FROM ({SHAPES_SQL}) s WHERE {PROMPT}")
def find_columns(spark, folder):
    schemas = _schemas(spark, folder)
    return inspection.find_columns(schemas, ["prompt", "instruction", "question", "input"])


@query(f"""
    SELECT dataset, CASE WHEN len(methods) = 0 THEN 'None (dataset needs formatting)'
                         ELSE array_to_string(methods, ', ') END AS recommended
    FROM (SELECT dataset, list_filter([
            CASE WHEN sft_ready THEN 'SFT' WHEN prompt_col IS NOT NULL THEN 'SFT (needs mapping)' END,
            CASE WHEN dpo_ready THEN 'DPO' WHEN dpo_can_map THEN 'DPO (needs mapping)' END,
            CASE WHEN grpo_ready THEN 'GRPO' WHEN grpo_can_map THEN 'GRPO (needs mapping)' END,
            CASE WHEN kto_ready THEN 'KTO' END], lambda x: x IS NOT NULL) AS methods
          FROM ({CHECKS_SQL}) c) m""")
def recommend(spark, folder):
    checks = inspection.check_formats(_schemas(spark, folder))
    return inspection.recommend(checks).select("dataset", "recommended")


@query(f"""
    SELECT dataset,
           CASE WHEN sft_ready THEN 'READY' ELSE 'NEEDS MAPPING' END AS sft_status,
           CASE WHEN dpo_ready THEN 'READY' WHEN dpo_can_map THEN 'NEEDS MAPPING'
                ELSE 'INCOMPATIBLE' END AS dpo_status,
           CASE WHEN grpo_ready THEN 'READY' WHEN grpo_can_map THEN 'NEEDS MAPPING'
                ELSE 'INCOMPATIBLE' END AS grpo_status,
           CASE WHEN kto_ready THEN 'READY' ELSE 'INCOMPATIBLE' END AS kto_status
    FROM ({CHECKS_SQL}) c""")
def method_status(spark, folder):
    checks = inspection.check_formats(_schemas(spark, folder))
    names = [f"{m}_status" for m in ("sft", "dpo", "grpo", "kto")]
    return inspection.method_status(checks).select("dataset", *names)


@query(rf"""
    SELECT dataset, method, target, expression FROM (
        SELECT dataset, unnest(['SFT', 'DPO', 'DPO', 'DPO', 'GRPO']) AS method,
               unnest(['text', 'prompt', 'chosen', 'rejected', 'prompt']) AS target,
               unnest([
                   CASE WHEN NOT sft_ready AND prompt_col IS NOT NULL THEN
                       CASE WHEN has_context AND response_col IS NOT NULL THEN
                           'concat(''Instruction: '', `' || prompt_col || '`, ''\n\n'', '
                           || 'if(coalesce(`context`, '''') != '''', concat(''Context: '', `context`, '
                           || '''\n\n''), ''''), ''Response: '', `' || response_col || '`)'
                       WHEN response_col IS NOT NULL THEN
                           'concat(`' || prompt_col || '`, ''\n\n'', `' || response_col || '`)'
                       ELSE '`' || prompt_col || '`' END END,
                   CASE WHEN NOT dpo_ready AND dpo_can_map THEN '`' || prompt_col || '`' END,
                   CASE WHEN NOT dpo_ready AND dpo_can_map THEN '`' || chosen_col || '`' END,
                   CASE WHEN NOT dpo_ready AND dpo_can_map THEN '`' || rejected_col || '`' END,
                   CASE WHEN NOT grpo_ready AND grpo_can_map THEN '`' || prompt_col || '`' END
               ]) AS expression
        FROM ({CHECKS_SQL}) c) u
    WHERE expression IS NOT NULL""")
def mapping_spec(spark, folder):
    return inspection.mapping_spec(inspection.check_formats(_schemas(spark, folder)))


@query("""
    SELECT doc_id::VARCHAR AS doc_id,
           CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END AS text,
           lang, source, n_chars::VARCHAR AS n_chars
    FROM documents""")
def preview_rows(spark, folder):
    return inspection.preview(table(spark, folder, "documents"))


@query(f"""
    SELECT conv_id::VARCHAR AS conv_id, part::VARCHAR AS part, '0' AS slice,
           '[' || count(*)::VARCHAR || ' items] Keys: [''role'', ''content'']' AS conversations
    FROM ({PLACED_SQL}) p GROUP BY conv_id, part""")
def preview_lists(spark, folder):
    return inspection.preview(chat.turns_to_conversation(table(spark, folder, "conversations")))


@query("""
    SELECT lang, format('{:,}', count(*)) AS total_examples FROM documents GROUP BY lang""")
def count_examples(spark, folder):
    return inspection.count_examples(table(spark, folder, "documents"), "lang")


DOCUMENTS_SQL = f"""
    SELECT min(lang) AS config, doc_id, text, source FROM documents
    WHERE lang = (SELECT min(lang) FROM documents) AND {sql_split('doc_id')} = 'train'
    GROUP BY ALL"""
COMPATIBILITY = (
    '{"SFT":{"ready":true,"reason":"text","possible_prompt":null,"possible_response":null,'
    '"has_context":false},"DPO":{"ready":false,"can_map":false,"prompt_col":null,'
    '"chosen_col":null,"rejected_col":null},"GRPO":{"ready":false,"can_map":false,'
    '"prompt_col":null},"KTO":{"ready":false}}'
)
FEATURES = (
    '[{"name":"doc_id","type":"bigint"},{"name":"text","type":"string"},'
    '{"name":"source","type":"string"}]'
)


def _report(spark, folder):
    """The report on one language of the documents, none being called `default`."""
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", "source", F.col("lang").alias("config")
    )
    return inspection.inspect_split(
        spark, splits.train_test_split(documents, "doc_id"), "documents", "doc_id"
    )


@query(f"""
    SELECT 'documents' AS dataset,
           '{{"dataset":"documents","config":"' || min(config) || '","split":"train","total_examples":"'
           || format('{{:,}}', count(*)) || '","columns":["doc_id","text","source"],"features":'
           || '{FEATURES}' || ',"compatibility":' || '{COMPATIBILITY}'
           || ',"recommended_methods":["SFT"]}}' AS report
    FROM ({DOCUMENTS_SQL}) d""")
def inspect_json(spark, folder):
    return inspection.report_json(_report(spark, folder))


@query(f"""
    SELECT 'documents' AS dataset,
           array_to_string(['Dataset: documents', 'Config: ' || min(config), 'Split: train',
               'Total examples: ' || format('{{:,}}', count(*)), 'Columns:', '  doc_id: bigint',
               '  text: string', '  source: string', 'First row:',
               '  doc_id: ' || min(doc_id)::VARCHAR,
               '  text: ' || arg_min(CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...'
                                          ELSE text END, doc_id),
               '  source: ' || arg_min(source, doc_id), 'Methods:', '  SFT: READY',
               '  DPO: INCOMPATIBLE', '  GRPO: INCOMPATIBLE', '  KTO: INCOMPATIBLE',
               'Recommended training methods: SFT'], chr(10)) AS report
    FROM ({DOCUMENTS_SQL}) d""")
def inspect_report(spark, folder):
    return inspection.report_text(_report(spark, folder))


# ---- put together ----


def _damaged_records(spark, folder):
    """Records of which those of one source lack their category."""
    return records(spark, folder).withColumn(
        "category", F.when(F.col("category") != "src0", F.col("category"))
    )


@query(f"""
    WITH t AS (
        SELECT doc_id, {IDS_SQL.format('prompt || completion')} AS ids,
               len({IDS_SQL.format('prompt')}) AS n
        FROM ({PAIRS_SQL}) p WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src0')),
    u AS (SELECT doc_id, n, len(ids) AS m, list_resize(ids[1:256], 256, 0) AS ids FROM t)
    SELECT doc_id, {sql_split('doc_id')} AS split, array_to_string(ids, ' ') AS input_ids,
           array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= n THEN -100 ELSE x END), ' ')
               AS labels,
           array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= m THEN 1 ELSE 0 END), ' ')
               AS attention_mask
    FROM u""")
def records_to_tensors(spark, folder):
    """Complete records to ids and labels with their split."""
    made = flows.records_to_tensors(_damaged_records(spark, folder), "doc_id")
    return _joined(made, ("input_ids", "labels", "attention_mask"), "doc_id", "split")


@query("SELECT doc_id, 'category' AS missing FROM documents WHERE source = 'src0'")
def record_rejects(spark, folder):
    _, rejects = flows.with_rejects(_damaged_records(spark, folder))
    return rejects.select("doc_id", F.array_join("missing", ", ").alias("missing"))


@query(f"""
    SELECT split, count(*) AS examples, 8 AS effective_batch, count(*) // 8 AS steps_per_epoch,
           count(*) // 8 * 2 AS total_steps, greatest(1, count(*) // 8 // 10) AS log_steps,
           greatest(1, count(*) // 8 // 4) AS save_steps
    FROM (SELECT DISTINCT conv_id, {sql_split('conv_id')} AS split FROM conversations) s GROUP BY split""")
def conversation_plan(spark, folder):
    """Conversations to text, split, and the steps that training on them takes; each counts once, however many its parts."""
    text = flows.turns_to_text(table(spark, folder, "conversations"))
    return flows.training_plan(text.where("part = 0"), epochs=2)
