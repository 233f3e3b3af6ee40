"""Queries that generate rows, and those that size corpora and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.constants import (
    ANSWERS,
    CATEGORIES,
    CODE_TEMPLATES,
    QUESTION_POOL,
    TOPICS,
)
from tunewright.operators import split as splits
from tunewright.operators import synth
from tunewright.plans import flows, sizing
from tunewright.queries.adapt import PAIRS_SQL, RECORDS_SQL, records, table
from tunewright.queries.corpus import prompt_completion
from tunewright.queries.registry import query, sql_draw, sql_list, sql_split, sql_text
from tunewright.session import fresh_dir
from tunewright.sources import splits as split_files

RUBRIC_SQL = "'Correctness=0.6, Clarity=0.25, Conciseness=0.15'"


def _rubric_text():
    return F.array_join(
        F.transform(
            "evaluation_criteria", lambda c: F.concat_ws("=", c["aspect"], c["weight"].cast("string"))
        ),
        ", ",
    )


_answers = " ".join(
    f"WHEN '{name}' THEN replace({sql_text(text)}, '{{question}}', question)"
    for name, text in ANSWERS.items()
)
_pools = " ".join(
    f"WHEN '{name}' THEN {sql_list(items)}" for name, items in QUESTION_POOL.items()
)


@query(f"""
    SELECT id, category, question, CASE category {_answers} END AS example_answer,
           {RUBRIC_SQL} AS rubric,
           'Model should check correctness, clarity, and concision.' AS correctness
    FROM (SELECT id, category, (CASE category {_pools} END)[{sql_draw(42, 'id')} % 5 + 1] AS question
          FROM (SELECT doc_id AS id, {sql_list(CATEGORIES)}[doc_id % 7 + 1] AS category
                FROM documents) c) q""")
def synth_round_robin(spark, folder):
    """A generated record per document number."""
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    made = synth.generate_round_robin(ids)
    return made.withColumn("evaluation_criteria", _rubric_text()).withColumnRenamed(
        "evaluation_criteria", "rubric"
    )


@query(f"""
    WITH r AS ({RECORDS_SQL}), n AS (SELECT count(*) AS n FROM r),
    g AS (SELECT id, {sql_list(CATEGORIES)}[{sql_draw('42:category', 'id')} % 7 + 1] AS category,
                 {sql_list(TOPICS)}[{sql_draw('42:topic', 'id')} % 3 + 1] AS topic
          FROM (SELECT unnest(range(n + 1, n + n // 4 + 1)) AS id FROM n) i)
    SELECT doc_id, category, question, example_answer, correctness, NULL::VARCHAR AS rubric FROM r
    UNION ALL
    SELECT id, category,
           '[Synthetic] Question ' || id::VARCHAR || ' for ' || category || ': ' || topic,
           '[Answer ' || category || '] This is a synthetic answer example for the question posed.',
           NULL, {RUBRIC_SQL} FROM g""")
def top_up(spark, folder):
    """Records topped up to five quarters of their number."""
    existing = records(spark, folder)
    count = existing.count()
    topped = synth.top_up(existing, count + count // 4, count=count, number="doc_id")
    return topped.withColumn("evaluation_criteria", _rubric_text()).withColumnRenamed(
        "evaluation_criteria", "rubric"
    )


def _template_sql(rows: str, start: str) -> str:
    """Template examples for the numbers `k` of `rows`."""
    solutions = sql_list([s for _, s in CODE_TEMPLATES])
    problems = sql_list([p for p, _ in CODE_TEMPLATES])
    return f"""
    SELECT k, '### Problem: ' || {problems}[k % 10 + 1] || ' (example ' || number::VARCHAR || ')'
               || chr(10) || '### Solution:' || chr(10) AS prompt,
           CASE WHEN number % 5 = 0
                THEN replace({solutions}[k % 10 + 1], '(a, b):', '(a: int, b: int) -> int:')
                WHEN number % 7 = 0
                THEN '\"\"\"Simple implementation\"\"\"' || chr(10) || {solutions}[k % 10 + 1]
                ELSE {solutions}[k % 10 + 1] END AS completion
    FROM (SELECT k, k + {start} + 1 AS number FROM {rows}) t"""


@query(_template_sql("(SELECT doc_id AS k FROM documents) d", "3"))
def template_batch(spark, folder):
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("k"))
    return synth.template_batch(ids, start=3, key="k")


TRAIN_COUNTS_SQL = f"""
    SELECT source, count(*) FILTER (WHERE {sql_split('doc_id')} = 'train') AS train
    FROM documents GROUP BY source"""


@query(f"""
    SELECT source, train, greatest(0, 500 - train)::BIGINT AS remaining,
           ((greatest(0, 500 - train) + 99) // 100)::BIGINT AS batches,
           (train + (greatest(0, 500 - train) + 99) // 100 * 100)::BIGINT AS final_count
    FROM ({TRAIN_COUNTS_SQL}) c""")
def plan_batches(spark, folder):
    """Batches each source needs to reach its target."""
    documents = table(spark, folder, "documents").select("doc_id", "source")
    split = splits.train_test_split(documents, "doc_id")
    train = F.count_if(F.col("split") == "train").alias("train")
    return synth.plan_batches(split.groupBy("source").agg(train))


_new_rows = f"""(SELECT unnest(range((2 * n - train + 99) // 100 * 100)) AS k FROM (
        SELECT count(*) AS n, count(*) FILTER (WHERE {sql_split('doc_id')} = 'train') AS train
        FROM documents) c) r"""
_train = f"(SELECT count(*) FROM documents WHERE {sql_split('doc_id')} = 'train')"


@query(f"""
    SELECT doc_id AS k, prompt, completion, {sql_split('doc_id')} AS split FROM ({PAIRS_SQL}) p
    UNION ALL
    SELECT k, prompt, completion, 'train' FROM ({_template_sql(_new_rows, _train)}) g""")
def merge_batch(spark, folder):
    """All batches towards twice the corpus in one range, appended to train."""
    documents = table(spark, folder, "documents").select("doc_id")
    counts = splits.split_counts(splits.train_test_split(documents, "doc_id"))
    goal = 2 * (F.col("train") + F.col("test"))
    plan = synth.plan_batches(counts, target=goal).first()
    old = splits.train_test_split(prompt_completion(spark, folder), "doc_id")
    numbers = spark.range(plan["batches"] * 100).withColumnRenamed("id", "k")
    batch = synth.template_batch(numbers, start=plan["train"], key="k", batch=100)
    return synth.merge_batch(old.withColumnRenamed("doc_id", "k"), batch)


@query(f"""
    SELECT prompt, completion, {sql_split('doc_id')} AS split, 0::BIGINT AS batch FROM ({PAIRS_SQL}) p
    UNION ALL
    SELECT prompt, completion, 'train', k // 100 + 1 FROM ({_template_sql(_new_rows, _train)}) g""")
def grow_corpus(spark, folder):
    """A stored corpus grown to twice its size as a new version."""
    base = fresh_dir(spark, "corpus")
    pairs = splits.train_test_split(prompt_completion(spark, folder), "doc_id").drop("doc_id")
    split_files.save_version(pairs, base, "20240101T000000")
    goal = 2 * table(spark, folder, "documents").count()
    flows.grow_corpus(spark, base, "20240102T000000", target=goal)
    return split_files.read_version(spark, base)


# ---- sizing ----

STEPS_SQL = """
    SELECT source, count(*) AS examples, 8 AS effective_batch,
           (count(*) // 8)::BIGINT AS steps_per_epoch, (count(*) // 8 * 3)::BIGINT AS total_steps
    FROM documents GROUP BY source"""


@query(f"""
    SELECT *, greatest(1, steps_per_epoch // 10)::BIGINT AS log_steps,
           greatest(1, steps_per_epoch // 4)::BIGINT AS save_steps
    FROM ({STEPS_SQL}) s""")
def step_plan(spark, folder):
    plan = sizing.step_plan(table(spark, folder, "documents"), "source", epochs=3)
    return sizing.epoch_intervals(plan)


@query(f"""
    SELECT source, total_steps AS max_steps, greatest(1, total_steps // 20)::BIGINT AS log_steps,
           greatest(1, total_steps // 4)::BIGINT AS save_steps,
           greatest(1, total_steps // 5)::BIGINT AS eval_steps
    FROM ({STEPS_SQL}) s""")
def step_intervals(spark, folder):
    plan = sizing.step_plan(table(spark, folder, "documents"), "source", epochs=3)
    return sizing.step_intervals(plan.select("source", F.col("total_steps").alias("max_steps")))


def _models(spark, folder):
    """Parts as a catalogue of models: half the part's size is its billions of parameters."""
    size = F.col("p_size")
    number = F.concat(
        F.expr("p_size div 2").cast("string"), F.when(size % 2 == 1, F.lit(".5")).otherwise(F.lit(""))
    )
    name = F.concat(F.translate("p_name", " ", "-"), F.lit("-"), number, F.lit("B"))
    return table(spark, folder, "part").select("p_partkey", name.alias("model"))


MODELS_SQL = """
    SELECT p_partkey, replace(p_name, ' ', '-') || '-' || (p_size // 2)::VARCHAR
           || CASE WHEN p_size % 2 = 1 THEN '.5' ELSE '' END || 'B' AS model, p_size / 2 AS params
    FROM part"""


@query(f"""
    SELECT p_partkey, model, params::DOUBLE AS params,
           CASE WHEN model LIKE '%0.5B%' THEN 0.5 WHEN model LIKE '%1.5B%' THEN 1.5
                WHEN model LIKE '%3B%' THEN 3 WHEN model LIKE '%7B%' THEN 7
                WHEN model LIKE '%13B%' THEN 13
                ELSE coalesce(try_cast(replace(model, 'B', '') AS DOUBLE), 1.0) END::DOUBLE AS compat
    FROM ({MODELS_SQL}) m""")
def model_size(spark, folder):
    return _models(spark, folder).select(
        "p_partkey",
        "model",
        sizing.model_size(F.col("model")).alias("params"),
        sizing.model_size(F.col("model"), compat=True).alias("compat"),
    )


FITS = "CASE WHEN {0} <= 16 THEN 't4-small' WHEN {0} <= 24 THEN 'l4x1' WHEN {0} <= 40 THEN 'a100-large' WHEN {0} <= 48 THEN 'a10g-largex2' WHEN {0} <= 96 THEN 'a10g-largex4' END"


@query(f"""
    SELECT p_partkey, params::DOUBLE AS params, (params * 20)::DOUBLE AS full_gb,
           {FITS.format('params * 20')} AS full_fits, (params * 4)::DOUBLE AS adapters_gb,
           {FITS.format('params * 4')} AS adapters_fits
    FROM ({MODELS_SQL}) m""")
def memory_fit(spark, folder):
    """Memory each model needs, trained in full and with adapters, and the flavour that has it."""
    models = _models(spark, folder).select(
        "p_partkey", sizing.model_size(F.col("model")).alias("params")
    )
    full = sizing.memory_fit(models).withColumnsRenamed({"need_gb": "full_gb", "fits": "full_fits"})
    return sizing.memory_fit(full, tuning="adapters").withColumnsRenamed(
        {"need_gb": "adapters_gb", "fits": "adapters_fits"}
    )


@query(f"""
    SELECT p_partkey, params::DOUBLE AS params,
           CASE WHEN params < 1 THEN 't4-small' WHEN params < 3 THEN 'a10g-small'
                WHEN params < 7 THEN 'a10g-large' WHEN params < 13 THEN 'a10g-large (LoRA) or a100-large'
                ELSE 'a100-large (LoRA required)' END AS tier
    FROM ({MODELS_SQL}) m""")
def flavor_tier(spark, folder):
    models = _models(spark, folder).select(
        "p_partkey", sizing.model_size(F.col("model")).alias("params")
    )
    return sizing.flavor_tier(models)


RATES_SQL = """(VALUES ('t4-small', 0.75::DOUBLE, 2.0::DOUBLE), ('t4-medium', 1.5, 1.5),
    ('l4x1', 2.5, 1.2), ('a10g-small', 3.5, 1.3), ('a10g-large', 5.0, 1.0),
    ('a10g-largex2', 10.0, 0.6), ('a10g-largex4', 20.0, 0.4), ('a100-large', 10.0, 0.7))
    h(flavor, usd_per_hour, mult)"""

REPORT_COLUMNS = """round(hours, 9) AS hours, round(hours * usd_per_hour, 9) AS cost,
           round(hours * 1.3::DOUBLE, 9) AS timeout_hours"""


def _rounded(report):
    return report.withColumns({c: F.round(c, 9) for c in ("hours", "cost", "timeout_hours")})


@query(f"""
    SELECT dataset, flavor, examples, {REPORT_COLUMNS}, hours > 4 AS long_warning,
           flavor NOT IN ('a10g-largex2', 'a10g-largex4', 'a100-large') AS large_model_warning
    FROM (SELECT source AS dataset, flavor, examples, usd_per_hour,
                 0.1::DOUBLE * 7 * (examples / 1000) * 3 * mult AS hours
          FROM (SELECT source, count(*) AS examples FROM documents GROUP BY source) d, {RATES_SQL}) r""")
def cost_report(spark, folder):
    """Hours, cost and timeout of training a 7B model on every source, for every flavour."""
    documents = table(spark, folder, "documents")
    report = sizing.cost_warnings(sizing.cost_report(documents, "source", "model-7B"))
    return _rounded(report).select(
        "dataset", "flavor", "examples", "hours", "cost", "timeout_hours",
        "long_warning", "large_model_warning",
    )


FLAVORS = [
    "t4-small", "t4-medium", "l4x1", "a10g-small", "a10g-large", "a10g-largex2", "a10g-largex4",
    "a100-large", "cpu-basic",
]
MODEL_NAMES = ["base-0.5B", "base-1.5B", "base-3B", "base-7B", "base-13B"]


def _jobs(spark, folder):
    """Orders as training jobs; urgent ones state their dataset's size."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def by(items, number):
        index = F.pmod(number, F.lit(len(items))).cast("int") + 1
        return F.element_at(F.array(*[F.lit(i) for i in items]), index)

    return table(spark, folder, "orders").select(
        "o_orderkey",
        by(MODEL_NAMES, key).alias("model"),
        F.concat(F.lit("src"), F.pmod(customer, F.lit(25)).cast("string")).alias("dataset"),
        by(FLAVORS, customer).alias("flavor"),
        F.when(F.col("o_orderpriority") == "1-URGENT", customer).alias("dataset_size"),
        (F.pmod(key, F.lit(4)) + 1).cast("int").alias("epochs"),
    )


@query(f"""
    SELECT o_orderkey, j.flavor, examples, {REPORT_COLUMNS}
    FROM (SELECT o_orderkey, h.flavor, usd_per_hour, examples,
                 0.1::DOUBLE * params * (examples / 1000) * epochs * mult AS hours
          FROM (SELECT o_orderkey, {sql_list(FLAVORS)}[o_custkey % 9 + 1] AS flavor,
                       [0.5::DOUBLE, 1.5, 3, 7, 13][o_orderkey % 5 + 1] AS params,
                       o_orderkey % 4 + 1 AS epochs,
                       coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END,
                                c.examples, 10000) AS examples
                FROM orders LEFT JOIN (SELECT source, count(*) AS examples FROM documents
                                       GROUP BY source) c
                     ON c.source = 'src' || (o_custkey % 25)::VARCHAR) o
          JOIN {RATES_SQL} ON o.flavor = h.flavor) j""")
def job_report(spark, folder):
    """Jobs with looked-up size, rate and multiplier; unknown flavours are left out."""
    sizes = (
        table(spark, folder, "documents")
        .groupBy(F.col("source").alias("dataset"))
        .agg(F.count(F.lit(1)).alias("num_examples"))
    )
    jobs = sizing.lookup_hardware(_jobs(spark, folder), sizing.hardware_table(spark))
    sized = sizing.lookup_size(jobs, sizes).withColumn("params", sizing.model_size(F.col("model")))
    return _rounded(sizing.job_report(sized)).select(
        "o_orderkey", "flavor", "examples", "hours", "cost", "timeout_hours"
    )
