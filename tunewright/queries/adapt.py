"""The given tables seen as the tables this package works on.

No function drops a turn, prompt or answer that its form of data has a place for; the SQL texts say
the same for the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(conversations: DataFrame, role: str, turn: str, text: str) -> DataFrame:
    """Texts of one role, to be met by conversation and turn."""
    said = conversations.where(F.col("role") == role)
    return said.select("conv_id", F.col("turn").alias(turn), F.col("text").alias(text))


def exchanges(conversations: DataFrame) -> DataFrame:
    """Every assistant turn with the user turn before it and the conversation's first system turn.

    Turn numbers are found first, over rows without texts; texts are then met by conversation and turn.
    """
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    spoken = lambda role: F.when(F.col("role") == role, F.col("turn"))
    turns = (
        conversations.select("conv_id", "turn", "role")
        .withColumn("asked", F.last(spoken("user"), ignorenulls=True).over(before))
        .withColumn("framed", F.min(spoken("system")).over(Window.partitionBy("conv_id")))
        .where(F.col("role") == "assistant")
        .drop("role")
    )
    return (
        turns.join(_texts(conversations, "assistant", "turn", "response"), ["conv_id", "turn"])
        .join(_texts(conversations, "user", "asked", "prompt"), ["conv_id", "asked"], "left")
        .join(_texts(conversations, "system", "framed", "context"), ["conv_id", "framed"], "left")
        .select("conv_id", "turn", "prompt", "response", "context")
    )


EXCHANGES_SQL = """
    SELECT conv_id, turn, prompt, response, context FROM (
        SELECT conv_id, turn, role, text AS response,
               last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (
                   PARTITION BY conv_id ORDER BY turn
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prompt,
               first_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER (
                   PARTITION BY conv_id ORDER BY turn
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS context
        FROM conversations) t
    WHERE role = 'assistant'"""


PLACED_SQL = """
    SELECT *, coalesce(sum(64 + coalesce(strlen(role), 0) + coalesce(strlen(text), 0)) OVER (
                  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 16777216 AS part
    FROM conversations"""


def prompts(conversations: DataFrame) -> DataFrame:
    """Every user turn."""
    return _texts(conversations, "user", "turn", "prompt")


PROMPTS_SQL = "SELECT conv_id, turn, text AS prompt FROM conversations WHERE role = 'user'"


def preferences(conversations: DataFrame) -> DataFrame:
    """Every prompt with the answer that it got, over the conversation's next answer (the first one after the last).

    So a conversation of n > 1 answers gives n pairs. The other answer's turn is found over numbers only.
    """
    answers = Window.partitionBy("conv_id").orderBy("turn")
    others = conversations.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.coalesce(F.lead("turn").over(answers), F.first("turn").over(answers)).alias("other")
    )
    asked = exchanges(conversations).select("conv_id", "turn", F.col("prompt").alias("question"), F.col("response").alias("winner"))
    return (
        asked.join(others.where("other <> turn"), ["conv_id", "turn"])
        .join(_texts(conversations, "assistant", "other", "loser"), ["conv_id", "other"])
        .select("conv_id", "turn", "question", "winner", "loser")
    )


PREFERENCES_SQL = f"""
    SELECT e.conv_id, e.turn, e.prompt AS question, e.response AS winner, o.response AS loser
    FROM (SELECT *, coalesce(lead(turn) OVER w, first_value(turn) OVER w) AS other
          FROM ({EXCHANGES_SQL}) x WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) e
    JOIN ({EXCHANGES_SQL}) o ON o.conv_id = e.conv_id AND o.turn = e.other
    WHERE e.other <> e.turn"""


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as interview records; unlabelled ones have no `correctness`."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    first_line = F.substring_index("text", "\n", 1)
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("category"),
        first_line.alias("question"),
        F.substring(F.col("text"), F.length(first_line) + 2, F.length("text")).alias("example_answer"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("correctness"),
    )


RECORDS_SQL = """
    SELECT d.doc_id, d.source AS category,
           split_part(d.text, chr(10), 1) AS question,
           substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS example_answer,
           'quality ' || l.quality::VARCHAR AS correctness
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

PAIRS_SQL = f"""
    SELECT doc_id, category || ' Question: ' || question || chr(10) || 'Answer:' AS prompt,
           ' ' || example_answer || chr(10) || 'Evaluation: '
               || coalesce(correctness, 'Model should check correctness, clarity, and concision.')
               AS completion
    FROM ({RECORDS_SQL}) r"""


def shaped_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as JSON records whose keys depend on their source: five shapes of datasets."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    shape = F.pmod(F.substring("source", 4, 9).cast("int"), F.lit(5))
    line = F.substring_index("text", "\n", 1)
    labelled = F.when(F.col("quality").isNotNull(), F.col("quality") == 1)
    english = F.when(F.col("lang") == "en", F.col("lang"))
    text = F.col("text")
    raw = (
        F.when(shape == 0, _json(question=line, answer=text, context=english))
        .when(shape == 1, _json(prompt=line, completion=text, label=labelled))
        .when(shape == 2, _json(prompt=line, chosen=text, rejected=line))
        .when(shape == 3, _json(question=line, dispreferred=line, preferred=text))
        .otherwise(_json(text=text, lang=F.col("lang")))
    )
    return documents.join(labels, "doc_id", "left").select("doc_id", "source", raw.alias("raw"))


def _json(**fields):
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


SHAPES_SQL = """
    SELECT dataset, (pos - 1)::INTEGER AS pos, keys[pos] AS "column" FROM (
        SELECT dataset, keys, unnest(range(1, len(keys) + 1)) AS pos FROM (
            SELECT source AS dataset, arg_min(keys, doc_id) AS keys FROM (
                SELECT d.doc_id, d.source, CASE substr(d.source, 4)::INTEGER % 5
                    WHEN 0 THEN CASE WHEN d.lang = 'en' THEN ['question', 'answer', 'context']
                                     ELSE ['question', 'answer'] END
                    WHEN 1 THEN CASE WHEN l.quality IS NOT NULL THEN ['prompt', 'completion', 'label']
                                     ELSE ['prompt', 'completion'] END
                    WHEN 2 THEN ['prompt', 'chosen', 'rejected']
                    WHEN 3 THEN ['question', 'dispreferred', 'preferred']
                    ELSE ['text', 'lang'] END AS keys
                FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) r
            GROUP BY source) f) u"""


METRIC_NAMES = {
    "view": "train_loss",
    "click": "eval_loss",
    "purchase": "learning_rate",
    "signup": "gpu_util",
    "error": "samples_per_second",
}


def as_metrics(events: DataFrame) -> DataFrame:
    """Events as run metrics: a run per user, a metric per event type, the event number as step."""
    names = F.create_map(*[F.lit(x) for pair in METRIC_NAMES.items() for x in pair])
    user = F.col("user_id")
    return events.select(
        F.concat(F.lit("project-"), F.pmod(user, F.lit(3)).cast("string")).alias("project"),
        F.concat(F.lit("run-"), user.cast("string")).alias("run"),
        F.concat(F.lit("group-"), F.pmod(user, F.lit(10)).cast("string")).alias("grp"),
        F.col("event_id").alias("step"),
        "ts",
        F.element_at(names, F.col("event_type")).alias("metric"),
        "value",
    )


METRICS_SQL = """
    SELECT 'project-' || (user_id % 3)::VARCHAR AS project, 'run-' || user_id::VARCHAR AS run,
           'group-' || (user_id % 10)::VARCHAR AS grp, event_id AS step, ts,
           CASE event_type WHEN 'view' THEN 'train_loss' WHEN 'click' THEN 'eval_loss'
                WHEN 'purchase' THEN 'learning_rate' WHEN 'signup' THEN 'gpu_util'
                WHEN 'error' THEN 'samples_per_second' END AS metric, value
    FROM events"""


def as_lines(events: DataFrame) -> DataFrame:
    """Events as log lines: a run per user, with a primary, a fallback and a monitor log."""
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run"),
        F.when(kind.isin("view", "click"), F.lit("train_fresh.log"))
        .when(kind == "signup", F.lit("monitor.log"))
        .otherwise(F.lit("train.log"))
        .alias("log"),
        F.when(kind.isin("view", "click"), F.lit(0))
        .when(kind == "signup", F.lit(2))
        .otherwise(F.lit(1))
        .alias("priority"),
        F.col("event_id").alias("seq"),
        "ts",
        F.when(kind == "view", F.concat(F.lit("models/checkpoint-"), F.col("event_id")))
        .otherwise(F.concat_ws(" ", kind, "props"))
        .alias("line"),
        "value",
    )


LINES_SQL = """
    SELECT 'run-' || user_id::VARCHAR AS run,
           CASE WHEN event_type IN ('view', 'click') THEN 'train_fresh.log'
                WHEN event_type = 'signup' THEN 'monitor.log' ELSE 'train.log' END AS log,
           CASE WHEN event_type IN ('view', 'click') THEN 0
                WHEN event_type = 'signup' THEN 2 ELSE 1 END AS priority,
           event_id AS seq, ts,
           CASE event_type WHEN 'view' THEN 'models/checkpoint-' || event_id::VARCHAR
                ELSE event_type || ' ' || props END AS line, value
    FROM events"""


def as_gpu_lines(events: DataFrame, *more: Column) -> DataFrame:
    """Events as telemetry lines of seven fields."""
    util = F.pmod(F.floor("value"), F.lit(101))
    fields = [
        F.pmod(F.col("user_id"), F.lit(8)), F.lit("NVIDIA A10G"), util,
        F.pmod(util * 7, F.lit(101)), F.lit(23028), util * 200 + 31, F.lit(35) + F.floor(util / 2),
    ]
    return events.select(
        F.col("event_id").alias("seq"), "ts",
        F.concat_ws(", ", *[f.cast("string") for f in fields]).alias("line"), *more,
    )


GPU_SQL = """
    SELECT event_id AS seq, ts, (user_id % 8)::INTEGER AS "index", 'NVIDIA A10G' AS name,
           util, (util * 7 % 101)::INTEGER AS mem_util, 23028 AS mem_total,
           (util * 200 + 31)::INTEGER AS mem_used, (35 + util // 2)::INTEGER AS temp
    FROM (SELECT *, (floor(value)::BIGINT % 101)::INTEGER AS util FROM events) e"""


def naive(df: DataFrame, *names: str) -> DataFrame:
    """Times as UTC times without a zone."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})
