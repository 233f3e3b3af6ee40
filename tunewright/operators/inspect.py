"""Which training formats a dataset's columns fit, and how to map the others.

Checks take a table of schemas `(dataset, pos, column)`, one row per column, so one job checks any
number of datasets; `schema_table` makes it from DataFrames and `record_schemas` from JSON records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunewright.constants import (
    CHOSEN_PATTERNS,
    NO_METHOD,
    PROMPT_PATTERNS,
    REJECTED_PATTERNS,
    RESPONSE_PATTERNS,
)
from tunewright.functions.text import fill, preview_cell
from tunewright.operators.position import first_by
from tunewright.sources.catalog import choose_config, split_catalog

# the mappings of `functions.text.sft_text` as SQL expressions of a dataset's own columns
PAIR_EXPRESSION = r"concat({prompt}, '\n\n', {response})"
CONTEXT_EXPRESSION = (
    r"concat('Instruction: ', {prompt}, '\n\n', "
    r"if(coalesce(`context`, '') != '', concat('Context: ', `context`, '\n\n'), ''), "
    r"'Response: ', {response})"
)


def schema_table(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """The schema table of some DataFrames; reads no data."""
    rows = [
        F.struct(F.lit(name).alias("dataset"), F.lit(pos).alias("pos"), F.lit(c).alias("column"))
        for name, df in frames.items()
        for pos, c in enumerate(df.columns)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def record_schemas(records: DataFrame, dataset: str, order: str, raw: str = "raw") -> DataFrame:
    """The schema table of JSON records: each dataset has the keys of its first record."""
    keys = records.select(
        F.col(dataset).alias("dataset"),
        F.col(order).alias("order"),
        F.json_object_keys(F.col(raw)).alias("names"),
    )
    first = keys.groupBy("dataset").agg(F.min_by("names", "order").alias("names"))
    return first.select("dataset", F.posexplode("names").alias("pos", "column"))


def matches(column: Column, patterns: list[str]) -> Column:
    """True where the lower-cased name contains any pattern."""
    name = F.lower(column)
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.contains(name, F.lit(pattern))
    return found


def find_columns(schemas: DataFrame, patterns: list[str]) -> DataFrame:
    """The schema rows whose name matches any pattern; `pos` keeps the column order."""
    return schemas.where(matches(F.col("column"), patterns))


def check_formats(schemas: DataFrame) -> DataFrame:
    """All four format checks and the recommendation, one row per dataset."""
    name = F.col("column")

    def first(patterns):
        return F.min_by(name, F.when(matches(name, patterns), F.col("pos")))

    def has(exact):
        return F.bool_or(name == exact)

    found = schemas.groupBy("dataset").agg(
        first(PROMPT_PATTERNS).alias("prompt_col"),
        first(RESPONSE_PATTERNS).alias("response_col"),
        first(CHOSEN_PATTERNS).alias("chosen_col"),
        first(REJECTED_PATTERNS).alias("rejected_col"),
        *[
            has(exact).alias(f"has_{exact}")
            for exact in (
                "messages", "text", "prompt", "completion", "context", "chosen", "rejected", "label",
            )
        ],
    )
    pair = F.col("has_prompt") & F.col("has_completion")
    prompt = F.col("prompt_col").isNotNull()
    no_preference = ~F.col("has_chosen") & ~F.col("has_rejected")
    return (
        found.withColumn(
            "sft_reason",
            F.when(F.col("has_messages"), "messages")
            .when(F.col("has_text"), "text")
            .when(pair, "prompt+completion"),
        )
        .withColumn("sft_ready", F.col("sft_reason").isNotNull())
        .withColumn(
            "dpo_ready", F.col("has_prompt") & F.col("has_chosen") & F.col("has_rejected")
        )
        .withColumn(
            "dpo_can_map",
            prompt & F.col("chosen_col").isNotNull() & F.col("rejected_col").isNotNull(),
        )
        .withColumn("grpo_ready", F.col("has_prompt") & no_preference)
        .withColumn("grpo_can_map", prompt & no_preference)
        .withColumn("kto_ready", pair & F.col("has_label"))
        .select(
            "dataset", "sft_ready", "sft_reason", "prompt_col", "response_col", "has_context",
            "dpo_ready", "dpo_can_map", "chosen_col", "rejected_col",
            "grpo_ready", "grpo_can_map", "kto_ready",
        )
    )


def check_sft(schemas: DataFrame) -> DataFrame:
    return check_formats(schemas).select(
        "dataset",
        F.col("sft_ready").alias("ready"),
        F.col("sft_reason").alias("reason"),
        F.col("prompt_col").alias("possible_prompt"),
        F.col("response_col").alias("possible_response"),
        "has_context",
    )


def check_dpo(schemas: DataFrame) -> DataFrame:
    return check_formats(schemas).select(
        "dataset",
        F.col("dpo_ready").alias("ready"),
        F.col("dpo_can_map").alias("can_map"),
        "prompt_col", "chosen_col", "rejected_col",
    )


def check_grpo(schemas: DataFrame) -> DataFrame:
    return check_formats(schemas).select(
        "dataset",
        F.col("grpo_ready").alias("ready"),
        F.col("grpo_can_map").alias("can_map"),
        "prompt_col",
    )


def check_kto(schemas: DataFrame) -> DataFrame:
    return check_formats(schemas).select("dataset", F.col("kto_ready").alias("ready"))


def recommend(checks: DataFrame) -> DataFrame:
    """Add `methods` (array) and `recommended` (text) to the result of `check_formats`."""

    def offer(method, ready, mappable):
        return F.when(ready, F.lit(method)).when(mappable, F.lit(f"{method} (needs mapping)"))

    methods = F.array_compact(
        F.array(
            offer("SFT", F.col("sft_ready"), F.col("prompt_col").isNotNull()),
            offer("DPO", F.col("dpo_ready"), F.col("dpo_can_map")),
            offer("GRPO", F.col("grpo_ready"), F.col("grpo_can_map")),
            F.when(F.col("kto_ready"), F.lit("KTO")),
        )
    )
    text = F.when(F.size("methods") > 0, F.array_join("methods", ", ")).otherwise(F.lit(NO_METHOD))
    return checks.withColumn("methods", methods).withColumn("recommended", text)


def method_status(checks: DataFrame) -> DataFrame:
    """Status words per method. SFT has two: ready, or in need of mapping."""
    ready, mapping, none = F.lit("READY"), F.lit("NEEDS MAPPING"), F.lit("INCOMPATIBLE")
    return checks.withColumns(
        {
            "sft_status": F.when(F.col("sft_ready"), ready).otherwise(mapping),
            "dpo_status": F.when(F.col("dpo_ready"), ready)
            .when(F.col("dpo_can_map"), mapping)
            .otherwise(none),
            "grpo_status": F.when(F.col("grpo_ready"), ready)
            .when(F.col("grpo_can_map"), mapping)
            .otherwise(none),
            "kto_status": F.when(F.col("kto_ready"), ready).otherwise(none),
        }
    )


def mapping_spec(checks: DataFrame) -> DataFrame:
    """Rows (dataset, method, target, expression): the SQL expression each target column needs.

    A method that is ready, or cannot be mapped, has no rows.
    """

    def quoted(name):
        return F.concat(F.lit("`"), F.replace(F.col(name), F.lit("`"), F.lit("``")), F.lit("`"))

    p, r = quoted("prompt_col"), quoted("response_col")
    with_context = fill(CONTEXT_EXPRESSION, prompt=p, response=r)
    pair = fill(PAIR_EXPRESSION, prompt=p, response=r)
    sft = (
        F.when(F.col("has_context") & F.col("response_col").isNotNull(), with_context)
        .when(F.col("response_col").isNotNull(), pair)
        .otherwise(p)
    )

    def row(method, target, expression, wanted):
        item = F.struct(
            F.lit(method).alias("method"),
            F.lit(target).alias("target"),
            expression.alias("expression"),
        )
        return F.when(wanted, item)

    map_sft = ~F.col("sft_ready") & F.col("prompt_col").isNotNull()
    map_dpo = ~F.col("dpo_ready") & F.col("dpo_can_map")
    map_grpo = ~F.col("grpo_ready") & F.col("grpo_can_map")
    rows = F.array_compact(
        F.array(
            row("SFT", "text", sft, map_sft),
            row("DPO", "prompt", p, map_dpo),
            row("DPO", "chosen", quoted("chosen_col"), map_dpo),
            row("DPO", "rejected", quoted("rejected_col"), map_dpo),
            row("GRPO", "prompt", p, map_grpo),
        )
    )
    return checks.select("dataset", F.inline(rows))


def preview(df: DataFrame, max_chars: int = 150) -> DataFrame:
    """Every cell as a short text."""
    return df.select(
        *[
            preview_cell(F.col(f"`{f.name}`"), f.dataType, max_chars).alias(f.name)
            for f in df.schema.fields
        ]
    )


def count_examples(df: DataFrame, *by: str) -> DataFrame:
    """Row counts with thousands separators."""
    return df.groupBy(*by).agg(F.format_number(F.count(F.lit(1)), 0).alias("total_examples"))


def inspect(
    spark: SparkSession, df: DataFrame, dataset: str, order: str,
    config="default", split: str = "train", max_chars: int = 150,
) -> DataFrame:
    """One report row: columns, features, checks, recommendation and a preview of the first row.

    The checks read names only; the first row is found by its key alone, the count is a scan without columns.
    `config` is a name, or a column that holds it.
    """
    checks = method_status(recommend(check_formats(schema_table(spark, {dataset: df}))))
    features = F.array(
        *[
            F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
            for f in df.schema.fields
        ]
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in df.columns]
    )
    example = preview(first_by(df, order, 0, 1), max_chars).select(cells).scalar()
    total = df.agg(F.format_number(F.count(F.lit(1)), 0)).scalar()
    return checks.select(
        "dataset",
        (F.lit(config) if isinstance(config, str) else config).alias("config"),
        F.lit(split).alias("split"),
        total.alias("total_examples"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        features.alias("features"),
        F.struct(
            F.struct(
                F.col("sft_ready").alias("ready"),
                F.col("sft_reason").alias("reason"),
                F.col("prompt_col").alias("possible_prompt"),
                F.col("response_col").alias("possible_response"),
                "has_context",
            ).alias("SFT"),
            F.struct(
                F.col("dpo_ready").alias("ready"),
                F.col("dpo_can_map").alias("can_map"),
                "prompt_col", "chosen_col", "rejected_col",
            ).alias("DPO"),
            F.struct(
                F.col("grpo_ready").alias("ready"),
                F.col("grpo_can_map").alias("can_map"),
                "prompt_col",
            ).alias("GRPO"),
            F.struct(F.col("kto_ready").alias("ready")).alias("KTO"),
        ).alias("compatibility"),
        F.col("methods").alias("recommended_methods"),
        "recommended",
        "sft_status", "dpo_status", "grpo_status", "kto_status",
        example.alias("example"),
    )


def inspect_split(
    spark: SparkSession, df: DataFrame, dataset: str, order: str, config: str = "default",
    split: str = "train", config_column: str = "config", split_column: str = "split",
    max_chars: int = 150,
) -> DataFrame:
    """Inspect one configuration and split of a table; an absent configuration falls back to the
    first by name."""
    known = split_catalog(df, config_column, split_column)
    chosen = choose_config(known, config, split).select("config").scalar()
    part = df.where((F.col(config_column) == chosen) & (F.col(split_column) == split))
    rows = part.drop(config_column, split_column)
    return inspect(spark, rows, dataset, order, chosen, split, max_chars)


def report_json(report: DataFrame) -> DataFrame:
    """Reports as one JSON text each."""
    fields = F.struct(
        "dataset", "config", "split", "total_examples", "columns", "features", "compatibility",
        "recommended_methods",
    )
    return report.select("dataset", F.to_json(fields, {"ignoreNullFields": "false"}).alias("report"))


def report_text(report: DataFrame) -> DataFrame:
    """Reports as one text each, for people."""

    def line(label, value):
        return F.concat(F.lit(label), value)

    def lines(array, show):
        return F.array_join(F.transform(array, show), "\n")

    text = F.concat_ws(
        "\n",
        line("Dataset: ", F.col("dataset")),
        line("Config: ", F.col("config")),
        line("Split: ", F.col("split")),
        line("Total examples: ", F.col("total_examples")),
        F.lit("Columns:"),
        lines("features", lambda f: F.concat(F.lit("  "), f["name"], F.lit(": "), f["type"])),
        F.lit("First row:"),
        lines("example", lambda c: F.concat(F.lit("  "), c["name"], F.lit(": "), c["value"])),
        F.lit("Methods:"),
        *[line(f"  {m.upper()}: ", F.col(f"{m}_status")) for m in ("sft", "dpo", "grpo", "kto")],
        line("Recommended training methods: ", F.col("recommended")),
    )
    return report.select("dataset", text.alias("report"))
