"""Registered queries: a name, a function of (spark, table folder), and SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def sql_text(value: str) -> str:
    """A string as an SQL literal, line feeds as chr(10)."""
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_draw(seed, *keys: str) -> str:
    """The seeded draw in SQL."""
    text = " || ':' || ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in keys]])
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def sql_split(key: str, test_size: float = 0.1, seed: int = 42) -> str:
    return (
        f"CASE WHEN {sql_draw(seed, key)} < {int(test_size * 2**32)} THEN 'test' ELSE 'train' END"
    )
