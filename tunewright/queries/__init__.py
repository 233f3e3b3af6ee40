"""Queries over the given tables, one per operator."""

from __future__ import annotations

from tunewright.queries import catalog, corpus, planning, runs  # noqa: F401  (they register queries)
from tunewright.queries.registry import QUERIES, SQL


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(SQL)
