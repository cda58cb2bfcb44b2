"""The registered queries: one per operator family, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagefold.plans import table_queries, text_queries
from pagefold.plans.text_queries import weighted_lines

ALL = text_queries.QUERIES | table_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}


__all__ = ["oracle_sql", "queries", "weighted_lines"]
