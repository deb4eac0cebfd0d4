"""The query catalogue: one entry for each operator, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import corpus_queries, pipeline_queries, relational_queries, text_queries  # noqa: F401  they register themselves
from corpusloom.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """The SQL of the queries that SQL can express."""
    return dict(SQL)
