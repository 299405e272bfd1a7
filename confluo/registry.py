"""Queries by name, with the DuckDB SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .plans.shipping import ship

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        _QUERIES[function.__name__] = run
        if sql:
            _SQL[function.__name__] = sql
        return function

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and near duplicate clusters of documents, with the best document of each."""
    return queries()["duplicate_clusters"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import extract_queries, fusion_queries, knowledge_queries, queries as _registered, recording_queries, relational_queries, source_queries  # noqa: F401  register on import

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import extract_queries, fusion_queries, knowledge_queries, queries as _registered, recording_queries, relational_queries, source_queries  # noqa: F401

    return dict(_SQL)
