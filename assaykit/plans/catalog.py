"""Query key → (callable, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from assaykit.plans.oracle import statement

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ["index_queries", "validation_queries", "model_queries", "file_queries", "image_queries"]


def query(
    name: str, sql: str | None = None, needs: tuple[str, ...] = (), groups: str | None = None
) -> Callable[[Query], Query]:
    """Register a query under its key, with the SQL that gives the same rows where there is one."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = statement(sql, *needs, groups=groups)
        return fn

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"assaykit.plans.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
