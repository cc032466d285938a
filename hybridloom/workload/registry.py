"""Named queries over the given tables and the SQL each must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ["vector_queries", "fusion_queries", "catalog_queries", "text_queries", "context_queries",
            "evaluation_queries", "ingest_queries", "store_queries", "relational_queries", "stream_queries"]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in _MODULES:
        importlib.import_module(f"hybridloom.workload.{module}")
    return dict(_QUERIES), dict(_SQL)
