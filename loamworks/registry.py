"""Every query of the library outside ``llm``: name, DataFrame function, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows, if SQL can."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    from . import plans  # noqa: F401  registers on import
