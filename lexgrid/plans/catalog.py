"""Every query of the library by name, with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame under its function's name; sql: the same for DuckDB."""

    def put(f):
        key = name or f.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = f
        if sql is not None:
            _ORACLES[key] = sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import amending, domain, events, measure, relational, sequences, structure, verify  # noqa: F401

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return _ORACLES
