"""The queries of the package and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("scans", "projections", "joins", "aggregations", "windows", "sampling", "functions", "augmentation", "streams", "udfs", "pipelines")

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its DuckDB SQL if there is one."""

    def put(f: Query) -> Query:
        key = name or f.__name__
        if key in _queries:
            raise ValueError(f"two queries named {key}")
        _queries[key] = f
        if sql is not None:
            _sql[key] = sql
        return f

    return put


def _load() -> None:
    for name in MODULES:
        import_module(f"rasterweave.queries.{name}")


def core_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def core_oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
