"""Registration of queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayrisk.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` as ``name``; ``sql`` is the same result for DuckDB."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        run.__doc__ = fn.__doc__
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
