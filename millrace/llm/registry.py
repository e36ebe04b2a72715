"""Queries of this subpackage by name, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder of tables) under its own name."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), str(folder))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql.strip()
        return run

    return register
