"""Registry of the queries over the test tables, each with its SQL counterpart if it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from icuflow.sources.io import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of `Tables` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        QUERIES[name].__name__ = name
        if sql:
            SQL[name] = sql.strip()
        return build

    return register
