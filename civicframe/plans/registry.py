"""The list of runnable queries, each with the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civicframe.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, directory: fn(Tables(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def same_sql(name: str, text: str, *views: str) -> None:
    """Register a query whose SQL text runs unchanged on both engines."""
    query(name, text)(lambda t: t.sql(text, *views))
