"""Name -> (query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name, with the SQL that must agree."""

    def add(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return fn

    return add
