"""Registered queries with the SQL each is compared to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Graph column names without the colon: ``:START_ID`` becomes ``start_id``."""
    return df.withColumnsRenamed({c: c[1:].lower() for c in df.columns if c.startswith(":")})
