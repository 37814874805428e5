"""Names, queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(run: Query) -> Query:
        add(run.__name__, run, sql)
        return run

    return register
