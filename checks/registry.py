"""Where the queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def r(column: str, digits: int = 6) -> Column:
    """Rounded column under its own name; sums of doubles differ in the last bits."""
    return F.round(column, digits).alias(column)


def rs(columns: list[str], digits: int = 6) -> str:
    """The same in SQL."""
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
