"""The registry and small helpers for comparable results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def joined(column: str) -> Column:
    """An array of text as one text, so that results compare as plain values."""
    return F.array_join(column, " | ").alias(column)


def joined_lists(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: joined(c) for c in columns})


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
