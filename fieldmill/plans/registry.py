"""The registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded_sql(value: str, places: int) -> str:
    """SQL for a number rounded half up by its decimal digits, as Spark rounds.

    The checking database rounds the binary value, which differs where a mean lies exactly between
    two results.
    """
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query ``(spark, folder) -> DataFrame`` and the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
