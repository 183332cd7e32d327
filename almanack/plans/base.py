"""How queries are registered, and literals as tables for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, folder), and the DuckDB SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def quoted(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def values(rows, *names: str) -> str:
    """A subquery of literal rows with their number ``k`` from 0."""
    listed = ", ".join("(" + ", ".join([str(k), *map(quoted, row)]) + ")" for k, row in enumerate(rows))
    return f"(SELECT * FROM (VALUES {listed}) AS t(k, {', '.join(names)}))"


def literals(spark: SparkSession, rows, schema: str) -> DataFrame:
    """The same rows as a small table with their number ``k``, to be broadcast."""
    return F.broadcast(spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], f"k long, {schema}"))
