"""Named queries over the sample tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; without ``sql`` only its rows are counted."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# Means of two-decimal values often end exactly half way between two 4-digit numbers, where the
# last bit decides the rounding.  The shift moves these off the half; adding 0.0 removes -0.0.
_SHIFT = "0.0000031"


def r4(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + F.lit(float(_SHIFT)), 4) + F.lit(0.0)


def r4_sql(value: str) -> str:
    return f"round(CAST({value} AS DOUBLE) + CAST({_SHIFT} AS DOUBLE), 4) + CAST(0 AS DOUBLE)"
