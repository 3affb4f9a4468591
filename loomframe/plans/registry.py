"""Collects the queries of the sibling modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, with the SQL that checks them where there is one."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def register(function: Query) -> Query:
            key = name or function.__name__
            self.queries[key] = function
            if sql is not None:
                self.sql[key] = sql
            return function
        return register


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles to fixed digits: sums in another order differ in the last bits."""
    return df.withColumns({f.name: no_minus_zero(F.round(df[f"`{f.name}`"], digits))
                           for f in df.schema if isinstance(f.dataType, T.DoubleType)})


def no_minus_zero(value: Column) -> Column:
    return value + F.lit(0.0)
