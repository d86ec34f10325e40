"""Registration of sample-table queries with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a function, under its own name unless told otherwise, with its SQL counterpart."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


class Sample:
    """The sample tables of one folder; each is opened once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        setattr(self, name, table)
        return table


def day(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("date")


def iso(column: str | Column) -> Column:
    """Dates leave a query as ISO text, so both engines hand over the same value type."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")
