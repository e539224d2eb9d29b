"""Query name to callable and to the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is what DuckDB runs on the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: Column | str, places: int = 2) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), places)


def mean(column: str) -> Column:
    """Mean of amounts with two decimals; the sum is rounded to cents, so the order of adding does not show."""
    return F.round(F.sum(column), 2) / F.count(column)


def ts(column: Column | str) -> Column:
    """A timestamp as text, down to the microsecond."""
    column = F.col(column) if isinstance(column, str) else column
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day(column: Column | str) -> Column:
    """A date as text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.date_format(column, "yyyy-MM-dd")


def total() -> Column:
    return F.count(F.lit(1))
