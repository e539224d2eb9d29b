"""Named SQL functions of a session: scalars and tables, so that queries in SQL text can use what the library offers.

The functions are temporary: they belong to the session and may read its temporary views. Bodies are fixed by the caller's
code; what users enter goes in as arguments, never as text of a query.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def _parameters(parameters: Mapping[str, str], defaults: bool) -> str:
    return ", ".join(f"`{name}` {kind}{' DEFAULT NULL' if defaults else ''}" for name, kind in parameters.items())


def scalar_function(spark: SparkSession, name: str, parameters: Mapping[str, str], returns: str, body: str) -> None:
    """``name(parameters)`` gives the value of the expression ``body``, which may look into a view (as a scalar subquery)."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({_parameters(parameters, False)}) RETURNS {returns} RETURN {body}")


def table_function(spark: SparkSession, name: str, parameters: Mapping[str, str], returns: Mapping[str, str], body: str) -> None:
    """``name(parameters)`` gives the rows of the query ``body``. Parameters may be left out and are NULL then."""
    columns = ", ".join(f"`{c}` {kind}" for c, kind in returns.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({_parameters(parameters, True)}) RETURNS TABLE({columns}) RETURN {body}")


def any_or(column: str, parameter: str) -> str:
    """Condition of an optional parameter: NULL takes all rows."""
    return f"({parameter} IS NULL OR {column} = {parameter})"
