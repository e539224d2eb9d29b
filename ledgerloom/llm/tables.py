"""Common parts of the operators: keys of rows, written tables, checks of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written_table

#: ASCII white space, as a class of a regular expression.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def row_key(*columns: str | Column) -> list[Column]:
    """Two 64-bit hashes that name a row by its contents, so a recomputed task names it alike.

    Rows alike in these columns share a key; an operator has to give them the same result.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("second"), *reversed(columns)).alias("k2")]


def n_words(text: str | Column) -> Column:
    """Number of words between ASCII white space; 0 for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage and survives lost executors."""
    return written_table(df, name)


def carried(column: str) -> Column:
    """An id as text for the way through pandas, where a column of numbers with NULLs would turn into floats."""
    return F.col(column).cast("string")


def restored(df: DataFrame, column: str, held: str = "doc") -> Column:
    """The id back in its own type."""
    return F.col(held).cast(df.schema[column].dataType).alias(column)
