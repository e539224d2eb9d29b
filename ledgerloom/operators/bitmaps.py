"""Exact distinct counts by bitmaps, which can be merged over groups.

A set of whole numbers is kept as bitmaps of fixed size, one row per group and bucket of numbers that occurs. Building them
is one aggregation per table without spreading the rows over several copies, and a coarser grouping is made by merging bitmaps
instead of reading the rows again, which a table of counts does not allow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``(keys, bucket, bits)``: the distinct values of a column of whole numbers per group; NULLs are not counted.

    Numbers that lie close together share a bucket (32,768 of them), so dense ids make small tables. Negative numbers are
    allowed; numbers are shifted by half their range, so no two share a bit.
    """
    value = F.col(column).cast("bigint")
    rows = df.filter(value.isNotNull()).select(*keys, F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).alias("bit"))
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of a coarser grouping: ``keys`` are some of the keys they have."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct values per group of ``keys``; a grouping without keys gives one row."""
    sizes = merged(bitmaps, keys).select(*keys, F.bitmap_count("bits").alias("__n"))
    return sizes.groupBy(*keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias(out))


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Distinct counts of several columns per group, each with its own bitmaps; ``columns`` maps a column to its output.

    Groups all of whose values are NULL count 0.
    """
    out = df.select(*keys).distinct()
    for column, name in columns.items():
        counts = bitmap_counts(distinct_bitmaps(df, keys, column), keys, name)
        renamed = counts.toDF(*[f"__{k}" for k in keys], name)
        cond = F.lit(True)
        for k in keys:
            cond = cond & out[k].eqNullSafe(renamed[f"__{k}"])
        out = out.join(renamed, cond, "left").drop(*[f"__{k}" for k in keys])
    return out.select(*keys, *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in columns.values()])
