"""Ordered operators whose groups may be too large for one task.

``lead``, ``row_number`` and ``dense_rank`` over a plain window put a whole group (or,
without a partition key, the whole table) into one task. Here the rows are
range-partitioned on the full sort key instead, so a hot group is spread over many
ranges; each range is handled on its own, and what crosses a range border is settled by
a table with at most one row per range.

The placed rows are written to the shared folder: the range number is part of the data
from then on, so both reads of them agree even when an executor is lost in between. As a
columnar table it can also be read back without the columns a step does not need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import written_table

RANGE = "__range"


def place_in_order(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Range-partition on ``order`` (ascending) and record each row's range number."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *[F.col(c) for c in order])
    return written_table(placed.withColumn(RANGE, F.spark_partition_id()), "ordered")


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = left[RANGE] == right[RANGE]
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def ordered_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn", ranges: int | None = None
) -> DataFrame:
    """``row_number() over (partition by keys order by order)``; ``order`` must be total."""
    keys = list(keys)
    placed = place_in_order(df, [*keys, *order], ranges)
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order)
    # Ranges follow key order, so only the first key of a range can have started earlier:
    # the table of carried counts has at most one row per range and is safe to broadcast.
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy(RANGE, *keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(earlier))
        .filter("__before is not null")
        .drop("__n")
    )
    local = placed.withColumn(out, F.row_number().over(inside).cast("bigint"))
    joined = local.join(F.broadcast(carried), _same_key(local, carried, keys), "left")
    return joined.select(
        *[local[c] for c in df.columns],
        (local[out] + F.coalesce(carried["__before"], F.lit(0))).alias(out),
    )


def ordered_lead(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    default: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``lead(value, 1, default) over (partition by keys order by order)``; ``order`` total."""
    keys = list(keys)
    placed = place_in_order(df, [*keys, *order], ranges)
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order)
    # The value is boxed, so "no following row" and "following value is NULL" stay apart.
    boxed = placed.withColumn("__next", F.lead(F.struct(F.col(value).alias("v"))).over(inside))
    heads = placed.groupBy(RANGE, *keys).agg(
        F.min_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__head")
    )
    # Only a range's last key can go on in a later range: at most one row per range again.
    later = Window.partitionBy(*keys).orderBy(RANGE)
    heads = heads.withColumn("__after", F.lead("__head").over(later)).filter("__after is not null").drop("__head")
    joined = boxed.join(F.broadcast(heads), _same_key(boxed, heads, keys), "left")
    following = F.coalesce(boxed["__next"], heads["__after"])
    if default is None:
        default = F.lit(None)
    return joined.select(
        *[boxed[c] for c in df.columns],
        F.when(following.isNull(), default).otherwise(following["v"]).alias(out),
    )


def ordered_dense_rank(
    df: DataFrame, keys: Sequence[str], order: str, out: str = "rk", ranges: int | None = None
) -> DataFrame:
    """``dense_rank() over (partition by keys order by order)``.

    The rank of a row is the row number of its value among the distinct values, which are
    found by a partial aggregation before anything is sorted.
    """
    keys = list(keys)
    distinct = df.select(*keys, order).distinct()
    ranked = ordered_row_number(distinct, keys, [order], out, ranges)
    cond = df[order].eqNullSafe(ranked[order])
    for k in keys:
        cond = cond & df[k].eqNullSafe(ranked[k])
    return df.join(ranked, cond, "left").select(*[df[c] for c in df.columns], ranked[out])


def surrogate_key(df: DataFrame, order: Sequence[str], out: str, seed: int = 1, step: int = 1) -> DataFrame:
    """Gapless keys ``seed, seed + step, ..`` in the order of a natural key."""
    numbered = ordered_row_number(df, [], order, out)
    return numbered.withColumn(out, F.col(out) * step + (seed - step))
