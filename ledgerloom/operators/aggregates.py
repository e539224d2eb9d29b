"""Grouped results that T-SQL writes as windows or self-joins, as partial aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import one_row_per_key
from ledgerloom.operators.ordered import ordered_row_number


def latest_snapshot(df: DataFrame, date: Column, period: Column) -> DataFrame:
    """Rows dated on the last date present in their period."""
    dated = df.withColumn("__d", date).withColumn("__p", period)
    last = dated.groupBy(F.col("__p").alias("__lp")).agg(F.max("__d").alias("__ld"))
    return dated.join(last, (F.col("__p") == F.col("__lp")) & (F.col("__d") == F.col("__ld")), "left_semi").drop(
        "__d", "__p"
    )


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` and then by the other columns."""
    return one_row_per_key(df, keys, order)


def nth_highest(df: DataFrame, column: str, n: int = 2) -> DataFrame:
    """The n-th highest distinct value (no row when there are fewer).

    Only the top ``n`` distinct values reach the driver-side limit, never a global window.
    """
    top = df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(F.col(column).desc()).limit(n)
    return top.agg(F.count(F.lit(1)).alias("__n"), F.min(column).alias(column)).filter(F.col("__n") == n).select(column)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows by a total order: each task keeps ``n`` rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)


def group_share(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Detail rows with their group's aggregates, by aggregate and join.

    A window would put a whole group into one task; here a group is first reduced.
    """
    groups = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggs.items()])
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(groups[f"__{k}"])
        cond = c if cond is None else cond & c
    return df.join(groups, cond).select(*df.columns, *aggs)


def distinct_list(
    df: DataFrame, keys: Sequence[str], value: str, out: str, page: int | None, sep: str = ","
) -> DataFrame:
    """Sorted, separated list of the distinct values per group.

    Values are made distinct before they are collected, so a list is as long as its domain
    and not as its group. ``page`` splits each list into rows of at most so many values,
    numbered from 0 in ``page_no``; ``None`` says that the domain is known to be small.
    """
    distinct = df.select(*keys, value).distinct()
    by = list(keys)
    if page is not None:
        numbered = ordered_row_number(distinct.filter(F.col(value).isNotNull()), keys, [value], "__rn")
        distinct = numbered.withColumn("page_no", F.floor((F.col("__rn") - 1) / page))
        by.append("page_no")
    return distinct.groupBy(*by).agg(F.concat_ws(sep, F.sort_array(F.collect_list(value))).alias(out))


def two_earliest(df: DataFrame, entity: str, item: str, date: str, outs: tuple[str, str]) -> DataFrame:
    """Per entity, the items whose first dates rank 1 and 2 (``dense_rank``); ties give the greatest item.

    Two rounds of partial aggregation instead of a rank over the entity's items.
    """
    firsts = df.groupBy(entity, item).agg(F.min(date).alias("__d"))
    # Per entity and date one candidate item is left.
    daily = firsts.groupBy(entity, "__d").agg(F.max(item).alias("__i"))
    low = daily.groupBy(F.col(entity).alias("__e")).agg(F.min("__d").alias("__d1"))
    marked = daily.join(low, F.col(entity) == F.col("__e"))
    pick = F.struct(F.col("__d"), F.col("__i"))
    return marked.groupBy(entity).agg(
        F.min(F.when(F.col("__d") == F.col("__d1"), pick))["__i"].alias(outs[0]),
        F.min(F.when(F.col("__d") > F.col("__d1"), pick))["__i"].alias(outs[1]),
    )


def flagged_summary(df: DataFrame, flag: Column, score: Column) -> DataFrame:
    """Report totals: rows, flagged rows and the mean score of the flagged ones, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(F.when(flag, 1)).alias("n_flagged"),
        F.avg(F.when(flag, score)).alias("avg_score"),
    )
