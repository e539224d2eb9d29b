"""Constraint checks over whole tables: unique, check, foreign key, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_failures(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Per check, how many rows fail; an unknown (NULL) result passes.

    One pass over the table for all checks.
    """
    counts = df.agg(*[F.count(F.when(~rule, 1)).alias(name) for name, rule in checks.items()])
    return counts.unpivot([], list(checks), "check_name", "n_failed")


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    parents = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(parents, child[child_key] == parents["__pk"], "left_anti")


def quarantine(df: DataFrame, keys: Sequence[str], order: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """Add ``reason``: NULL for accepted rows, else the failed check or ``duplicate``.

    The first row of a key that passes its checks is accepted: by ``order``, then by the other
    columns; of rows alike in all columns one. Rows alike are counted first and the first row of
    a key is found by partial aggregation and joined back, so a hot key is no bottleneck.
    """
    reason = None
    for name, rule in checks.items():
        reason = F.when(~rule, F.lit(name)) if reason is None else reason.when(~rule, F.lit(name))
    checked = df.withColumn("__failed", reason if reason is not None else F.lit(None).cast("string"))
    alike = checked.groupBy(*checked.columns).agg(F.count(F.lit(1)).cast("int").alias("__n"))
    place = F.struct(*order, *[c for c in df.columns if c not in order])
    first = (
        alike.filter("__failed is null").groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.min(place).alias("__first"))
    )
    cond = None
    for k in keys:
        c = alike[k].eqNullSafe(first[f"__{k}"])
        cond = c if cond is None else cond & c
    joined = alike.join(first, cond, "left").withColumn("__i", F.explode(F.sequence(F.lit(1), "__n")))
    verdict = F.when(F.col("__failed").isNotNull(), F.col("__failed")).when(
        ~place.eqNullSafe(F.col("__first")) | (F.col("__i") > 1), F.lit("duplicate")
    )
    return joined.select(*df.columns, verdict.alias("reason"))
