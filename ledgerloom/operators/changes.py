"""MERGE, UPDATE and DELETE as functions from the old table state to the new one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import require_unique


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched target rows take the source's values, unmatched source rows are added.

    Target columns missing from the source keep their value. A repeated source key fails
    the job; target keys may repeat, and every row of a key is updated. NULL keys match
    nothing. A left join and an anti join, which adaptive execution can split where a target
    key is hot; it cannot split a full join.
    """
    src = require_unique(source, keys, "merge source").withColumn("__hit", F.lit(True))
    renamed = src.toDF(*[f"__s_{c}" for c in src.columns])
    cond = None
    for k in keys:
        c = target[k] == renamed[f"__s_{k}"]
        cond = c if cond is None else cond & c
    matched = target.join(renamed, cond, "left").select(
        *[
            F.when(F.col("__s___hit"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns and c not in keys else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = src[k] == known[f"__t_{k}"]
        cond = c if cond is None else cond & c
    added = src.join(known, cond, "left_anti")
    return matched.unionByName(
        added.select(
            *[(F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns]
        )
    )


def update_where(df: DataFrame, condition: Column | None, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns on all rows, or on those where ``condition`` is true."""
    new = {}
    for name, value in assignments.items():
        cast = value.cast(df.schema[name].dataType)
        new[name] = cast if condition is None else F.when(condition, cast).otherwise(F.col(name))
    return df.withColumns(new)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], assignments: Mapping[str, str]) -> DataFrame:
    """``assignments`` maps a target column to the source column it takes on a key match."""
    narrow = source.select(*keys, *[F.col(s).alias(f"__new_{t}") for t, s in assignments.items()])
    src = require_unique(narrow, keys, "update source").withColumn("__hit", F.lit(True))
    cond = None
    for k in keys:
        c = target[k] == src[k]
        cond = c if cond is None else cond & c
    joined = target.join(src, cond, "left")
    return joined.select(
        *[
            F.when(src["__hit"], src[f"__new_{c}"]).otherwise(target[c]).alias(c) if c in assignments else target[c]
            for c in target.columns
        ]
    )


def partial_update(
    df: DataFrame, condition: Column, given: Mapping[str, object], overwrite: Sequence[str] = ()
) -> DataFrame:
    """A ``None`` argument keeps the current value, except for ``overwrite`` columns.

    A call without any argument changes nothing, ``overwrite`` columns included.
    """
    if all(value is None for value in given.values()):
        return df
    values = {
        name: F.lit(value) if name in overwrite else F.coalesce(F.lit(value), F.col(name))
        for name, value in given.items()
    }
    return update_where(df, condition, values)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which ``condition`` is not true (false or unknown stays)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_cascade(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, condition: Column
) -> tuple[DataFrame, DataFrame]:
    """Delete parents and the children that point at them; returns (parents, children)."""
    doomed = parent.filter(condition).select(F.col(parent_key).alias("__gone")).distinct()
    kept = child.join(doomed, child[child_key] == doomed["__gone"], "left_anti")
    return delete_where(parent, condition), kept
