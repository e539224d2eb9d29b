"""System-versioned tables: current and past versions with half-open ``[valid_from, valid_to)``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import require_unique
from ledgerloom.operators.ordered import ordered_lead

FROM, TO = "valid_from", "valid_to"
OPEN_END = "9999-12-31 00:00:00"


def stamp(value: str | datetime) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def open_end() -> Column:
    return stamp(OPEN_END)


def is_current(valid_to: str = TO) -> Column:
    return F.year(valid_to) == 9999


def build_history(
    changes: DataFrame, keys: Sequence[str], at: str, tiebreak: str, deleted: Column | None = None
) -> DataFrame:
    """Turn a log of full-row changes into versions.

    A change opens a version and the key's next change closes it; the last stays open. Of
    changes at the same instant the one with the greatest ``tiebreak`` wins (the others
    would last no time). A change for which ``deleted`` is true closes without opening.
    """
    led = ordered_lead(
        changes.withColumn(FROM, F.col(at).cast("timestamp_ntz")), keys, [FROM, tiebreak], FROM, TO, open_end()
    )
    if deleted is not None:
        led = led.filter(~F.coalesce(deleted, F.lit(False)))
    return led.filter(F.col(FROM) < F.col(TO))


def apply_changes(
    history: DataFrame, changes: DataFrame, keys: Sequence[str], at: str, deleted: Column | None = None
) -> DataFrame:
    """Add one batch with at most one later change per key: close the open versions, open new ones.

    A change for which ``deleted`` is true closes without opening. A key that changes twice in
    the batch fails the job, and so does a change that is not later than the open version.
    """
    fresh = require_unique(changes, keys, "batch of changes").withColumn(FROM, F.col(at).cast("timestamp_ntz")).withColumn(TO, open_end())
    cut = fresh.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(FROM).alias("__cut"))
    cond = is_current()
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    late = F.raise_error(F.lit(f"a change is not later than the open version of its {list(keys)}")).cast("timestamp_ntz")
    end = F.when(F.col("__cut").isNull(), F.col(TO)).when(F.col("__cut") <= F.col(FROM), late).otherwise(F.col("__cut"))
    closed = history.join(cut, cond, "left").select(*[end.alias(c) if c == TO else F.col(c) for c in history.columns])
    opened = fresh if deleted is None else fresh.filter(~F.coalesce(deleted, F.lit(False)))
    return closed.unionByName(opened.select(*history.columns))


def as_of(history: DataFrame, at: str | datetime | None) -> DataFrame:
    """Versions valid at ``at``; ``None`` means the current ones."""
    if at is None:
        return history.filter(is_current())
    return history.filter((F.col(FROM) <= stamp(at)) & (F.col(TO) > stamp(at)))


def all_versions(history: DataFrame) -> DataFrame:
    """Every version, with a 0/1 flag for the current one."""
    return history.withColumn("is_current", F.when(is_current(), 1).otherwise(0))


def between(history: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Versions valid at some instant of [start, end]."""
    return history.filter((F.col(FROM) <= stamp(end)) & (F.col(TO) > stamp(start)))


def contained_in(history: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Versions opened and closed within [start, end]."""
    return history.filter((F.col(FROM) >= stamp(start)) & (F.col(TO) <= stamp(end)))


def changed_since(history: DataFrame, at: str | datetime, columns: Sequence[str]) -> DataFrame:
    """Current rows (without the period) that were not in the state at ``at``."""
    now = as_of(history, None).select(*columns).distinct()
    return now.subtract(as_of(history, at).select(*columns))


def recover_deleted(history: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last closed version of every key that has no current version."""
    rest = [c for c in columns if c not in keys]
    latest = history.groupBy(*keys).agg(
        F.max(F.when(is_current(), True).otherwise(False)).alias("__alive"),
        F.max_by(F.struct(*rest), F.struct(TO, FROM)).alias("__last"),
    )
    return latest.filter(~F.col("__alive")).select(
        *[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in columns]
    )


def start_versioning(df: DataFrame, now: str | datetime) -> DataFrame:
    """A plain table as versions that began one second before ``now``."""
    began = stamp(now) - F.expr("interval 1 second")
    return df.withColumn(FROM, began).withColumn(TO, open_end())


def add_column(history: DataFrame, name: str, kind: str, default: object = None) -> DataFrame:
    """Add a column to all versions, past ones included."""
    return history.withColumn(name, F.lit(default).cast(kind))


def drop_column(history: DataFrame, name: str) -> DataFrame:
    return history.drop(name)
