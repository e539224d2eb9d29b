"""Dated lookups by one sweep over time.

The dates that are looked up and the starts of all periods are put in one order, by key and date; the last period that
started before a date is the only one that can hold it. One sweep serves any number of lookup tables, also with
different keys. What is sorted are the distinct pairs of key and date, not the rows that ask; they get the values by one
equi-join per set of keys. No period is spelled out into months, and nothing is planned as a nested loop.

The order is cut into ranges wherever it falls, so a hot key is spread; the period that is still open where a range
ends is carried on by a table with one row per range at most.

A lookup of few periods, few of each key, takes no part in this: its periods are counted once, and then sent to the tasks
that hold the rows, which are not shuffled for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import RANGE, place_in_order
from ledgerloom.session import written_table


#: Periods that a lookup may have, and those of one key, to be sent to every task: some MB at most.
FEW, FEW_OF_KEY = 10_000, 100


@dataclass(frozen=True)
class Dated:
    """One lookup: the row of ``dim`` whose keys are equal and whose ``beg`` .. ``end``, both included, holds ``date``.

    ``on`` maps columns of the rows to those of ``dim`` and may be empty, ``cols`` columns of ``dim`` to the names they get;
    ``constants`` picks rows of ``dim`` by fixed values.
    """

    dim: DataFrame
    on: Mapping[str, str]
    date: str
    cols: Mapping[str, str]
    beg: str = "beg"
    end: str = "end"
    constants: Mapping[str, object] = field(default_factory=dict)


def _key(columns: Sequence[Column]) -> Column:
    return F.array(*[c.cast("string") for c in columns]) if columns else F.array().cast("array<string>")


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _starts(lookup: Dated, kinds: Mapping[str, object], which: int) -> DataFrame:
    dim = lookup.dim
    for name, value in lookup.constants.items():
        dim = dim.filter(F.col(name) == F.lit(value))
    # Keys are compared in the type of the rows, so 1 and 1.00 are the same.
    key = _key([F.col(b).cast(kinds[a]) for a, b in lookup.on.items()])
    held = F.struct(F.col(lookup.end).cast("date").alias("end"), *[F.col(c).alias(o) for c, o in lookup.cols.items()])
    rows = dim.select(F.lit(which).alias("which"), key.alias("key"), F.col(lookup.beg).cast("date").alias("at"), held.alias(f"v{which}"))
    return rows.filter(F.col("at") <= F.col(f"v{which}.end"))


def _few(starts: DataFrame) -> list[int]:
    """Which lookups are of few periods: a row per lookup at most comes to the driver."""
    counts = starts.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("which").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    return [r["which"] for r in counts.filter((F.col("all") <= FEW) & (F.col("most") <= FEW_OF_KEY)).collect()]


def _overlap() -> Column:
    return F.raise_error(F.concat(F.lit("overlapping periods of key "), F.array_join("key", ","), F.lit(" at "), F.col("at").cast("string"))).cast("boolean")


def _sent(df: DataFrame, lookups: Mapping[int, Dated], starts: DataFrame, kinds: Mapping[str, object]) -> DataFrame:
    """``df`` with the columns of ``lookups``, whose periods are sent to its tasks."""
    end = F.coalesce(*[F.col(f"v{i}.end") for i in lookups])
    earlier = Window.partitionBy("which", "key").orderBy("at")
    held = starts.filter(F.col("which").isin(*lookups)).withColumn("was", F.lag(end).over(earlier))
    held = written_table(held.filter(F.when(F.col("was") >= F.col("at"), _overlap()).otherwise(F.lit(True))).drop("was"), "held")
    for i, lookup in lookups.items():
        own, at, names = held.filter(F.col("which") == i), F.col(lookup.date).cast("date"), list(lookup.cols.values())
        if lookup.on:
            values = [F.col(f"v{i}")[o].alias(o) for o in names]
            keys = [F.col("key")[j].cast(kinds[k]).alias(f"__k{j}") for j, k in enumerate(lookup.on)]
            cond = at.between(F.col("__beg"), F.col("__end"))
            for j, k in enumerate(lookup.on):
                cond = cond & (F.col(k) == F.col(f"__k{j}"))
            periods = own.select(*keys, F.col("at").alias("__beg"), F.col(f"v{i}.end").alias("__end"), *values)
            df = df.join(F.broadcast(periods), cond, "left").drop("__beg", "__end", *[f"__k{j}" for j in range(len(keys))])
        else:
            # Without a key there is nothing to join by; the few periods are one value.
            periods = own.agg(F.collect_list(F.struct("at", F.col(f"v{i}").alias("v")))).scalar()
            hit = F.get(F.filter("__periods", lambda p: at.between(p["at"], p["v"]["end"])), F.lit(0))["v"]
            df = df.withColumn("__periods", periods).withColumn("__v", hit).select(*df.columns, *[F.col("__v")[o].alias(o) for o in names])
    return df


def sweep(df: DataFrame, lookups: Sequence[Dated], ranges: int | None = None) -> DataFrame:
    """``df`` with the columns of all ``lookups``, NULL where no period holds the date; rows are never multiplied.

    Two periods of a key that overlap fail the job. NULL keys and dates find nothing; a period without a start or an end, or
    that ends before it starts, holds no date. ``df`` is read twice: for its distinct keys and dates, and for the rows;
    once where all lookups are of few periods (:data:`FEW`). With ``ranges``, all are swept.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # Written first, so the plans of all lookup tables run once.
    starts = _starts(lookups[0], kinds, 0)
    for i in range(1, len(lookups)):
        starts = starts.unionByName(_starts(lookups[i], kinds, i), allowMissingColumns=True)
    starts = written_table(starts, "starts")
    sent = {i: lookups[i] for i in ([] if ranges else _few(starts))}
    swept = {i: lookup for i, lookup in enumerate(lookups) if i not in sent}
    out = _sent(df, sent, starts, kinds) if sent else df
    out = _swept(df, out, swept, starts, kinds, ranges) if swept else out
    return out.select(*df.columns, *[o for lookup in lookups for o in lookup.cols.values()])


def _swept(df: DataFrame, out: DataFrame, lookups: Mapping[int, Dated], starts: DataFrame, kinds: Mapping[str, object], ranges: int | None) -> DataFrame:
    """``out``, which holds the rows of ``df``, with the columns of ``lookups``."""
    sets: dict[tuple, list[int]] = {}
    for i, lookup in lookups.items():
        sets.setdefault((tuple(lookup.on), lookup.date), []).append(i)
    names = [f"v{i}" for i in lookups]

    asked = F.array(*[
        F.struct(F.lit(n).alias("set"), _key([F.col(a) for a in keys]).alias("key"), F.col(date).cast("date").alias("at"))
        for n, (keys, date) in enumerate(sets)
    ])
    points = df.select(F.inline(asked)).filter(F.col("at").isNotNull() & ~F.exists("key", lambda k: k.isNull())).distinct()
    events = points.withColumn("kind", F.lit(1))
    for n, members in enumerate(sets.values()):
        own = starts.filter(F.col("which").isin(*members))
        events = events.unionByName(own.select(F.lit(n).alias("set"), "key", "at", F.lit(0).alias("kind"), *names), allowMissingColumns=True)

    # Written before it is sampled for ranges, so the plan of the rows runs once.
    placed = place_in_order(written_table(events, "events"), ["set", "key", "at", "kind"], ranges)
    group = ["set", "key"]
    inside = Window.partitionBy(RANGE, *group).orderBy("at", "kind")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("*", *[F.last(v, ignorenulls=True).over(before).alias(f"was_{v}") for v in names])
    # Only the first key of a range can have started in an earlier one: one row per range at most, safe to broadcast.
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    latest = placed.groupBy(RANGE, *group).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("at"))).alias(v) for v in names])
    carried = latest.select(
        F.col(RANGE).alias("__r"), F.col("set").alias("__set"), F.col("key").alias("__key"),
        *[F.last(v, ignorenulls=True).over(earlier).alias(f"held_{v}") for v in names],
    ).filter(_any([F.col(f"held_{v}").isNotNull() for v in names]))
    both = local.join(F.broadcast(carried), (F.col(RANGE) == F.col("__r")) & (F.col("set") == F.col("__set")) & (F.col("key") == F.col("__key")), "left")
    clash = _any([F.col(v).isNotNull() & (F.coalesce(f"was_{v}", f"held_{v}")["end"] >= F.col("at")) for v in names])
    found = both.filter(F.when(clash, _overlap()).otherwise(F.col("kind") == 1)).select(
        *group, "at", *[F.coalesce(f"was_{v}", f"held_{v}").alias(v) for v in names]
    )
    found = written_table(found.select(*group, "at", *[F.when(F.col(v)["end"] >= F.col("at"), F.col(v)).alias(v) for v in names]), "periods")

    for n, ((keys, date), members) in enumerate(sets.items()):
        own = found.filter(F.col("set") == n).select(
            F.col("at").alias("__at"), *[F.col("key")[i].cast(kinds[k]).alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(f"v{i}")[o].alias(o) for i in members for o in lookups[i].cols.values()],
        )
        cond = F.col(date).cast("date") == F.col("__at")
        for i, k in enumerate(keys):
            cond = cond & (F.col(k) == F.col(f"__k{i}"))
        out = out.join(own, cond, "left").drop("__at", *[f"__k{i}" for i in range(len(keys))])
    return out
