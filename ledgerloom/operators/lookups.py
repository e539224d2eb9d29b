"""Effective-dated, banded and override lookups.

All take plain lookup tables. A lookup whose condition is only a range is turned into an
equi-join on months, so no nested loop is planned however large either side is. Bands and
overrides that overlap fail the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import written_table


def month_number(date: Column) -> Column:
    """Months since year 0 of a date."""
    return F.year(date) * 12 + F.month(date) - 1


def by_month(dim: DataFrame, beg: str, end: str, first: Column, last: Column, out: str = "__month") -> DataFrame:
    """One row per month a period touches, cut to the months ``first`` .. ``last``.

    ``first`` and ``last`` bound the dates that will be looked up, so an open-ended period
    is not spelled out to the year 9999.
    """
    lo = F.greatest(month_number(F.col(beg)), first)
    hi = F.least(month_number(F.col(end)), last)
    return dim.filter(lo <= hi).withColumn(out, F.explode(F.sequence(lo, hi)))


def months_spanned(df: DataFrame, dates: Sequence[str]) -> tuple[int, int]:
    """First and last month number of some date columns: one pass over those columns alone."""
    every = [month_number(F.col(c)) for c in dates]
    lo, hi = (F.least(*every), F.greatest(*every)) if len(every) > 1 else (every[0], every[0])
    row = df.agg(F.min(lo), F.max(hi)).first()
    return (0, -1) if row[0] is None else (row[0], row[1])


def effective_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    date: str,
    beg: str,
    end: str,
    cols: Mapping[str, str],
    constants: Mapping[str, object] | None = None,
    how: str = "left",
    months: tuple[int, int] | None = None,
    single: bool = False,
) -> DataFrame:
    """Rows of ``dim`` valid on ``df[date]`` (``beg`` <= date <= ``end``), by optional keys.

    ``on`` maps df columns to dim columns and may be empty. ``cols`` maps dim columns to
    output names. The date's month joins the keys, which also splits a hot key.

    ``months`` bounds the dates looked up; without it they are found by a subquery on
    ``df``, so a long job should pass :func:`months_spanned` of its base table. ``single``
    fails the job when two periods of a key overlap, since the row would be doubled; several
    such lookups are better made by one :func:`ledgerloom.operators.sweep.sweep`.
    """
    for name, value in (constants or {}).items():
        dim = dim.filter(F.col(name) == F.lit(value))
    keep = dim.select(
        *[F.col(b).alias(f"__k_{b}") for b in on.values()],
        F.col(beg).cast("date").alias("__beg"),
        F.col(end).cast("date").alias("__end"),
        *[F.col(c).alias(o) for c, o in cols.items()],
    )
    if months is None:
        span = df.agg(F.min(month_number(F.col(date))).alias("lo"), F.max(month_number(F.col(date))).alias("hi"))
        both = span.select(F.struct("lo", "hi")).scalar()
        first, last = both["lo"], both["hi"]
    else:
        first, last = F.lit(months[0]), F.lit(months[1])
    keep = by_month(keep, "__beg", "__end", first, last)
    if single:
        earlier = Window.partitionBy("__month", *[f"__k_{b}" for b in on.values()]).orderBy("__beg", "__end")
        overlap = F.lag("__end").over(earlier) >= F.col("__beg")
        keep = keep.withColumn(
            "__month",
            F.when(overlap, F.raise_error(F.lit(f"overlapping periods for {list(on.values())}"))).otherwise(F.col("__month")),
        )
    dated = F.col(date).cast("date")
    cond = (month_number(dated) == F.col("__month")) & dated.between(F.col("__beg"), F.col("__end"))
    for a, b in on.items():
        cond = cond & (F.col(a) == F.col(f"__k_{b}"))
    return df.join(keep, cond, how).drop("__month", "__beg", "__end", *[f"__k_{b}" for b in on.values()])


def _one_box(dim: DataFrame, keys: Sequence[str], bands: Sequence[tuple[str, str]]) -> DataFrame:
    """Pass ``dim`` through, failing the job when two rows of a key hold a point in common.

    Boxes meet if they meet in every band. With one band, a row meets an earlier one (by lower bound) if it starts before the
    greatest upper bound so far. With more, the boxes of one key are compared with each other, which is meant for the few that
    a rule table has per key.
    """
    boxes = dim.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi")).alias(f"b{i}") for i, (lo, hi) in enumerate(bands)])
    group = [f"k{i}" for i in range(len(keys))]
    axes = [f"b{i}" for i in range(len(bands))]
    for c in axes:
        boxes = boxes.filter(F.col(c)["lo"] <= F.col(c)["hi"])
    if len(bands) == 1:
        before = Window.partitionBy(*group).orderBy("b0.lo", "b0.hi").rowsBetween(Window.unboundedPreceding, -1)
        met = boxes.withColumn("until", F.max("b0.hi").over(before)).filter(F.col("until") >= F.col("b0.lo"))
    else:
        # Rows alike are counted first, so a pair of different ones can be ordered by what they hold.
        boxes = boxes.groupBy(*group, *axes).agg(F.count(F.lit(1)).alias("n"))
        right = boxes.toDF(*[f"{c}_" for c in boxes.columns])
        cond = F.struct(*axes) <= F.struct(*[F.col(f"{c}_").alias(c) for c in axes])
        for g in group:
            cond = cond & (F.col(g) == F.col(f"{g}_"))
        for c in axes:
            cond = cond & (F.col(c)["lo"] <= F.col(f"{c}_")["hi"]) & (F.col(f"{c}_")["lo"] <= F.col(c)["hi"])
        same = F.struct(*axes) == F.struct(*[F.col(f"{c}_").alias(c) for c in axes])
        met = boxes.join(right, cond).filter(~same | (F.col("n") > 1))
    doubled = met.agg(F.count(F.lit(1))).scalar()
    failure = F.raise_error(F.lit(f"overlapping bands of {list(keys)}")).cast("boolean")
    return dim.filter(F.when(doubled > 0, failure).otherwise(F.lit(True)))


def band_join(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    bands: Sequence[tuple[str, str, str]],
    cols: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Equality keys plus closed bands ``(df column, dim lower, dim upper)``.

    Bands of a key that overlap would double a row and fail the job. A NULL bound holds nothing.
    """
    if not on:
        raise ValueError("a band lookup needs at least one equality key")
    dim = _one_box(dim, list(on.values()), [(lo, hi) for _, lo, hi in bands])
    keep = dim.select(
        *[F.col(b).alias(f"__k_{b}") for b in on.values()],
        *[F.col(lo).alias(f"__lo{i}") for i, (_, lo, _) in enumerate(bands)],
        *[F.col(hi).alias(f"__hi{i}") for i, (_, _, hi) in enumerate(bands)],
        *[F.col(c).alias(o) for c, o in cols.items()],
    )
    cond = None
    for a, b in on.items():
        c = F.col(a) == F.col(f"__k_{b}")
        cond = c if cond is None else cond & c
    for i, (name, _, _) in enumerate(bands):
        cond = cond & F.col(name).between(F.col(f"__lo{i}"), F.col(f"__hi{i}"))
    limits = [f"__{side}{i}" for i in range(len(bands)) for side in ("lo", "hi")]
    return df.join(keep, cond, how).drop(*limits, *[f"__k_{b}" for b in on.values()])


#: Pairs of line and period, and rules in force for them, to be sent to every task: some MB at most.
FEW_FORCE = 10_000


@dataclass(frozen=True)
class Override:
    """One value to be replaced: ``out`` is the override of ``variable`` in ``lookup`` that holds ``value``, else ``value``."""

    lookup: str
    variable: str
    value: str
    out: str


def override_lookups(
    df: DataFrame, overrides: DataFrame, wanted: Sequence[Override], period: str, line: str, occurring: DataFrame | None = None
) -> DataFrame:
    """Any number of overrides by one join on ``line`` and ``period``.

    ``overrides``: line, lookup, lookup_var, beg, end, min_val, max_val, override. Names are compared as literals; nothing is
    pasted into SQL text. Ranges and overrides may be text; they are read in the type of the value. An override without a
    beginning, an end or a bound holds nothing, so the value stays.

    The rules in force are gathered for the pairs of line and period that occur, each variable's in an array, so an open
    end costs nothing. Two rules that hold the same value at the same time fail the job.

    ``occurring`` is a stored table with all those pairs, for a ``df`` that is costly to read twice. What is gathered is then
    written, and few rows of it (:data:`FEW_FORCE`) are sent to the tasks: by the pairs, which are few, ``df`` would be dealt unevenly.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    which = F.coalesce(*[F.when((F.col("lookup") == F.lit(w.lookup)) & (F.col("lookup_var") == F.lit(w.variable)), F.lit(i)) for i, w in enumerate(wanted)])
    if len({(w.lookup, w.variable) for w in wanted}) != len(wanted):
        raise ValueError("a variable is wanted twice")
    rules = overrides.select(
        F.col("line").alias("__l"), F.col("beg").alias("__beg"), F.col("end").alias("__end"), which.alias("__which"),
        F.struct(F.col("min_val").cast("string").alias("lo"), F.col("max_val").cast("string").alias("hi"), F.col("override").cast("string").alias("to")).alias("__rule"),
    ).filter("__which is not null")
    asked = (df if occurring is None else occurring).select(F.col(line).alias("__line"), F.col(period).alias("__period")).distinct()
    # Joined by year too, so there is an equality left where the line is a constant; rules are cut to the years that occur.
    year = lambda c: F.floor(F.col(c) / 100).cast("int")
    span = asked.agg(F.struct(F.min(year("__period")).alias("lo"), F.max(year("__period")).alias("hi"))).scalar()
    first, last = F.greatest(year("__beg"), span["lo"]), F.least(year("__end"), span["hi"])
    rules = rules.filter(first <= last).withColumn("__year", F.explode(F.sequence(first, last)))
    held = F.col("__period").between(F.col("__beg"), F.col("__end")) & (year("__period") == F.col("__year"))
    force = asked.join(rules, (F.col("__line") == F.col("__l")) & held)
    gathered = [F.collect_list(F.when(F.col("__which") == i, F.col("__rule"))).alias(f"__rules{i}") for i in range(len(wanted))]
    force = force.groupBy("__line", "__period").agg(*gathered)
    if occurring is not None:
        force = written_table(force, "force")
        rows = force.agg(F.count(F.lit(1)), F.sum(sum(F.size(f"__rules{i}") for i in range(len(wanted))))).first()
        force = F.broadcast(force) if rows[0] + (rows[1] or 0) <= FEW_FORCE else force
    out = df.join(force, (F.col(line) == F.col("__line")) & (F.col(period) == F.col("__period")), "left")

    def replaced(i: int, w: Override) -> Column:
        kind, value = kinds[w.value], F.col(w.value)
        hits = F.filter(f"__rules{i}", lambda r: value.between(r["lo"].try_cast(kind), r["hi"].try_cast(kind)))
        failure = F.raise_error(F.lit(f"overlapping overrides of {w.lookup} {w.variable}")).cast(kind)
        return F.when(F.size(hits) > 1, failure).otherwise(F.coalesce(F.get(hits, F.lit(0))["to"].try_cast(kind), value))

    new = {w.out: replaced(i, w) for i, w in enumerate(wanted)}
    return out.withColumns(new).drop("__line", "__period", *[f"__rules{i}" for i in range(len(wanted))])


def override_lookup(
    df: DataFrame,
    overrides: DataFrame,
    lookup: str,
    variable: str,
    value: str,
    period: str,
    line: str,
    out: str,
) -> DataFrame:
    """One override; see :func:`override_lookups`."""
    return override_lookups(df, overrides, [Override(lookup, variable, value, out)], period, line)


def metric_lookup(df: DataFrame, metrics: DataFrame, on: Mapping[str, str], label: str, value: str,
                  wanted: Mapping[object, str]) -> DataFrame:
    """Several metrics of one long table: pivot the wanted labels once, then one equi-join."""
    (left_key, right_key), = on.items()
    wide = (
        metrics.filter(F.col(label).isin(*wanted))
        .groupBy(F.col(right_key).alias("__k"))
        .pivot(label, list(wanted))
        .agg(F.max(value))
    )
    for name, out in wanted.items():
        wide = wide.withColumnRenamed(str(name), out)
    return df.join(wide, df[left_key] == wide["__k"], "left").drop("__k")
