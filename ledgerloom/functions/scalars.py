"""Text, date and cast helpers that Spark has no single function for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_prefix(text: Column, prefix: str) -> Column:
    """The rest of ``text`` after ``prefix``, or NULL when it does not start with it."""
    return F.when(text.startswith(prefix), F.right(text, F.length(text) - F.lit(len(prefix))))


def packed_value(packed: Column, index: Column, size: int = 84, sep: str = r"\|") -> Column:
    """Value number ``index`` (from 0, wrapping at ``size``) of a separator-packed list."""
    return F.try_element_at(F.split(packed, sep), (F.pmod(index, F.lit(size)) + 1).cast("int")).try_cast("double")


def year_month_to_date(value: Column) -> Column:
    """``yyyyMM`` or ``yyyyMMdd`` (text or number) to a date; anything else gives NULL."""
    text = value.cast("string")
    full = F.when(F.length(text) == 6, F.concat(text, F.lit("01"))).otherwise(text)
    return F.try_to_timestamp(full, F.lit("yyyyMMdd")).cast("date")


def year_month(d: Column) -> Column:
    """A date's ``yyyyMM`` as an int."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def prior_month_end(d: Column) -> Column:
    return F.last_day(F.add_months(d, -1))


def months_since_model_year(booked: Column, model_year: Column) -> Column:
    """Months from 1 March of the model year to the booking date."""
    return F.months_between(booked, F.make_date(model_year.cast("int"), F.lit(3), F.lit(1)))


def _weekday_shift(d: Column, n: Column) -> Column:
    """The ``n``-th weekday after ``d``: whole weeks at once, the rest steps over one weekend at most."""
    dow = F.weekday(d)
    rest = (n % 5).cast("int")
    over = F.when(F.least(dow, F.lit(4)) + rest > 4, 2).otherwise(0)
    return F.date_add(F.date_sub(d, F.greatest(dow - 4, F.lit(0))), F.floor(n / 5).cast("int") * 7 + rest + over)


def add_business_days(d: Column, n: Column, holidays: list[date] | None = None) -> Column:
    """The ``n``-th working day after ``d`` (``n`` >= 0); a weekend start counts from the Friday before.

    Holidays are a literal list. One pass over them in order counts those that the shift so far has
    passed, each pushing it a day further, so the plan grows with the list and no faster.
    """
    if not holidays:
        return _weekday_shift(d, n)
    off = F.array(*[F.lit(h) for h in sorted({h for h in holidays if h.weekday() < 5})]).cast("array<date>")
    passed = F.aggregate(
        off, F.lit(0), lambda k, h: k + F.when((h > d) & (h <= _weekday_shift(d, (n + k).cast("int"))), 1).otherwise(0)
    )
    return _weekday_shift(d, (n + passed).cast("int"))


def path_level(path: Column, sep: str = "/") -> Column:
    """Depth of a node in a ``/a/b/`` path; the root ``/`` is level 0."""
    return F.size(F.filter(F.split(path, sep), lambda s: s != "")).cast("int")


def join_non_null(first: Column, second: Column, sep: str = ", ") -> Column:
    """``first``, followed by ``sep`` and ``second`` when that is not NULL."""
    return F.concat(first, F.coalesce(F.concat(F.lit(sep), second), F.lit("")))
