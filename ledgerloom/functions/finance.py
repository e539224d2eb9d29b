"""Annuity, payment and run-off formulas as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TINY = 1e-9
FLOOR = -0.99


def future_value(rate: Column, periods: Column, payment: Column, present: Column, due: Column) -> Column:
    """Value after ``periods``; ``due`` is 1 for payments at the start of a period. Rate 0 is the limit."""
    growth = F.pow(1 + rate, periods)
    flat = present + payment * periods
    return F.when(F.abs(rate) < TINY, flat).otherwise(
        present * growth + payment * (growth - 1) * (1 + rate * due) / rate
    )


def _values(rate, n, payment, present, target, due) -> np.ndarray:
    """Future value less target; at a rate of 0 its limit. Close to 0 by ``expm1``, which keeps the digits that ``growth - 1`` loses."""
    with np.errstate(all="ignore"):
        grown = np.expm1(n * np.log1p(rate))
        small = np.abs(rate) < TINY
        r = np.where(small, 1.0, rate)
        annuity = np.where(small, n, grown / r)
        return present * (1 + grown) + payment * annuity * (1 + np.where(small, 0.0, rate) * due) - target


#: Rates per period between which a sign change is looked for.
_GRID = np.array([-0.99, -0.9, -0.7, -0.5, -0.3, -0.2, -0.1, -0.05, -0.02, -0.01, -1e-3, -1e-4, 0.0, 1e-4, 1e-3, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1, 2, 5, 10])


def _bracketed(n, payment, present, target, due, guess: float, halvings: int = 80) -> np.ndarray:
    """Bisection in the interval of ``_GRID`` that has a sign change and lies nearest to ``guess``; NaN without one."""
    values = np.stack([_values(np.full(len(n), r), n, payment, present, target, due) for r in _GRID])
    changed = np.isfinite(values[:-1]) & np.isfinite(values[1:]) & (np.sign(values[:-1]) != np.sign(values[1:]))
    away = np.abs((_GRID[:-1] + _GRID[1:]) / 2 - guess)
    at = np.argmin(np.where(changed, away[:, None], np.inf), axis=0)
    low, high = _GRID[at], _GRID[at + 1]
    sign = np.sign(_values(low, n, payment, present, target, due))
    for _ in range(halvings):
        middle = (low + high) / 2
        same = np.sign(_values(middle, n, payment, present, target, due)) == sign
        low, high = np.where(same, middle, low), np.where(same, high, middle)
    # A root at the lower end has no sign of its own.
    return np.where(changed.any(axis=0), np.where(sign == 0, _GRID[at], (low + high) / 2), np.nan)


def _newton(n, payment, present, target, due, guess: float, steps: int) -> np.ndarray:
    """Newton steps for a batch of annuities at once, and bisection for those that do not settle; NaN where no root is found."""
    rate = np.full(len(n), guess)
    settled = np.zeros(len(n), dtype=bool)
    with np.errstate(all="ignore"):
        for _ in range(steps):
            growth = (1 + rate) ** n
            lift = n * growth / (1 + rate)
            small = np.abs(rate) < TINY
            r = np.where(small, 1.0, rate)
            value = _values(rate, n, payment, present, target, due)
            slope = np.where(
                small,
                present * n + payment * (n * (n - 1) / 2 + n * due),
                present * lift + payment * (lift * (1 + r * due) / r - (growth - 1) / (r * r)),
            )
            moved = np.maximum(rate - value / slope, FLOOR)
            # Resting on the floor is no root.
            settled = (np.abs(moved - rate) < 1e-9) & (moved > FLOOR)
            rate = moved
            if settled.all():
                break
        left = ~settled & np.isfinite(n + payment + present + target + due)
        if left.any():
            rate[left] = _bracketed(n[left], payment[left], present[left], target[left], due[left], guess)
            settled[left] = np.isfinite(rate[left])
    return np.where(settled, rate, np.nan)


def implied_rate(
    periods: Column, payment: Column, present: Column, target: Column, due: Column, guess: float = 0.01, steps: int = 25
) -> Column:
    """Rate per period at which :func:`future_value` reaches ``target``, by Newton steps backed by bisection.

    The sign convention is the caller's: repaying ``-present`` down to a residual needs
    ``target = -residual``. Where the steps do not settle, the root nearest to ``guess`` between -99 % and 1000 % is bracketed;
    NULL only without one, or when an argument is NULL.

    A root search has no closed form, and Spark evaluates a folded lambda node by node
    (measured: about five times slower), so batches go to numpy through Arrow.
    """

    @F.pandas_udf(T.DoubleType())
    def solve(n: pd.Series, pmt: pd.Series, pv: pd.Series, fv: pd.Series, at: pd.Series) -> pd.Series:
        found = _newton(*[x.to_numpy(dtype=float, na_value=np.nan) for x in (n, pmt, pv, fv, at)], guess, steps)
        return pd.Series(found).astype("object").where(~np.isnan(found), None)

    return solve(*[c.cast("double") for c in (periods, payment, present, target, due)])


def payment_columns(
    df: DataFrame, cost: str, residual: str, months: str, buy_rate: str, money_factor: str, markup: str, subsidised: str
) -> DataFrame:
    """Depreciation, buy-rate, customer, programme and standard programme payments."""
    total = F.col(cost) + F.col(residual)
    base = F.try_divide(F.col(cost) - F.col(residual), F.col(months))
    programme = base + total * F.col(markup)
    return df.withColumns(
        {
            "pmt_depreciation": base,
            "pmt_buy_rate": base + F.try_divide(total, F.col(buy_rate)),
            "pmt_customer": base + total * F.col(money_factor),
            "pmt_programme": F.when(F.col(subsidised) == 1, programme).otherwise(0.0),
            "pmt_standard_programme": F.when(F.col(subsidised) == 0, programme).otherwise(0.0),
        }
    )


def cost_of_capital(debt_cost: Column, tax_rate: Column, equity_share: Column, equity_cost: Column) -> Column:
    return debt_cost * (1 - tax_rate) * (1 - equity_share) + equity_share * equity_cost


def gross_up(amount: Column, balance: Column, discounted_balance: Column) -> Column:
    """Spread an up-front amount over the discounted balance; NULL when that is zero."""
    return amount * F.try_divide(balance, discounted_balance)


def marginal_costs(df: DataFrame, triples: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Products ``expense * marginal rate`` for a list of (expense, rate, output) names."""
    return df.withColumns({out: F.col(expense) * F.col(rate) for expense, rate, out in triples})


# Run-off with constant prepayment. For a contract with cost C, residual V, term T,
# prepayment share a per period, D = C - V and z = D / T, the balance recurrence
#     remaining depreciation S_p = (S_{p-1} - z u_{p-1}) u_p / u_{p-1},  u_p = 1 - a p
# solves to S_p = (D - z p) u_p, the residual left is V u_p, and the balance is
# (C - z p) u_p. The amount paid off in period p is linear in p, so every
# curve-weighted sum needs only the curve's first two moments up to T - 1: no
# period-by-period loop per contract, and no exploded schedule.


def curve_moments(
    curves: DataFrame, name: str, curve: str, max_term: int | Column, size: int = 84, terms: Sequence[int] | None = None
) -> DataFrame:
    """Per curve and term: ``m1 = sum p c_p`` and ``m2 = sum p^2 c_p`` over periods 1 .. term - 1.

    One row per curve and term up to ``max_term``, or for ``terms`` only, which keeps the
    table small enough to be broadcast. ``max_term`` may be a scalar subquery, so that the terms
    that occur decide. The curve wraps after ``size`` points; one that has fewer and
    would be needed beyond them fails the job.
    """
    longest = (max_term if isinstance(max_term, Column) else F.lit(max_term)).cast("int")
    points = F.slice(F.split(F.col(curve), r"\|"), 1, size)
    short = F.size(points) < F.least(F.lit(size), longest - 1)
    points = F.when(short, F.raise_error(F.concat(F.lit("too few points in curve "), F.col(name))).cast("array<string>")).otherwise(points)
    wrapped = F.flatten(F.array_repeat(points, F.ceil(longest / size).cast("int")))
    # Element p is the rate of period p; element 0 stands for no period at all (term 1).
    rates = F.concat(F.array(F.lit("0")), F.slice(wrapped, F.lit(1), F.greatest(longest - 1, F.lit(0))))
    periods = curves.select(name, F.posexplode(rates).alias("p", "rate"))
    value = F.col("rate").cast("double")
    p = F.col("p")
    upto = Window.partitionBy(name).orderBy("p")
    moments = periods.select(
        name, (p + 1).alias("term"), F.sum(p * value).over(upto).alias("m1"), F.sum(p * p * value).over(upto).alias("m2")
    )
    return moments if terms is None else moments.filter(F.col("term").isin(*terms))


def by_curve(moments: DataFrame) -> DataFrame:
    """One row per curve: its name and the moments of all tabulated terms, by term. A run-off then needs one join per curve."""
    name = moments.columns[0]
    entries = F.collect_list(F.struct("term", F.struct("m1", "m2")))
    return moments.groupBy(name).agg(F.map_from_entries(entries).alias("moments"))


@F.pandas_udf(T.DoubleType())
def _discounted_balance(cost: pd.Series, z: pd.Series, a: pd.Series, n: pd.Series, factor: pd.Series) -> pd.Series:
    """``sum (1 - a p)(cost - z p) factor^p`` over periods 1 .. n, a batch of contracts at a time.

    The discount differs per contract and its closed form loses all digits for small rates,
    so the sum is taken by Horner's rule from the last period down.
    """
    c, z, a, n, v = (x.to_numpy(dtype=float, na_value=np.nan) for x in (cost, z, a, n, factor))
    total = np.where(np.isnan(c + z + a + n + v), np.nan, 0.0)
    last = int(np.nanmax(n)) if len(n) and not np.isnan(n).all() else 0
    for p in range(last, 0, -1):
        total = np.where(n >= p, (total + (1 - a * p) * (c - z * p)) * v, total)
    return pd.Series(total).astype("object").where(~np.isnan(total), None)


def runoff_columns(cost: Column, residual: Column, term: Column, speed: Column, wacc: Column) -> Mapping[str, Column]:
    """``bal_sum``, ``bal_disc_sum``, ``int_sum`` and the linear weights ``c1``, ``c2`` of a contract.

    A curve with moments m1, m2 then costs ``(c1 m1 - c2 m2) / int_sum``.
    """
    t = F.when(term == 0, 1).otherwise(term).cast("double")
    n = t - 1
    cost, residual, a = cost.cast("double"), residual.cast("double"), speed.cast("double")
    z = (cost - residual) / t
    s1 = n * (n + 1) / 2
    s2 = n * (n + 1) * (2 * n + 1) / 6
    c1 = z + a * (cost - residual) + a * z + a * residual
    c2 = 2 * a * z
    discounted = _discounted_balance(cost, z, a, n, 1 / (1 + wacc.cast("double") / 12))
    return {
        "bal_sum": cost * n - (z + a * cost) * s1 + a * z * s2,
        "bal_disc_sum": discounted,
        "int_sum": 1 + c1 * s1 - c2 * s2,
        "c1": c1,
        "c2": c2,
    }


def run_off(
    df: DataFrame,
    moments: Mapping[str, DataFrame],
    curve_keys: Mapping[str, str],
    cost: str,
    residual: str,
    term: str,
    speed: str,
    wacc: str,
    balances: tuple[str, str] | None = ("anr", "anr_disc"),
) -> DataFrame:
    """Curve-weighted rates per contract, and average balances.

    ``moments``: output name to a table from :func:`curve_moments` (name, term, m1, m2) or
    :func:`by_curve`; one that several outputs share is best written once. ``curve_keys``: output name to the df column with the curve's name. If any of
    the curves is missing, everything is 0. A term that is not tabulated though its curve is
    fails the job.
    """
    pieces = runoff_columns(F.col(cost), F.col(residual), F.col(term), F.col(speed), F.col(wacc))
    out = df.withColumns({f"__{k}": v for k, v in pieces.items()})
    out = out.withColumn("__t", F.when(F.col(term) == 0, 1).otherwise(F.col(term)).cast("int"))
    complete = F.lit(True)
    for name, table in moments.items():
        table = by_curve(table) if "term" in table.columns else table
        side = table.select(F.col(table.columns[0]).alias(f"__c_{name}"), F.col("moments").alias(f"__m_{name}"))
        out = out.join(side, F.col(curve_keys[name]) == F.col(f"__c_{name}"), "left")
        held = F.col(f"__m_{name}")[F.col("__t")]
        out = out.withColumns({f"__m1_{name}": held["m1"], f"__m2_{name}": held["m2"]})
        untold = F.col(f"__m_{name}").isNotNull() & held.isNull() & F.col("__t").isNotNull()
        absent = F.raise_error(F.concat(F.lit(f"{name}: no moments for term "), F.col("__t").cast("string"))).cast("boolean")
        complete = complete & F.when(untold, absent).otherwise(F.col(f"__m1_{name}").isNotNull())
    results = {}
    for name in moments:
        rate = (F.col("__c1") * F.col(f"__m1_{name}") - F.col("__c2") * F.col(f"__m2_{name}")) / F.col("__int_sum")
        results[name] = F.when(complete, rate).otherwise(0.0)
    if balances:
        anr, disc = balances
        results[anr] = F.when(complete, F.col("__bal_sum") / 12).otherwise(0.0)
        results[disc] = F.when(complete, F.col("__bal_disc_sum") / 12).otherwise(0.0)
    temporary = [f"__{k}" for k in pieces] + ["__t"]
    temporary += [f"__{k}_{name}" for name in moments for k in ("c", "m", "m1", "m2")]
    return out.withColumns(results).drop(*temporary)
