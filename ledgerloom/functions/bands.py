"""Ordered thresholds, code maps and fallbacks as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
    ">": lambda c, b: c > b,
    ">=": lambda c, b: c >= b,
    "==": lambda c, b: c == b,
}

# Term bands in months, score grades, vehicle age classes, prepayment speeds,
# tax rates by first booking date. Rules are tried in order.
TERM_BANDS = [("<=", 24, 24), ("<=", 36, 36), ("<=", 39, 39), ("<=", 42, 42), ("<=", 48, 48)]
TERM_DEFAULT = 60
SCORE_GRADES = [(">", 729, "tier1"), (">", 699, "tier2"), (">", 679, "tier3"), (">", 659, "tier4")]
SCORE_DEFAULT = "tier5"
AGE_CLASSES = [
    ("<", -24, "used5+"), ("<=", 0, "new"), ("<=", 12, "used0"), ("<=", 24, "used1"),
    ("<=", 36, "used2"), ("<=", 48, "used3"), ("<=", 60, "used4"),
]
AGE_DEFAULT = "used5+"
PREPAY_SPEEDS = [("<=", 24, 0.030), ("<=", 48, 0.013)]
PREPAY_DEFAULT = 0.015
TAX_RATES = [
    (">=", "2011-01-01", 0.4035), (">=", "2010-01-01", 0.4275),
    (">=", "2009-12-01", 0.4075), (">=", "2006-01-01", 0.395),
]
TAX_DEFAULT = 0.39

# Two-digit state codes.
STATE_CODES = {
    "01": "al", "02": "ak", "03": "az", "04": "ar", "05": "ca", "06": "co", "07": "ct", "08": "de", "09": "dc",
    "10": "fl", "11": "ga", "12": "hi", "13": "id", "14": "il", "15": "in", "16": "ia", "17": "ks", "18": "ky",
    "19": "la", "20": "me", "21": "md", "22": "ma", "23": "mi", "24": "mn", "25": "ms", "26": "mo", "27": "mt",
    "28": "ne", "29": "nv", "30": "nh", "31": "nj", "32": "nm", "33": "ny", "34": "nc", "35": "nd", "36": "oh",
    "37": "ok", "38": "or", "39": "pa", "40": "ri", "41": "sc", "42": "sd", "43": "tn", "44": "tx", "45": "ut",
    "46": "vt", "47": "va", "48": "wa", "49": "wv", "50": "wi", "51": "wy", "70": "ca", "72": "pr", "78": "vi",
}
STATE_DEFAULT = "xx"


def band(column: Column, rules: Sequence[tuple[str, object, object]], default: object) -> Column:
    """First rule ``(operator, bound, label)`` that holds gives the label; NULL gets the default."""
    out = None
    for op, bound, label in rules:
        test = _COMPARE[op](column, F.lit(bound))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def band_by_date(column: Column, rules: Sequence[tuple[str, str, object]], default: object) -> Column:
    """As :func:`band`, with ISO dates as bounds."""
    out = None
    for op, bound, label in rules:
        test = _COMPARE[op](column, F.lit(bound).cast("date"))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def code_map(column: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Code to label from a literal map; unknown codes get ``default`` (NULL if none)."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def prefix_rules(code: Column, rules: Sequence[tuple[int, str, str, str]], otherwise: Column) -> Column:
    """Rules ``(length, low, high, label)`` on the code's prefix, else the trimmed fallback."""
    out = None
    for length, low, high, label in rules:
        test = F.substring(code, 1, length).between(low, high)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.trim(otherwise) if out is None else out.otherwise(F.trim(otherwise))


def first_positive(columns: Sequence[Column], default: object) -> Column:
    """The first column greater than zero, else ``default``."""
    out = None
    for c in columns:
        out = F.when(c > 0, c) if out is None else out.when(c > 0, c)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def loan_to_value(amount: Column, collateral: Column) -> Column:
    """Percent of the collateral value; 999 when none is known (collateral 1)."""
    return F.when(collateral == 1, F.lit(999.0)).otherwise(F.try_divide(amount, collateral) * 100)


def flip_flag(column: Column) -> Column:
    """1 to 0, anything else (NULL too) to 1."""
    return F.when(column == 1, 0).otherwise(1)
