"""Leading-digit frequencies and their goodness of fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = range(1, 10)


def leading_digit(amount: Column) -> Column:
    """First significant digit of a positive amount, 0 below 1 (callers drop it).

    Taken from the whole part's decimal text, which has no rounding at powers of ten.
    """
    return F.substring(F.floor(amount).cast("string"), 1, 1).cast("int")


def digit_frequencies(df: DataFrame, entity: str, amount: str, only: object = None, min_rows: int = 2) -> DataFrame:
    """Rows per entity and digit, for entities with more than ``min_rows`` rows.

    All of an entity's rows count towards ``min_rows``, only positive amounts towards digits.
    The rows of an entity are counted in the same aggregation, so nothing is windowed.
    """
    if only is not None:
        df = df.filter(F.col(entity) == F.lit(only))
    digit = F.when(F.col(amount) > 0, leading_digit(F.col(amount)))
    counts = df.groupBy(entity, digit.alias("digit")).agg(F.count(F.lit(1)).alias("freq"))
    # Ten rows per entity at most from here on.
    sizes = counts.groupBy(F.col(entity).alias("__e")).agg(F.sum("freq").alias("__n")).filter(F.col("__n") > min_rows)
    return counts.filter(F.col("digit").between(1, 9)).join(
        sizes, F.col(entity).eqNullSafe(F.col("__e")), "left_semi"
    ).select(entity, "digit", "freq")


def digits_wide(freqs: DataFrame, entity: str) -> DataFrame:
    """One row per entity, one column per digit, 0 where a digit is missing."""
    wide = freqs.groupBy(entity).pivot("digit", list(DIGITS)).agg(F.sum("freq"))
    return wide.select(entity, *[F.coalesce(F.col(f"`{d}`"), F.lit(0)).alias(f"digit{d}") for d in DIGITS])


def digits_long(wide: DataFrame, entity: str) -> DataFrame:
    """Back from one column per digit to one row per digit."""
    names = [f"digit{d}" for d in DIGITS]
    return wide.unpivot([entity], names, "digit_name", "freq")


def expected_share(digit: Column) -> Column:
    """Share of a leading digit under Benford's law."""
    return F.log10(1 + 1 / digit)


def chi_square_tail(statistic: Column) -> Column:
    """P-value of a chi-square statistic with 8 degrees of freedom, which has a closed form."""
    y = statistic / 2
    return F.exp(-y) * (1 + y + y * y / 2 + y * y * y / 6)


def suspicious_entities(df: DataFrame, entity: str, amount: str, threshold: float = 0.1) -> DataFrame:
    """Entities whose leading digits depart from the law: digit counts and p-value below the threshold."""
    freqs = digit_frequencies(df, entity, amount)
    # sum (c - n e)^2 / (n e) = sum c^2 / e / n - n: digits that do not occur add nothing, so
    # counts and statistic come from one aggregation.
    c = F.col("freq")
    found = freqs.groupBy(entity).agg(
        *[F.coalesce(F.sum(F.when(F.col("digit") == d, c)), F.lit(0)).alias(f"digit{d}") for d in DIGITS],
        F.sum(c).alias("__n"),
        F.sum(c * c / expected_share(F.col("digit"))).alias("__q"),
    )
    tested = found.withColumn("p_value", chi_square_tail(F.col("__q") / F.col("__n") - F.col("__n")))
    return tested.filter(F.col("p_value") < threshold).drop("__n", "__q")


def digit_profile(freqs: DataFrame, entity: str) -> DataFrame:
    """Actual and expected percent per digit of each entity."""
    totals = freqs.groupBy(F.col(entity).alias("__e")).agg(F.sum("freq").alias("__n"))
    return freqs.join(totals, F.col(entity).eqNullSafe(F.col("__e"))).select(
        entity,
        "digit",
        F.round(F.lit(100.0) * F.col("freq") / F.col("__n")).cast("int").alias("actual_pct"),
        F.round(F.lit(100.0) * expected_share(F.col("digit"))).cast("int").alias("expected_pct"),
    )
