"""Leading-digit screening of prices per supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import fraud
from ledgerloom.plans.registry import query, table

FREQS = """
    WITH f AS (SELECT l_suppkey, l_extendedprice, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
    freqs AS (SELECT l_suppkey, CAST(substr(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), 1, 1) AS INTEGER) AS digit,
              count(*) AS freq FROM f WHERE n > 2 AND l_extendedprice >= 1 GROUP BY 1, 2)
"""
WIDE = FREQS + ", wide AS (SELECT l_suppkey, " + ", ".join(
    f"CAST(coalesce(sum(freq) FILTER (WHERE digit = {k}), 0) AS BIGINT) AS digit{k}" for k in range(1, 10)
) + " FROM freqs GROUP BY 1)"
TOTAL = "(" + " + ".join(f"digit{k}" for k in range(1, 10)) + ")"
CHI = " + ".join(f"pow(digit{k} - {TOTAL} * log10(1 + 1.0 / {k}), 2) / ({TOTAL} * log10(1 + 1.0 / {k}))" for k in range(1, 10))


@query("benford_digits", FREQS + "SELECT l_suppkey, digit, freq FROM freqs")
def benford_digits(spark, d):
    return fraud.digit_frequencies(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice")


@query(
    "benford_fraud",
    WIDE + f""", y AS (SELECT *, ({CHI}) / 2 AS y FROM wide),
    p AS (SELECT *, exp(-y) * (1 + y + y * y / 2 + y * y * y / 6) AS p FROM y)
    SELECT l_suppkey, digit1, digit5, digit9, round(p, 6) AS p_value FROM p WHERE p < 0.1
    """,
)
def benford_fraud(spark, d):
    out = fraud.suspicious_entities(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", 0.1)
    return out.select("l_suppkey", "digit1", "digit5", "digit9", F.round("p_value", 6).alias("p_value"))


@query(
    "benford_profile",
    FREQS + """
    SELECT l_suppkey, digit, CAST(round(100.0 * freq / sum(freq) OVER (PARTITION BY l_suppkey)) AS INTEGER) AS actual_pct,
           CAST(round(100 * log10(1 + 1.0 / digit)) AS INTEGER) AS expected_pct FROM freqs
    """,
)
def benford_profile(spark, d):
    freqs = fraud.digit_frequencies(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice")
    return fraud.digit_profile(freqs, "l_suppkey")
