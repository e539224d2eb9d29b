"""Lease arithmetic on line items read as contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import bands, finance
from ledgerloom.plans.registry import mean, query, table

KEY = ["l_orderkey", "l_linenumber", "l_partkey"]

CONTRACTS = """
    WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS cost, l_extendedprice * 0.45 AS residual,
      CASE WHEN l_quantity <= 24 THEN 24 WHEN l_quantity <= 36 THEN 36 WHEN l_quantity <= 39 THEN 39
           WHEN l_quantity <= 42 THEN 42 WHEN l_quantity <= 48 THEN 48 ELSE 60 END AS term,
      CASE WHEN l_quantity <= 24 THEN 0.03 WHEN l_quantity <= 48 THEN 0.013 ELSE 0.015 END::DOUBLE AS speed,
      0.001 + l_tax / 100 AS money_factor, l_quantity * 10 + 1 AS buy_rate, l_discount / 100 AS markup,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS subsidised, l_tax AS tax, l_discount AS share,
      l_returnflag, l_linestatus FROM lineitem)
"""


def contracts(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.select(
        *KEY,
        F.col("l_extendedprice").alias("cost"),
        (F.col("l_extendedprice") * 0.45).alias("residual"),
        bands.band(F.col("l_quantity"), bands.TERM_BANDS, bands.TERM_DEFAULT).alias("term"),
        bands.band(F.col("l_quantity"), bands.PREPAY_SPEEDS, bands.PREPAY_DEFAULT).alias("speed"),
        (0.001 + F.col("l_tax") / 100).alias("money_factor"),
        (F.col("l_quantity") * 10 + 1).alias("buy_rate"),
        (F.col("l_discount") / 100).alias("markup"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("subsidised"),
        F.col("l_tax").alias("tax"),
        F.col("l_discount").alias("share"),
        "l_returnflag",
        "l_linestatus",
    )


@query(
    "finance_fv",
    CONTRACTS + """
    SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN tax = 0 THEN cost - 100.0 * term
      ELSE cost * pow(1 + tax / 12, term) - 100.0 * (pow(1 + tax / 12, term) - 1) * (1 + tax / 12) / (tax / 12) END, 2) AS fv FROM c
    """,
)
def finance_fv(spark, d):
    fv = finance.future_value(F.col("tax") / 12, F.col("term"), F.lit(-100.0), F.col("cost"), F.lit(1))
    return contracts(spark, d).select(*KEY, F.round(fv, 2).alias("fv"))


@query(
    "finance_payments",
    CONTRACTS + """
    SELECT l_orderkey, l_linenumber, l_partkey, (cost - residual) / term AS pmt_depreciation,
      (cost - residual) / term + (cost + residual) / buy_rate AS pmt_buy_rate,
      (cost - residual) / term + (cost + residual) * money_factor AS pmt_customer,
      CASE WHEN subsidised = 1 THEN (cost - residual) / term + (cost + residual) * markup ELSE 0 END AS pmt_programme,
      CASE WHEN subsidised = 0 THEN (cost - residual) / term + (cost + residual) * markup ELSE 0 END AS pmt_standard_programme
    FROM c
    """,
)
def finance_payments(spark, d):
    names = ["pmt_depreciation", "pmt_buy_rate", "pmt_customer", "pmt_programme", "pmt_standard_programme"]
    paid = finance.payment_columns(contracts(spark, d), "cost", "residual", "term", "buy_rate", "money_factor", "markup", "subsidised")
    return paid.select(*KEY, *names)


@query(
    "finance_rate",
    CONTRACTS + """,
    p AS (SELECT *, (cost - residual) / term + (cost + residual) * money_factor AS pmt FROM c),
    solved AS (SELECT *, list_reduce(list_concat([0.01::DOUBLE], [i::DOUBLE for i in range(25)]), lambda r, i:
      r - (-cost * pow(1 + r, term) + pmt * (pow(1 + r, term) - 1) * (1 + r) / r + residual)
        / (-cost * term * pow(1 + r, term) / (1 + r)
           + pmt * (term * pow(1 + r, term) / (1 + r) * (1 + r) / r - (pow(1 + r, term) - 1) / (r * r)))) AS rate FROM p)
    SELECT l_orderkey, l_linenumber, l_partkey, round(12 * rate, 6) AS customer_rate FROM solved
    """,
)
def finance_rate(spark, d):
    paid = finance.payment_columns(contracts(spark, d), "cost", "residual", "term", "buy_rate", "money_factor", "markup", "subsidised")
    # Repayment down to the residual: what is owed is negative, so is the target.
    rate = finance.implied_rate(F.col("term"), F.col("pmt_customer"), -F.col("cost"), -F.col("residual"), F.lit(1))
    return paid.select(*KEY, F.round(12 * rate, 6).alias("customer_rate"))


def curves(spark, d):
    """Rate curves of 84 points, named by return flag and line status, from the mean tax."""
    lines = table(spark, d, "lineitem")
    means = lines.groupBy(F.col("l_returnflag").alias("name")).agg(mean("l_tax").alias("m")).union(
        lines.groupBy("l_linestatus").agg(mean("l_tax"))
    )
    points = F.transform(
        F.sequence(F.lit(0), F.lit(83)), lambda i: F.format_number(F.round("m", 4) + i * 0.0005, 6)
    )
    return means.select("name", F.concat_ws("|", points).alias("curve"))


@query(
    "finance_runoff",
    CONTRACTS.replace("WITH c", "WITH RECURSIVE c") + """,
    m AS (SELECT l_returnflag AS name, round(round(sum(l_tax), 2) / count(l_tax), 4) AS m FROM lineitem GROUP BY 1
          UNION ALL SELECT l_linestatus, round(round(sum(l_tax), 2) / count(l_tax), 4) FROM lineitem GROUP BY 1),
    start AS (SELECT c.*, a.m AS ma, b.m AS mb, cost - residual AS dep0, (cost - residual) / term AS z, row_number() OVER () AS id
      FROM c LEFT JOIN m a ON a.name = CASE WHEN l_linenumber < 7 THEN l_returnflag END LEFT JOIN m b ON b.name = l_linestatus),
    r AS (SELECT id, 1 AS p, 0.0::DOUBLE AS b, 0.0::DOUBLE AS rr, 0.0::DOUBLE AS bal, 0.0::DOUBLE AS disc, 1.0::DOUBLE AS intr,
        0.0::DOUBLE AS ca, 0.0::DOUBLE AS cb, cost, residual, term, speed, ma, mb, dep0, z FROM start WHERE ma IS NOT NULL AND mb IS NOT NULL
      UNION ALL
      SELECT id, p + 1, b + tot, rr + w, bal + (cost - b - tot - rr - w), disc + (cost - b - tot - rr - w) / pow(1 + 0.03 / 12, p),
        intr + (tot + w) * p, ca + (tot + w) * p * round(ma + ((p - 1) % 84) * 0.0005, 6) / 12,
        cb + (tot + w) * p * round(mb + ((p - 1) % 84) * 0.0005, 6) / 12, cost, residual, term, speed, ma, mb, dep0, z
      FROM (SELECT *, z * (1 - speed * (p - 1)) + (dep0 - z * (1 - speed * (p - 1)) - b) * speed / (1 - speed * (p - 1)) AS tot,
                   (residual - rr) * speed / (1 - speed * (p - 1)) AS w FROM r WHERE p < term))
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(round(r.ca / intr * 12, 6), 0) AS cof, coalesce(round(r.cb / intr * 12, 6), 0) AS lp,
           coalesce(round(bal / 12, 1), 0) AS anr, coalesce(round(disc / 12, 1), 0) AS anr_disc
    FROM start LEFT JOIN r ON r.id = start.id AND r.p = start.term
    """,
)
def finance_runoff(spark, d):
    longest = contracts(spark, d).agg(F.max("term")).scalar()
    moments = finance.curve_moments(curves(spark, d), "name", "curve", max_term=longest)
    # Line 7 has no cost-of-funds curve, so its results are 0.
    keyed = contracts(spark, d).withColumns(
        {"cof_curve": F.when(F.col("l_linenumber") < 7, F.col("l_returnflag")), "wacc": F.lit(0.03)}
    )
    out = finance.run_off(
        keyed, {"cof": moments, "lp": moments}, {"cof": "cof_curve", "lp": "l_linestatus"},
        "cost", "residual", "term", "speed", "wacc",
    )
    return out.select(
        *KEY, F.round("cof", 6).alias("cof"), F.round("lp", 6).alias("lp"), F.round("anr", 1).alias("anr"),
        F.round("anr_disc", 1).alias("anr_disc"),
    )


@query(
    "finance_wacc",
    CONTRACTS + "SELECT l_orderkey, l_linenumber, l_partkey, round(tax * (1 - 0.4035) * (1 - share) + share * 0.1, 8) AS wacc FROM c",
)
def finance_wacc(spark, d):
    wacc = finance.cost_of_capital(F.col("tax"), F.lit(0.4035), F.col("share"), F.lit(0.1))
    return contracts(spark, d).select(*KEY, F.round(wacc, 8).alias("wacc"))


@query(
    "finance_grossup",
    CONTRACTS + """
    SELECT l_orderkey, l_linenumber, l_partkey, round(cost * tax * (cost / residual), 6) AS revenue,
           round(CASE WHEN subsidised = 1 THEN (money_factor - 0.0435) * cost ELSE 0 END, 6) AS buydown FROM c
    """,
)
def finance_grossup(spark, d):
    revenue = finance.gross_up(F.col("cost") * F.col("tax"), F.col("cost"), F.col("residual"))
    buydown = F.when(F.col("subsidised") == 1, (F.col("money_factor") - 0.0435) * F.col("cost")).otherwise(0.0)
    return contracts(spark, d).select(*KEY, F.round(revenue, 6).alias("revenue"), F.round(buydown, 6).alias("buydown"))


@query(
    "finance_marginal",
    CONTRACTS + """
    SELECT l_orderkey, l_linenumber, l_partkey, round(cost * tax, 6) AS sales_marginal, round(residual * share, 6) AS servicing_marginal,
           round(money_factor * markup, 10) AS credit_marginal FROM c
    """,
)
def finance_marginal(spark, d):
    triples = [
        ("cost", "tax", "sales_marginal"), ("residual", "share", "servicing_marginal"), ("money_factor", "markup", "credit_marginal"),
    ]
    out = finance.marginal_costs(contracts(spark, d), triples)
    return out.select(
        *KEY, F.round("sales_marginal", 6).alias("sales_marginal"), F.round("servicing_marginal", 6).alias("servicing_marginal"),
        F.round("credit_marginal", 10).alias("credit_marginal"),
    )
