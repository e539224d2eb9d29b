"""The two contract jobs on line items read as contracts; lookup tables come from the same data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions import bands
from ledgerloom.jobs import enrichment, profitability
from ledgerloom.operators.changes import merge_upsert
from ledgerloom.plans.registry import mean, query, rounded, table, total
from ledgerloom.session import tidy_shuffles, written_table

AS_OF = date(1998, 6, 20)

BASE = """
    WITH base AS (SELECT l_orderkey * 10 + l_linenumber AS account_no, l_partkey AS part_id,
      CAST(o_orderdate AS DATE) AS booking_date, CAST(l_shipdate AS DATE) AS lease_date,
      CAST(l_quantity AS INTEGER) AS term_months, l_extendedprice AS capital_cost, l_extendedprice * 0.45 AS residual,
      CASE WHEN l_returnflag = 'R' THEN 500.0 ELSE 0.0 END AS subsidy, l_extendedprice * 1.1 AS adjusted_price,
      0.001 + l_tax / 100 AS money_factor, l_quantity * 10 + 1 AS buy_rate, l_discount / 100 AS markup_rate,
      l_discount AS markup_amount, l_tax AS tax, CASE WHEN c_nationkey < 10 THEN 'N' || c_nationkey END AS make_code,
      'NATION_' || c_nationkey AS make, l_linestatus || l_returnflag AS vehicle_code, o_orderpriority AS model,
      1994 + l_linenumber AS model_year, lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS state_code,
      600 + l_partkey % 200 AS score, l_suppkey % 100 AS credit_score,
      CASE WHEN l_linenumber % 2 = 1 THEN 'd' ELSE 'n' END AS new_used, o_orderkey AS application_id,
      c_nationkey % 5 AS manufacturer_key, c_nationkey, l_linenumber, l_suppkey,
      CASE WHEN l_quantity <= 24 THEN 24 WHEN l_quantity <= 36 THEN 36 WHEN l_quantity <= 39 THEN 39
           WHEN l_quantity <= 42 THEN 42 WHEN l_quantity <= 48 THEN 48 ELSE 60 END AS term_band,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS subsidised,
      (year(o_orderdate) - 1994 - l_linenumber) * 12 + month(o_orderdate) - 3 + (day(o_orderdate) - 1) / 31.0 AS age,
      year(o_orderdate) * 100 + month(o_orderdate) AS booked_period, year(l_shipdate) * 100 + month(l_shipdate) AS lease_period
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    b AS (SELECT *, CASE WHEN score > 729 THEN 'tier1' WHEN score > 699 THEN 'tier2' WHEN score > 679 THEN 'tier3'
        WHEN score > 659 THEN 'tier4' ELSE 'tier5' END AS grade,
      CASE WHEN age < -24 THEN 'used5+' WHEN age <= 0 THEN 'new' WHEN age <= 12 THEN 'used0' WHEN age <= 24 THEN 'used1'
        WHEN age <= 36 THEN 'used2' WHEN age <= 48 THEN 'used3' WHEN age <= 60 THEN 'used4' ELSE 'used5+' END AS age_class FROM base)
"""


def base_contracts(spark, d):
    nation = F.col("c_nationkey")
    ordered = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = table(spark, d, "lineitem").join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("account_no"),
        F.col("l_partkey").alias("part_id"),
        F.to_date("o_orderdate").alias("booking_date"),
        F.to_date("l_shipdate").alias("lease_date"),
        F.col("l_quantity").cast("int").alias("term_months"),
        F.col("l_extendedprice").alias("capital_cost"),
        (F.col("l_extendedprice") * 0.45).alias("residual"),
        F.when(F.col("l_returnflag") == "R", 500.0).otherwise(0.0).alias("subsidy"),
        (F.col("l_extendedprice") * 1.1).alias("adjusted_price"),
        (0.001 + F.col("l_tax") / 100).alias("money_factor"),
        (F.col("l_quantity") * 10 + 1).alias("buy_rate"),
        (F.col("l_discount") / 100).alias("markup_rate"),
        F.col("l_discount").alias("markup_amount"),
        F.col("l_tax").alias("tax"),
        F.when(nation < 10, F.concat(F.lit("N"), nation.cast("string"))).alias("make_code"),
        F.concat(F.lit("NATION_"), nation.cast("string")).alias("make"),
        F.concat("l_linestatus", "l_returnflag").alias("vehicle_code"),
        F.col("o_orderpriority").alias("model"),
        (F.col("l_linenumber") + 1994).alias("model_year"),
        F.lpad((nation + 1).cast("string"), 2, "0").alias("state_code"),
        (F.lit(600) + F.col("l_partkey") % 200).alias("score"),
        (F.col("l_suppkey") % 100).alias("credit_score"),
        F.when(F.col("l_linenumber") % 2 == 1, "d").otherwise("n").alias("new_used"),
        F.col("o_orderkey").alias("application_id"),
        (nation % 5).alias("manufacturer_key"),
        nation,
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("subsidised"),
        bands.band(F.col("l_quantity"), bands.TERM_BANDS, bands.TERM_DEFAULT).alias("term_band"),
    )


@query(
    "contract_enrichment",
    BASE + """,
    terms AS (SELECT l_orderkey * 10 + l_linenumber AS k, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS per,
      max(l_tax) AS base_pct, max(l_quantity) AS base_amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_returnflag = 'A' GROUP BY 1, 2),
    apps AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 10 END AS invoice,
      CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 15 ELSE 0 END AS alt FROM orders WHERE o_orderpriority <> '5-LOW'),
    loyal AS (SELECT o_orderkey AS k, 'y' AS flag FROM orders WHERE o_totalprice > 300000),
    models AS (SELECT DISTINCT n_nationkey AS make_id, o_orderpriority AS wrong, lower(o_orderpriority) AS correct
      FROM orders JOIN nation ON n_nationkey % 2 = 0),
    rates AS (SELECT term_band AS t, grade AS g, round(sum(tax), 2) / count(tax) AS r FROM b GROUP BY 1, 2),
    coll AS (SELECT c_nationkey % 5 AS m, round(sum(c_acctbal), 2) / count(c_acctbal) AS r FROM customer GROUP BY 1),
    m AS (SELECT b.*, CASE WHEN vehicle_code = 'OR' THEN 'OPEN RETURN' ELSE model END AS clean FROM b
      WHERE booking_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-20'),
    e AS (SELECT m.*, base_pct, base_amount, coalesce(flag, 'n') AS loyalty, correct,
      rates.r + CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS delinquency_rate, coll.r AS collateral_rate,
      CASE WHEN invoice > 0 THEN invoice ELSE adjusted_price END AS price, alt,
      (capital_cost - residual) / term_months + (capital_cost + residual) * money_factor AS pmt
      FROM m LEFT JOIN terms ON terms.k = account_no AND CAST(per AS INTEGER) = booked_period
      LEFT JOIN apps ON apps.k = application_id LEFT JOIN loyal ON loyal.k = application_id
      LEFT JOIN models ON models.make_id = c_nationkey AND wrong = clean
      LEFT JOIN rates ON t = term_band AND g = grade LEFT JOIN coll ON coll.m = manufacturer_key),
    s AS (SELECT *, list_reduce(list_concat([0.01::DOUBLE], [i::DOUBLE for i in range(25)]), lambda r, i:
      r - (-capital_cost * pow(1 + r, term_months) + pmt * (pow(1 + r, term_months) - 1) * (1 + r) / r + residual)
        / (-capital_cost * term_months * pow(1 + r, term_months) / (1 + r)
           + pmt * (term_months * pow(1 + r, term_months) / r - (pow(1 + r, term_months) - 1) / (r * r)))) AS rate FROM e)
    SELECT account_no, part_id, term_band, grade, age_class, clean AS model, correct AS canonical_model, c_nationkey AS make_id,
      CASE WHEN new_used = 'd' THEN 'u' ELSE new_used END AS new_used, loyalty, base_pct AS residual_base_pct, delinquency_rate,
      collateral_rate, round(capital_cost / price * 100, 4) AS booked_ltv, round(pmt, 9) AS pmt_customer,
      round(12 * rate, 5) AS rate_customer, 199806 AS run_period FROM s
    """,
)
def contract_enrichment(spark, d):
    base = base_contracts(spark, d).withColumns(
        {"period": (F.year("booking_date") * 100 + F.month("booking_date")).cast("string"), "manufacturer_id": F.col("manufacturer_key")}
    )
    orders, nation = table(spark, d, "orders"), table(spark, d, "nation")
    booked = F.date_format("o_orderdate", "yyyyMM")
    terms = (
        table(spark, d, "lineitem").filter("l_returnflag = 'A'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("account_no"), booked.alias("period"))
        .agg(F.max("l_tax").alias("base_pct"), F.max("l_quantity").alias("base_amount"), F.min("l_discount").alias("subsidy_amount"))
    )
    price = F.col("o_totalprice")
    applications = orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("application_id"),
        F.when(F.col("o_orderstatus") == "O", price / 10).alias("invoice_amount"),
        (price / 20).alias("wholesale_amount"),
        F.when(F.col("o_orderstatus") == "F", price / 15).otherwise(0.0).alias("alternate_invoice"),
        (price / 1000000).alias("loan_to_income"),
    )
    loyalty = orders.filter("o_totalprice > 300000").select(F.col("o_orderkey").alias("application_id"), F.lit("y").alias("flag"))
    aliases = nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("misspelled"), F.col("n_nationkey").alias("make_id")).union(
        nation.select("n_name", "n_nationkey")
    )
    # Every priority spelling is known for the even makes.
    makes = nation.filter("n_nationkey % 2 = 0").agg(F.collect_set("n_nationkey").alias("makes"))
    spellings = orders.select("o_orderpriority").distinct().withColumn("make_id", F.explode(makes.scalar()))
    models = spellings.select("make_id", F.col("o_orderpriority").alias("misspelled"), F.lower("o_orderpriority").alias("correct"))
    rates = enrichment.with_bands(base).groupBy("term_band", "grade").agg(mean("tax").alias("r"))
    delinquency = rates.select(
        F.explode(F.create_map(F.lit("othermake"), F.col("r"), F.lit("three"), F.col("r") + 1)).alias("make_group", "rate"),
        F.col("term_band").alias("term"), "grade",
    )
    collateral = table(spark, d, "customer").groupBy((F.col("c_nationkey") % 5).alias("manufacturer_id")).agg(
        mean("c_acctbal").alias("rate")
    )
    tables = enrichment.EnrichmentTables(base, terms, applications, loyalty, aliases, models, delinquency, collateral)
    rules = enrichment.EnrichmentRules(make_groups={3: "three"}, model_rules=[(2, "OR", "OR", "OPEN RETURN")])
    out = enrichment.enrich(tables, rules, AS_OF, txn_id=1)
    keep = ["account_no", "part_id", "term_band", "grade", "age_class", "model", "canonical_model", "make_id", "new_used", "loyalty",
            "residual_base_pct", "delinquency_rate", "collateral_rate", "run_period"]
    return out.select(
        *keep, F.round("booked_ltv", 4).alias("booked_ltv"), F.round("pmt_customer", 9).alias("pmt_customer"),
        F.round("rate_customer", 5).alias("rate_customer"),
    )


def _dates(df, beg: str, end: str):
    return df.withColumns({"beg": F.lit(beg).cast("date"), "end": F.lit(end).cast("date")})


def _two_periods(dim, early, late):
    """The same dimension under two periods, with a column that differs."""
    first = _dates(dim.select("*", *early), "1990-01-01", "1997-12-31")
    return first.union(_dates(dim.select("*", *late), "1998-01-01", "9999-12-31"))


def _packed(mean, step: float):
    """Eighty-four points rising from a mean, packed with bars."""
    points = F.transform(F.sequence(F.lit(0), F.lit(83)), lambda i: F.format_number(F.round(mean, 4) + i * step, 6))
    return F.concat_ws("|", points)


def profit_tables(spark, d) -> profitability.ProfitTables:
    base = base_contracts(spark, d)
    orders, customer, nation = (table(spark, d, n) for n in ("orders", "customer", "nation"))
    lines = table(spark, d, "lineitem")
    key = F.col("c_nationkey")
    # The job reads contracts from storage several times; here they have to be made first.
    contracts = base.withColumns(
        {
            "dealer_location": key.cast("string"),
            "make_id": key,
            "loyalty": F.when(F.col("capital_cost") > 50000, "y").otherwise("n"),
            "residual_subsidy": F.col("subsidy") + 1,
            "dealer_upfront": F.col("tax") * 1000,
            "booked_ltv": F.col("money_factor") * 10000,
            "rate_programme": F.col("markup_rate"),
        }
    )
    # The lookup tables made of contracts are made of the written ones.
    with tidy_shuffles(spark):
        contracts = written_table(contracts, "contracts", codec="zstd")
    account = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("account_no")
    stage = lines.groupBy(account).agg(
        F.max("l_linestatus").alias("new_used_flag"),
        F.concat(F.lit("tier"), (F.max("l_suppkey") % 3).cast("string")).alias("grade"),
    )
    year = F.year("o_orderdate")
    per_year = orders.groupBy(year.alias("y")).agg(F.avg("o_totalprice").alias("mean"))
    span = {"beg": F.make_date("y", F.lit(1), F.lit(1)), "end": F.make_date("y", F.lit(12), F.lit(31))}
    drivers = per_year.select(
        F.lit("lease").alias("line"),
        F.explode(F.create_map(F.lit("debt"), F.round(F.col("mean") / 1000, 4), F.lit("capital_charge"), F.round(F.col("mean") / 2000, 4))).alias("dim_key", "measure"),
        "y",
    ).withColumns(span)
    metrics = orders.groupBy(F.to_date("o_orderdate").alias("as_of")).agg(
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")
    ).select("as_of", F.explode(F.create_map(F.lit("1m"), F.col("lo"), F.lit("24m"), F.col("hi"))).alias("label", "value"))
    regions = nation.select(F.col("n_nationkey").cast("string").alias("dealer_location"), "n_regionkey")
    late = F.col("n_regionkey") + 10
    named = lambda c: [c.alias("manufacturer_id"), F.concat(F.lit("M"), c.cast("string")).alias("manufacturer")]
    dealers = _two_periods(regions, named(F.col("n_regionkey")), named(late))
    makers = nation.select("n_regionkey").distinct().select(
        F.explode(F.array(F.col("n_regionkey"), late)).alias("manufacturer_id")
    )
    with_cust = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    capital = with_cust.groupBy(F.col("o_orderpriority").alias("model"), key.alias("make_id"), year.alias("y")).agg(
        mean("o_totalprice").alias("capital")
    ).withColumns({**span, "capital_market": F.col("capital"), "capital_standard": F.col("capital")})
    by_maker = contracts.groupBy("c_nationkey", "term_band", "model").agg(F.sum("markup_amount").alias("s"), total().alias("n"))
    owned = by_maker.join(nation, key == F.col("n_nationkey")).groupBy("n_regionkey", "term_band", "model").agg(
        rounded(F.sum("s") / F.sum("n"), 6).alias("return_rate")
    )
    returns = _dates(
        owned.select(
            F.explode(F.array(F.col("n_regionkey"), late)).alias("manufacturer_id"), F.col("term_band").alias("term"), "model", "return_rate"
        ).select("manufacturer_id", "term", "model", "return_rate", F.explode(F.array(F.lit("tier0"), F.lit("tier1"))).alias("grade")),
        "1990-01-01", "2100-12-31",
    )
    curve_types = _dates(
        makers.select(
            "manufacturer_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("subsidised"),
            F.concat(F.lit("T"), (F.col("manufacturer_id") % 3).cast("string")).alias("curve_type"),
        ),
        "1990-01-01", "2100-12-31",
    )
    kinds = F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("t")
    daily = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("mean")).select("day", "mean", kinds)
    type_name = F.concat(F.lit("T"), F.col("t").cast("string"))
    dated = daily.select(
        F.concat_ws("|", F.date_format("day", "yyyy-MM-dd"), type_name).alias("name"),
        _packed(F.col("mean") / 5000000 + F.col("t") / 1000, 0.0005).alias("curve"),
    )
    plain = orders.agg(F.avg("o_totalprice").alias("mean")).select("mean", kinds).select(
        type_name.alias("name"), _packed(F.col("mean") / 9000000 + F.col("t") / 1000, 0.0002).alias("curve")
    )
    liquidity = per_year.select(
        F.concat(F.lit("L"), F.col("y").cast("string")).alias("name"), _packed(F.col("mean") / 8000000, 0.0001).alias("curve"), "y"
    ).withColumns(span)
    ages = F.explode(F.array(F.lit("new"), F.lit("used0"), F.lit("used1"))).alias("age_class")
    fees = _dates(
        makers.select("manufacturer_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("subsidised")).select("*", ages).select(
            "*", (F.col("manufacturer_id") + 100).alias("origination_fee"), F.lit(0.5).alias("revenue_share"), F.lit(1.5).alias("subvention_fund")
        ),
        "1996-01-01", "2100-12-31",
    )
    credit = _dates(
        makers.select(
            F.concat(F.lit("M"), F.col("manufacturer_id").cast("string")).alias("business_line"),
            F.concat(F.lit("T"), (F.col("manufacturer_id") % 3).cast("string")).alias("curve_type"),
            (F.col("manufacturer_id") / 100).alias("credit_adjustment"),
        ),
        "1995-01-01", "1999-12-31",
    )
    def instead(lookup, variable, low, high, value, beg=199501, end=199812):
        text = lambda v, name: (v if not isinstance(v, (int, str)) else F.lit(v)).cast("string").alias(name)
        names = [F.lit(lookup).alias("lookup"), F.lit(variable).alias("lookup_var")]
        return F.struct(
            *names, text(low, "min_val"), text(high, "max_val"), text(value, "override"), F.lit(beg).alias("beg"), F.lit(end).alias("end")
        )

    lo, hi = F.col("lo"), F.col("hi")
    overrides = nation.agg(F.min("n_nationkey").alias("lo"), F.max("n_nationkey").alias("hi")).select(
        F.inline(
            F.array(
                instead("dealer", "manufacturer", -1, -1, 7), instead("dealer", "channel", -1, -1, 3, 199001, 210012),
                instead("loyalty", "manufacturer", 0, 99, 5, 199001, 210012), instead("loyalty", "make", lo, lo + 4, 99),
                instead("loyalty", "subsidised", 1, 1, 2), instead("loyalty", "age", "used1", "used5", "older", 199001, 210012),
                instead("portfolio", "manufacturer", 10, 99, 10), instead("portfolio", "income_ratio", 0, 0, 4, 199001, 199712),
                instead("portfolio", "make", hi - 4, hi, 88),
            )
        )
    ).select("*", F.lit("lease").alias("line"))
    periods = {"beg": F.lit(199001), "end": F.lit(210012)}
    dealer_adj = nation.select(
        F.col("n_nationkey").alias("make_id"), F.lit(7).alias("manufacturer_id"), (1 + F.col("n_nationkey") / 100).alias("adjustor")
    ).withColumns({**periods, "channel_id": F.lit(3), "dealer_group": F.lit("all"), "dealer_type": F.lit("franchise")})
    makes = nation.select(F.col("n_nationkey").alias("make_id")).union(nation.select(F.lit(99)).distinct()).union(nation.select(F.lit(88)).distinct())
    credit_band = {"min_credit": F.lit(0), "max_credit": F.lit(50)}
    loyalty_adj = makes.select(
        "make_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("loyal")
    ).select("*", F.explode(F.array(F.lit("new"), F.lit("used"))).alias("new_used"))
    loyalty_adj = loyalty_adj.select("*", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("subsidised"))
    loyalty_adj = loyalty_adj.select("*", F.explode(F.array(*[F.lit(a) for a in ("new", "used0", "used5+", "older")])).alias("age")).withColumns(
        {**periods, **credit_band, "manufacturer_id": F.lit(5), "graded": F.lit("y"), "min_score": F.lit(650), "max_score": F.lit(720),
         "adjustor": 2 + F.col("make_id") / 100 + F.col("subsidised") * 10 + F.when(F.col("age") == "older", 5).otherwise(0)}
    )
    portfolio_adj = makes.select("make_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("subsidised"))
    portfolio_adj = portfolio_adj.select(
        "*", F.explode(F.array(*[F.lit(i) for i in range(20)])).alias("manufacturer_id")
    )
    ratio = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.lit(1).alias("hi")), F.struct(F.lit(2).alias("lo"), F.lit(9).alias("hi")))).alias("ratio")
    portfolio_adj = portfolio_adj.select("*", ratio).withColumns(
        {**periods, **credit_band, "min_score": F.lit(600), "max_score": F.lit(800), "min_term": F.lit(24), "max_term": F.lit(42),
         "min_ltv": F.lit(0.0), "max_ltv": F.lit(14.0), "min_income_ratio": F.col("ratio.lo"), "max_income_ratio": F.col("ratio.hi"),
         "certified": F.lit("x"), "graded": F.lit("y"),
         "adjustor": 3 + F.col("make_id") / 100 + F.col("manufacturer_id") * 10 + F.col("ratio.lo") * 1000}
    ).drop("ratio")
    names = profitability.ProfitRules().expense_columns
    expenses = _dates(
        makers.select("manufacturer_id", *[(F.col("manufacturer_id") * 2 + i).alias(c) for i, c in enumerate(names)]), "1990-01-01", "2100-12-31"
    )
    marginal = _dates(
        makers.select("manufacturer_id", *[((F.col("manufacturer_id") + i) / 100).alias(f"{c}_rate") for i, c in enumerate(names)]),
        "1990-01-01", "2100-12-31",
    )
    losses = contracts.groupBy(key.alias("make_id"), F.col("term_band").alias("term")).agg(
        rounded(F.max("tax"), 6).alias("net_loss")
    ).select("*", F.explode(F.array(F.lit("tier0"), F.lit("tier2"))).alias("grade"))
    relations = orders.select(F.col("o_orderkey").alias("application_id"), F.col("o_custkey").alias("deposits"))
    return profitability.ProfitTables(
        contracts, stage, drivers, metrics, dealers, capital, returns, curve_types, dated.union(plain), liquidity, fees, credit,
        overrides, dealer_adj, loyalty_adj, portfolio_adj, expenses, losses, relations, marginal,
    )


RULES = profitability.ProfitRules(region_codes={"1": "NE", "2": "SE", "3": "MW"}, relationship_columns=["deposits"])

PROFIT = BASE + """,
    x AS (SELECT b.*, n_regionkey + CASE WHEN booking_date >= DATE '1998-01-01' THEN 10 ELSE 0 END AS man, c_nationkey AS make_id,
      residual AS rv, capital_cost - residual AS dep, CASE WHEN term_months <= 24 THEN 0.03 WHEN term_months <= 48 THEN 0.013 ELSE 0.015 END::DOUBLE AS a,
      CASE WHEN booking_date >= DATE '2011-01-01' THEN 0.4035 WHEN booking_date >= DATE '2010-01-01' THEN 0.4275
        WHEN booking_date >= DATE '2009-12-01' THEN 0.4075 WHEN booking_date >= DATE '2006-01-01' THEN 0.395 ELSE 0.39 END::DOUBLE AS tax_rate
      FROM b JOIN nation ON c_nationkey = n_nationkey),
    stage AS (SELECT l_orderkey * 10 + l_linenumber AS k, max(l_linestatus) AS flag, 'tier' || (max(l_suppkey) % 3) AS g FROM lineitem GROUP BY 1),
    yr AS (SELECT year(o_orderdate) AS y, avg(o_totalprice) AS mean FROM orders GROUP BY 1),
    dy AS (SELECT CAST(o_orderdate AS DATE) AS dt, avg(o_totalprice) AS mean, max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY 1),
    allmean AS (SELECT avg(o_totalprice) AS mean FROM orders),
    cap AS (SELECT o_orderpriority AS m, c_nationkey AS nk, year(o_orderdate) AS y, round(sum(o_totalprice), 2) / count(o_totalprice) AS capital
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
    ret AS (SELECT n_regionkey AS r, term_band AS t, model AS rm, round(sum(markup_amount) / count(*), 6) AS rate
      FROM b JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3),
    loss AS (SELECT c_nationkey AS nk, term_band AS t, round(max(tax), 6) AS net FROM b GROUP BY 1, 2),
    w AS (SELECT x.*, g, flag, row_number() OVER () AS id, man % 3 AS ty, yl.mean AS ymean, yb.mean AS bymean, dl.mean AS lmean, db.mean AS bmean,
      db.hi AS hi, capital, ret.rate AS return_rate, net, allmean.mean AS amean
      FROM x CROSS JOIN allmean LEFT JOIN stage ON k = account_no LEFT JOIN yr yl ON yl.y = year(lease_date) LEFT JOIN yr yb ON yb.y = year(booking_date)
      LEFT JOIN dy dl ON dl.dt = lease_date LEFT JOIN dy db ON db.dt = booking_date
      LEFT JOIN cap ON m = model AND nk = make_id AND cap.y = year(booking_date)
      LEFT JOIN ret ON r = man % 10 AND rm = model AND ret.t = x.term_band AND g IN ('tier0', 'tier1')
      LEFT JOIN loss ON loss.nk = make_id AND loss.t = x.term_band AND g IN ('tier0', 'tier2')),
    per AS (SELECT id, p, (dep - dep / term_band * (p - 1)) * (1 - a * (p - 1)) - (dep - dep / term_band * p) * (1 - a * p) + rv * a AS paid,
      (1 - a * p) * (capital_cost - dep / term_band * p) AS bal,
      round(round(lmean / 5000000 + ty / 1000, 4) + (p - 1) * 0.0005, 6) AS cl, round(round(bmean / 5000000 + ty / 1000, 4) + (p - 1) * 0.0005, 6) AS cb,
      round(round(amean / 9000000 + ty / 1000, 4) + (p - 1) * 0.0002, 6) AS cf,
      round(round(ymean / 8000000, 4) + (p - 1) * 0.0001, 6) AS ll, round(round(bymean / 8000000, 4) + (p - 1) * 0.0001, 6) AS lb
      FROM w, range(1, 60) AS r(p) WHERE p < term_band),
    sums AS (SELECT id, 1 + sum(paid * p) AS i, sum(paid * p * cl) AS cof, sum(paid * p * cb) AS bcof, sum(paid * p * cf) AS cf, sum(paid * p * ll) AS lp,
      sum(bal) AS bal FROM per GROUP BY 1),
    rates AS (SELECT w.*, CASE WHEN lmean IS NULL OR ymean IS NULL THEN 0 ELSE sums.cof / i END AS cof, CASE WHEN lmean IS NULL OR ymean IS NULL THEN 0 ELSE sums.lp / i END AS lp,
      sums.bcof / i AS bcof, sums.bal / 12 AS anr FROM w JOIN sums ON sums.id = w.id),
    wc AS (SELECT *, cof * (1 - tax_rate) * (1 - markup_amount) + markup_amount * 0.1 AS wacc FROM rates),
    disc AS (SELECT wc.id, sum(bal / pow(1 + wacc / 12, p)) / 12 AS anr_disc FROM wc JOIN per ON per.id = wc.id GROUP BY 1),
    f AS (SELECT wc.*, anr_disc, CASE WHEN booked_period <= 199812 AND make_id <= 4 THEN 99 ELSE make_id END AS lmake,
      CASE WHEN booked_period <= 199812 AND make_id >= 20 THEN 88 ELSE make_id END AS pmake FROM wc JOIN disc ON disc.id = wc.id)
"""


@query(
    "contract_profit",
    PROFIT + """
    SELECT account_no, part_id, man AS manufacturer_id, 'M' || man AS business_line, flag AS new_used_flag,
      CASE make_id WHEN 1 THEN 'NE' WHEN 2 THEN 'SE' WHEN 3 THEN 'MW' END AS region,
      round(ymean / 1000, 4) AS senior_debt, round(hi, 2) AS index_24m, capital, return_rate, round(cof, 6) AS cof, round(lp, 6) AS lp,
      round(bcof, 6) AS booked_cof, round(wacc, 6) AS wacc, round(anr, 2) AS anr, round(anr_disc, 2) AS anr_disc,
      CASE WHEN booking_date >= DATE '1996-01-01' AND age_class IN ('new', 'used0', 'used1') THEN man + 100 END AS origination_fee,
      CASE WHEN booking_date <= DATE '1999-12-31' THEN round(man / 100, 4) END AS credit_adjustment,
      round(subsidy * anr / anr_disc, 3) AS subsidy_revenue,
      CASE WHEN booked_period <= 199812 THEN round(1 + make_id / 100, 4) END AS dealer_adjustor,
      CASE WHEN score BETWEEN 650 AND 720 AND credit_score <= 50 THEN round(2 + lmake / 100
        + CASE WHEN subsidised = 1 AND booked_period <= 199812 THEN 20 WHEN subsidised = 1 THEN 10 ELSE 0 END
        + CASE WHEN age_class BETWEEN 'used1' AND 'used5' THEN 5 ELSE 0 END, 4) END AS loyalty_adjustor,
      CASE WHEN score <= 800 AND term_band <= 42 AND money_factor * 10000 <= 14.0 AND credit_score <= 50 THEN round(3 + pmake / 100
        + CASE WHEN man >= 10 AND booked_period <= 199812 THEN 10 ELSE man END * 10
        + CASE WHEN booked_period <= 199712 THEN 2000 ELSE 0 END, 4) END AS portfolio_adjustor,
      round((man * 2 + 3) * (man + 3) / 100, 4) AS servicing_marginal, net AS net_loss, round(net * anr, 2) AS loss_reserve_weight,
      CASE WHEN subsidised = 1 THEN round((buy_rate - 0.0435) * anr, 1) ELSE 0 END AS subsidy_buydown FROM f
    """,
)
def contract_profit(spark, d):
    out = profitability.profitability(profit_tables(spark, d), RULES)
    shown = {
        "senior_debt": 4, "index_24m": 2, "cof": 6, "lp": 6, "booked_cof": 6, "wacc": 6, "anr": 2, "anr_disc": 2,
        "credit_adjustment": 4, "subsidy_revenue": 3, "dealer_adjustor": 4, "loyalty_adjustor": 4, "portfolio_adjustor": 4,
        "servicing_marginal": 4, "loss_reserve_weight": 2, "subsidy_buydown": 1,
    }
    return out.select(
        "account_no", "part_id", "manufacturer_id", "business_line", "new_used_flag", "region", "capital", "return_rate",
        "origination_fee", "net_loss", *[F.round(c, n).alias(c) for c, n in shown.items()],
    )


@query(
    "contract_period_merge",
    PROFIT + """,
    fresh AS (SELECT booked_period AS period, 'M' || man AS business_line, count(*) AS n_contracts, round(sum(anr), 1) AS anr FROM f GROUP BY 1, 2),
    old AS (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS period, 'M' || n_regionkey AS business_line, count(*) AS n_contracts, -1.0::DOUBLE AS anr
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate < TIMESTAMP '1996-07-01' GROUP BY 1, 2)
    SELECT coalesce(o.period, n.period) AS period, coalesce(o.business_line, n.business_line) AS business_line,
      CASE WHEN n.period IS NULL THEN o.n_contracts ELSE n.n_contracts END AS n_contracts, CASE WHEN n.period IS NULL THEN o.anr ELSE n.anr END AS anr
    FROM old o FULL JOIN fresh n ON o.period = n.period AND o.business_line = n.business_line
    """,
)
def contract_period_merge(spark, d):
    """The job's last step: merge totals per period and line into a running table."""
    fresh = profitability.period_totals(profitability.balances(profit_tables(spark, d)))
    fresh = fresh.withColumn("anr", F.round("anr", 1))
    placed = (
        table(spark, d, "orders").filter("o_orderdate < TIMESTAMP_NTZ '1996-07-01'")
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    old = placed.groupBy(
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("period"),
        F.concat(F.lit("M"), F.col("n_regionkey").cast("string")).alias("business_line"),
    ).agg(total().alias("n_contracts"), F.lit(-1.0).alias("anr"))
    return merge_upsert(old, fresh, ["period", "business_line"])
