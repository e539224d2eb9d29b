"""Projections, filters and predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions import bands
from ledgerloom.functions.scalars import join_non_null
from ledgerloom.plans.registry import day, query, rounded, table, total

LINES = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("project_rename", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def project_rename(spark, d):
    renamed = table(spark, d, "orders").withColumnsRenamed(
        {"o_orderkey": "Order_ID", "o_custkey": "Customer_ID", "o_totalprice": "Amount"}
    )
    lower = renamed.toDF(*[c.lower() for c in renamed.columns])
    return lower.select("order_id", "customer_id", "amount")


@query(
    "project_expr",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net_price,
           round(l_extendedprice * l_tax, 4) AS tax_amount, round(l_extendedprice / l_quantity, 8) AS unit_price,
           1 AS weight FROM lineitem
    """,
)
def project_expr(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        *LINES,
        "round(l_extendedprice * (1 - l_discount), 4) AS net_price",
        "round(l_extendedprice * l_tax, 4) AS tax_amount",
        "round(try_divide(l_extendedprice, l_quantity), 8) AS unit_price",
        "1 AS weight",
    )


@query(
    "audit_columns",
    "SELECT o_orderkey, CAST(77 AS BIGINT) AS txn_id, '2024-02-01' AS start_at, '2024-02-01' AS end_at FROM orders",
)
def audit_columns(spark, d):
    run_date = F.lit(date(2024, 2, 1))
    return table(spark, d, "orders").select(
        "o_orderkey", F.lit(77).cast("bigint").alias("txn_id"), day(run_date).alias("start_at"), day(run_date).alias("end_at")
    )


@query(
    "band_case",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_quantity <= 24 THEN 24 WHEN l_quantity <= 36 THEN 36 WHEN l_quantity <= 39 THEN 39
           WHEN l_quantity <= 42 THEN 42 WHEN l_quantity <= 48 THEN 48 ELSE 60 END AS term_band,
      CASE WHEN l_partkey > 729 THEN 'tier1' WHEN l_partkey > 699 THEN 'tier2' WHEN l_partkey > 679 THEN 'tier3'
           WHEN l_partkey > 659 THEN 'tier4' ELSE 'tier5' END AS grade,
      CASE WHEN l_quantity <= 24 THEN 0.03 WHEN l_quantity <= 48 THEN 0.013 ELSE 0.015 END::DOUBLE AS speed
    FROM lineitem
    """,
)
def band_case(spark, d):
    return table(spark, d, "lineitem").select(
        *LINES,
        bands.band(F.col("l_quantity"), bands.TERM_BANDS, bands.TERM_DEFAULT).alias("term_band"),
        bands.band(F.col("l_partkey"), bands.SCORE_GRADES, bands.SCORE_DEFAULT).alias("grade"),
        bands.band(F.col("l_quantity"), bands.PREPAY_SPEEDS, bands.PREPAY_DEFAULT).alias("speed"),
    )


@query(
    "band_by_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN 0.4 WHEN o_orderdate >= DATE '1998-07-01' THEN 0.35
           ELSE 0.3 END::DOUBLE AS rate FROM orders
    """,
)
def band_by_date(spark, d):
    rules = [(">=", "2000-01-01", 0.4), (">=", "1998-07-01", 0.35)]
    return table(spark, d, "orders").select(
        "o_orderkey", bands.band_by_date(F.to_date("o_orderdate"), rules, 0.3).alias("rate")
    )


@query(
    "code_map",
    """
    SELECT c_custkey, CASE lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0')
      WHEN '01' THEN 'al' WHEN '02' THEN 'ak' WHEN '03' THEN 'az' WHEN '04' THEN 'ar' WHEN '05' THEN 'ca'
      WHEN '06' THEN 'co' WHEN '07' THEN 'ct' WHEN '08' THEN 'de' WHEN '09' THEN 'dc' WHEN '10' THEN 'fl'
      WHEN '11' THEN 'ga' WHEN '12' THEN 'hi' WHEN '13' THEN 'id' WHEN '14' THEN 'il' WHEN '15' THEN 'in'
      WHEN '16' THEN 'ia' WHEN '17' THEN 'ks' WHEN '18' THEN 'ky' WHEN '19' THEN 'la' WHEN '20' THEN 'me'
      WHEN '21' THEN 'md' WHEN '22' THEN 'ma' WHEN '23' THEN 'mi' WHEN '24' THEN 'mn' WHEN '25' THEN 'ms'
      ELSE 'xx' END AS state,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'BU' WHEN 'MACHINERY' THEN 'MA' END AS segment_code FROM customer
    """,
)
def code_map(spark, d):
    code = F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")
    return table(spark, d, "customer").select(
        "c_custkey",
        bands.code_map(code, bands.STATE_CODES, bands.STATE_DEFAULT).alias("state"),
        bands.code_map(F.col("c_mktsegment"), {"BUILDING": "BU", "MACHINERY": "MA"}).alias("segment_code"),
    )


@query(
    "flip_flag",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN (CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END) = 1 THEN 0 ELSE 1 END AS flipped FROM lineitem
    """,
)
def flip_flag(spark, d):
    flag = F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", 0)
    return table(spark, d, "lineitem").select(*LINES, bands.flip_flag(flag).alias("flipped"))


@query(
    "prefix_rules",
    """
    SELECT p_partkey, CASE WHEN substr(p_brand, 1, 7) BETWEEN 'Brand#1' AND 'Brand#2' THEN 'group a'
           WHEN substr(p_brand, 1, 8) BETWEEN 'Brand#30' AND 'Brand#39' THEN 'group b' ELSE trim(p_name) END AS model
    FROM part
    """,
)
def prefix_rules(spark, d):
    rules = [(7, "Brand#1", "Brand#2", "group a"), (8, "Brand#30", "Brand#39", "group b")]
    return table(spark, d, "part").select(
        "p_partkey", bands.prefix_rules(F.col("p_brand"), rules, F.col("p_name")).alias("model")
    )


@query(
    "fallback_ratio",
    """
    SELECT o_orderkey, round(CASE WHEN collateral = 1 THEN 999.0 ELSE o_totalprice / collateral * 100 END, 4) AS ltv
    FROM (SELECT o_orderkey, o_totalprice, CASE WHEN c_acctbal > 0 THEN c_acctbal WHEN c_nationkey > 0
          THEN CAST(c_nationkey AS DOUBLE) ELSE 1.0 END AS collateral FROM orders JOIN customer ON o_custkey = c_custkey)
    """,
)
def fallback_ratio(spark, d):
    both = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    collateral = bands.first_positive([F.col("c_acctbal"), F.col("c_nationkey").cast("double")], 1.0)
    return both.select("o_orderkey", F.round(bands.loan_to_value(F.col("o_totalprice"), collateral), 4).alias("ltv"))


@query("filter_range", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_extendedprice <= 60000")
def filter_range(spark, d):
    return table(spark, d, "lineitem").filter("l_quantity > 45 AND l_extendedprice <= 60000").select(*LINES, "l_quantity")


@query(
    "filter_between",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-09-30'",
)
def filter_between(spark, d):
    return table(spark, d, "orders").filter(
        "o_orderdate BETWEEN TIMESTAMP_NTZ '1997-03-01' AND TIMESTAMP_NTZ '1997-09-30'"
    ).select("o_orderkey", "o_custkey")


@query("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in(spark, d):
    return table(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%'")
def filter_like(spark, d):
    return table(spark, d, "part").filter(F.lower("p_name").contains("ring")).select("p_partkey", "p_name")


@query("filter_or", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'HOUSEHOLD'")
def filter_or(spark, d):
    return table(spark, d, "customer").filter(
        (F.col("c_mktsegment") == "BUILDING") | (F.col("c_mktsegment") == "HOUSEHOLD")
    ).select("c_custkey")


def orders_of_status(orders, status: str | None):
    """Optional parameter: None leaves the filter out."""
    return orders if status is None else orders.filter(F.col("o_orderstatus") == F.lit(status))


@query(
    "filter_optional",
    """
    SELECT 'F' AS asked, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'any', count(*) FROM orders
    """,
)
def filter_optional(spark, d):
    orders = table(spark, d, "orders")
    one = orders_of_status(orders, "F").agg(F.lit("F").alias("asked"), total().alias("n_orders"))
    return one.union(orders_of_status(orders, None).agg(F.lit("any"), total()))


def events_between(events, start: str | None, end: str | None):
    """Events of a period, or one row saying that a bound is missing."""
    if start is None or end is None:
        return events.sparkSession.range(1).select(F.lit("Invalid Date").alias("message"))
    return events.filter(F.to_date("ts").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


@query(
    "date_param_branch",
    """
    SELECT event_type AS message, count(*) AS n_events FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type
    UNION ALL SELECT 'Invalid Date', 1
    """,
)
def date_param_branch(spark, d):
    events = table(spark, d, "events")
    good = events_between(events, "2024-01-05", "2024-01-20").groupBy(F.col("event_type").alias("message")).agg(
        total().alias("n_events")
    )
    return good.union(events_between(events, None, "2024-01-20").select("message", F.lit(1).cast("bigint")))


@query(
    "param_query",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000",
)
def param_query(spark, d):
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {o} WHERE o_orderpriority = :priority AND o_totalprice > :floor",
        args={"priority": "1-URGENT", "floor": 400000.0},
        o=table(spark, d, "orders"),
    )


@query(
    "null_default",
    """
    SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 0.0) AS balance,
           coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, 'n') AS segment FROM customer
    """,
)
def null_default(spark, d):
    holed = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return holed.fillna({"balance": 0.0, "segment": "n"})


@query(
    "nullable_concat",
    "SELECT s_suppkey, s_name || coalesce(', ' || CASE WHEN s_nationkey > 5 THEN CAST(s_nationkey AS VARCHAR) END, '') AS address FROM supplier",
)
def nullable_concat(spark, d):
    second = F.when(F.col("s_nationkey") > 5, F.col("s_nationkey").cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", join_non_null(F.col("s_name"), second).alias("address"))


@query(
    "cte_chain",
    """
    WITH per_cust AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spent FROM orders GROUP BY o_custkey),
    active AS (SELECT * FROM per_cust WHERE n >= 3)
    SELECT n, count(*) AS n_customers, round(sum(spent), 2) AS spent FROM active GROUP BY n
    """,
)
def cte_chain(spark, d):
    per_cust = table(spark, d, "orders").groupBy("o_custkey").agg(total().alias("n"), F.sum("o_totalprice").alias("spent"))
    active = per_cust.filter("n >= 3")
    return active.groupBy("n").agg(total().alias("n_customers"), rounded(F.sum("spent")).alias("spent"))


@query(
    "scalar_subquery",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey = (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
       OR l_extendedprice = (SELECT max(l_extendedprice) FROM lineitem)
    """,
)
def scalar_subquery(spark, d):
    lines = table(spark, d, "lineitem")
    richest = table(spark, d, "orders").agg(
        F.max_by("o_orderkey", F.struct(F.col("o_totalprice"), -F.col("o_orderkey")))
    )
    top = lines.agg(F.max("l_extendedprice"))
    return lines.filter(
        (F.col("l_orderkey") == richest.scalar()) | (F.col("l_extendedprice") == top.scalar())
    ).select(*LINES)
