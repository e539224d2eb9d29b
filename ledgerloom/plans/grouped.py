"""Grouping with HAVING, lists, pivots, de-duplication, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, fraud
from ledgerloom.plans.registry import query, rounded, table, total


@query(
    "having_sum",
    """
    SELECT o_custkey, o_orderstatus, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_orderdate > TIMESTAMP '1996-01-01' GROUP BY 1, 2 HAVING sum(o_totalprice) > 1000000
    """,
)
def having_sum(spark, d):
    return (
        table(spark, d, "orders").filter("o_orderdate > TIMESTAMP_NTZ '1996-01-01'").groupBy("o_custkey", "o_orderstatus")
        .agg(F.sum("o_totalprice").alias("s")).filter("s > 1000000")
        .select("o_custkey", "o_orderstatus", rounded("s").alias("total"))
    )


@query(
    "having_distinct",
    """
    SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem
    GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1
    """,
)
def having_distinct(spark, d):
    return (
        table(spark, d, "lineitem").groupBy("l_orderkey")
        .agg(total().alias("n_lines"), F.countDistinct("l_suppkey").alias("n_suppliers")).filter("n_suppliers > 1")
    )


@query(
    "group_by_json",
    "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n_events, round(sum(value), 2) AS value FROM events GROUP BY 1",
)
def group_by_json(spark, d):
    return table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(
        total().alias("n_events"), rounded(F.sum("value")).alias("value")
    )


@query(
    "string_agg",
    """
    SELECT c_nationkey, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS segments
    FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) GROUP BY 1
    """,
)
def string_agg(spark, d):
    return aggregates.distinct_list(table(spark, d, "customer"), ["c_nationkey"], "c_mktsegment", "segments", page=None)


@query(
    "pivot_ranked",
    """
    WITH firsts AS (SELECT o_custkey, o_orderpriority AS item, min(o_orderdate) AS d FROM orders GROUP BY 1, 2),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY d) AS rk FROM firsts)
    SELECT o_custkey, max(CASE WHEN rk = 1 THEN item END) AS first_item, max(CASE WHEN rk = 2 THEN item END) AS second_item
    FROM ranked GROUP BY 1
    """,
)
def pivot_ranked(spark, d):
    return aggregates.two_earliest(
        table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderdate", ("first_item", "second_item")
    )


DIGITS = """
    SELECT l_suppkey, CAST(substr(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), 1, 1) AS INTEGER) AS digit,
           count(*) AS freq FROM lineitem WHERE l_extendedprice >= 1 GROUP BY 1, 2
"""


@query(
    "pivot_digits",
    f"SELECT l_suppkey, " + ", ".join(f"CAST(coalesce(sum(freq) FILTER (WHERE digit = {k}), 0) AS BIGINT) AS digit{k}" for k in range(1, 10))
    + f" FROM ({DIGITS}) GROUP BY l_suppkey HAVING sum(freq) > 2",
)
def pivot_digits(spark, d):
    freqs = fraud.digit_frequencies(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice")
    return fraud.digits_wide(freqs, "l_suppkey")


@query(
    "unpivot_digits",
    f"""
    WITH f AS ({DIGITS}), s AS (SELECT l_suppkey, sum(freq) AS n FROM f GROUP BY 1 HAVING sum(freq) > 2)
    SELECT s.l_suppkey, 'digit' || CAST(k AS VARCHAR) AS digit_name, coalesce(freq, 0) AS freq
    FROM s CROSS JOIN range(1, 10) AS r(k) LEFT JOIN f ON f.l_suppkey = s.l_suppkey AND digit = k
    """,
)
def unpivot_digits(spark, d):
    freqs = fraud.digit_frequencies(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice")
    return fraud.digits_long(fraud.digits_wide(freqs, "l_suppkey"), "l_suppkey")


@query("distinct_rows", "SELECT DISTINCT o_orderpriority, o_orderstatus, o_custkey FROM orders")
def distinct_rows(spark, d):
    return table(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_custkey").distinct()


KEYED = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    "dedup_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1
    """,
)
def dedup_key(spark, d):
    lines = table(spark, d, "lineitem").select(*KEYED)
    return aggregates.dedupe(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]).drop("l_shipdate")


@query(
    "dedup_rows",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem GROUP BY 1, 2, 3",
)
def dedup_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query(
    "second_highest",
    "SELECT max(o_totalprice) AS o_totalprice FROM orders WHERE o_totalprice < (SELECT max(o_totalprice) FROM orders)",
)
def second_highest(spark, d):
    return aggregates.nth_highest(table(spark, d, "orders"), "o_totalprice", 2)


@query(
    "report_summary",
    """
    SELECT count(*) AS n_total, count(*) FILTER (WHERE l_discount > 0.05) AS n_flagged,
           round(avg(1 - l_discount) FILTER (WHERE l_discount > 0.05), 6) AS avg_score FROM lineitem
    """,
)
def report_summary(spark, d):
    out = aggregates.flagged_summary(table(spark, d, "lineitem"), F.col("l_discount") > 0.05, 1 - F.col("l_discount"))
    return out.withColumn("avg_score", F.round("avg_score", 6))


@query(
    "set_except",
    """
    SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
    EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    """,
)
def set_except(spark, d):
    orders = table(spark, d, "orders")
    pick = lambda cond: orders.filter(cond).select("o_custkey", "o_orderpriority").distinct()
    return pick("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").subtract(pick("o_orderdate < TIMESTAMP_NTZ '1998-01-01'"))
