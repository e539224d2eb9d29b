"""Ranks, leads, group counts, sorts and top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import group_share, top_n
from ledgerloom.operators.ordered import ordered_dense_rank, ordered_lead, ordered_row_number, surrogate_key
from ledgerloom.plans.registry import day, query, table, total


@query(
    "win_dense_rank",
    "SELECT o_orderkey, o_custkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rk FROM orders",
)
def win_dense_rank(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered_dense_rank(orders, ["o_custkey"], "o_orderdate", "rk").drop("o_orderdate")


@query(
    "win_row_number",
    """
    SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn
      FROM orders) WHERE rn <= 25
    """,
)
def win_row_number(spark, d):
    best = top_n(
        table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 25, F.col("o_totalprice").desc(), F.col("o_orderkey")
    )
    # 25 rows are left: numbering them needs no distributed window.
    packed = best.agg(F.sort_array(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey", "o_totalprice"))).alias("l"))
    return packed.select(F.posexplode("l").alias("i", "r")).select(
        "r.o_orderkey", "r.o_totalprice", (F.col("i") + 1).cast("bigint").alias("rn")
    )


@query(
    "row_number_per_key",
    """
    SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS visit_no
    FROM orders
    """,
)
def row_number_per_key(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered_row_number(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "visit_no").drop("o_orderdate")


ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    "win_lead",
    f"""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_orderkey, l_linenumber, l_partkey,
           lead(l_quantity, 1, 0) OVER (ORDER BY {', '.join(ORDER)}) AS next_quantity FROM lineitem
    """,
)
def win_lead(spark, d):
    lines = table(spark, d, "lineitem").select(*ORDER)
    led = ordered_lead(lines, [], ORDER, "l_quantity", "next_quantity", F.lit(0.0))
    return led.select(day("l_shipdate").alias("ship_day"), "l_orderkey", "l_linenumber", "l_partkey", "next_quantity")


@query(
    "win_count_filter",
    """
    SELECT o_orderkey, o_custkey, n_orders FROM (
      SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders) WHERE n_orders > 2
    """,
)
def win_count_filter(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return group_share(orders, ["o_custkey"], {"n_orders": total()}).filter("n_orders > 2")


@query("sort_multi", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY 1, 3 DESC, 2")
def sort_multi(spark, d):
    return table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice").orderBy(
        "o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey"
    )


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(spark, d):
    return top_n(
        table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10, F.col("o_totalprice").desc(), F.col("o_orderkey")
    )


@query(
    "surrogate_key",
    "SELECT c_name, 999 + row_number() OVER (ORDER BY c_name) AS customer_id FROM customer",
)
def customer_ids(spark, d):
    return surrogate_key(table(spark, d, "customer").select("c_name"), ["c_name"], "customer_id", seed=1000)
