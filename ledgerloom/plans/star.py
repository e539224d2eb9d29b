"""Star-schema analytics: the flagship join and the plain aggregates on the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.plans.registry import mean, query, rounded, table, total


@query(
    "star_join",
    """
    SELECT n_name AS nation, c_name AS customer, CAST(year(o_orderdate) AS BIGINT) AS order_year,
           count(*) AS n_sales, round(sum(l_extendedprice), 2) AS total_sales,
           round(sum(l_extendedprice), 2) / count(l_extendedprice) AS avg_sales,
           count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_suppliers
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_nationkey = 3 AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
    GROUP BY n_name, c_custkey, c_name, year(o_orderdate)
    """,
)
def star_join(spark, d):
    nation = table(spark, d, "nation").filter("n_nationkey = 3")
    customer = table(spark, d, "customer").filter("c_nationkey = 3")
    orders = table(spark, d, "orders").filter(
        F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("2000-12-31").cast("timestamp_ntz"))
    )
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    # The dimensions go first, so only the wanted customers' orders meet the fact table.
    wanted = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        lines.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_name", "c_custkey", "c_name", F.year("o_orderdate").cast("bigint").alias("order_year"))
        .agg(
            total().alias("n_sales"),
            rounded(F.sum("l_extendedprice")).alias("total_sales"),
            mean("l_extendedprice").alias("avg_sales"),
            F.countDistinct("o_orderkey").alias("n_orders"),
            F.countDistinct("l_suppkey").alias("n_suppliers"),
        )
        .withColumnsRenamed({"n_name": "nation", "c_name": "customer"})
        .drop("c_custkey")
    )


@query("agg_count", "SELECT count(*) AS n_rows FROM lineitem")
def agg_count(spark, d):
    return table(spark, d, "lineitem").agg(total().alias("n_rows"))


@query(
    "agg_minmaxavg",
    "SELECT max(value) AS max_value, min(value) AS min_value, round(sum(value), 2) / count(value) AS avg_value FROM events",
)
def agg_minmaxavg(spark, d):
    return table(spark, d, "events").agg(
        F.max("value").alias("max_value"), F.min("value").alias("min_value"), mean("value").alias("avg_value")
    )


@query("agg_sum", "SELECT round(sum(l_extendedprice), 2) AS total_price FROM lineitem")
def agg_sum(spark, d):
    return table(spark, d, "lineitem").agg(rounded(F.sum("l_extendedprice")).alias("total_price"))


@query("group_count", "SELECT l_partkey, count(l_partkey) AS n_rows FROM lineitem GROUP BY l_partkey")
def group_count(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("l_partkey").alias("n_rows")).orderBy("l_partkey")


@query(
    "group_sum",
    "SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem GROUP BY l_partkey",
)
def group_sum(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(
        rounded(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue")
    )


@query(
    "group_avg",
    "SELECT o_custkey, round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_price FROM orders GROUP BY o_custkey",
)
def group_avg(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(mean("o_totalprice").alias("avg_price"))


@query(
    "multi_distinct",
    """
    SELECT l_partkey, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem WHERE l_linenumber >= 2 GROUP BY l_partkey
    """,
)
def multi_distinct(spark, d):
    return (
        table(spark, d, "lineitem").filter("l_linenumber >= 2").groupBy("l_partkey")
        .agg(F.countDistinct("l_suppkey").alias("n_suppliers"), F.countDistinct("l_orderkey").alias("n_orders"))
        .orderBy("l_partkey")
    )


@query("distinct_count", "SELECT count(DISTINCT user_id) AS n_users FROM events")
def distinct_count(spark, d):
    return table(spark, d, "events").agg(F.countDistinct("user_id").alias("n_users"))


@query(
    "weighted_sum",
    """
    SELECT l_suppkey, round(sum(n * avg_price), 2) AS total_price FROM (
      SELECT l_suppkey, l_returnflag, count(*) AS n, avg(l_extendedprice) AS avg_price
      FROM lineitem GROUP BY l_suppkey, l_returnflag) GROUP BY l_suppkey
    """,
)
def weighted_sum(spark, d):
    parts = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        total().alias("n"), F.avg("l_extendedprice").alias("avg_price")
    )
    return parts.groupBy("l_suppkey").agg(rounded(F.sum(F.col("n") * F.col("avg_price")), 2).alias("total_price"))
