"""Versioned tables, loads with a reject channel, bitmaps and SQL functions on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import catalog
from ledgerloom.operators import bitmaps
from ledgerloom.plans.registry import query, rounded, table, total
from ledgerloom.session import scratch_path
from ledgerloom.sources import readers
from ledgerloom.sources.versioned import VersionedTable


@query(
    "versioned_merge",
    """
    WITH before AS (SELECT o_orderkey, year(o_orderdate) AS order_year, o_orderstatus AS status, o_totalprice AS price FROM orders),
    after AS (SELECT o_orderkey, order_year, CASE WHEN order_year = 1997 AND status = 'F' THEN 'X' ELSE status END AS status,
        CASE WHEN order_year = 1997 AND status = 'F' THEN 0.0 ELSE price END AS price FROM before
      UNION ALL SELECT -o_orderkey, 1990, 'N', 1.0 FROM before WHERE order_year = 1997 AND status = 'P')
    SELECT 1 AS version, CAST(order_year AS BIGINT) AS order_year, status, count(*) AS n_orders, round(sum(price), 2) AS price FROM before GROUP BY 2, 3
    UNION ALL SELECT 2, order_year, status, count(*), round(sum(price), 2) FROM after GROUP BY 2, 3
    """,
)
def versioned_merge(spark, d):
    """Both versions after a merge that hits one year and adds another; the older one is pinned."""
    stored = VersionedTable(spark, scratch_path(spark, "stored"))
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("order_year"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
    )
    first = stored.create(orders, by=["order_year"])
    late = orders.filter("order_year = 1997")
    fresh = late.filter("status = 'P'").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit(1990).alias("order_year"), F.lit("N").alias("status"), F.lit(1.0).alias("price"))
    changed = late.filter("status = 'F'").withColumns({"status": F.lit("X"), "price": F.lit(0.0)})
    second = stored.merge(changed.unionByName(fresh), ["order_year", "o_orderkey"])
    moved = {p for p in first.folders if first.folders[p] != second.folders[p]}
    if len(moved) > 1:
        raise AssertionError(f"{len(moved)} partitions were rewritten")
    counted = lambda m: stored.read(m.version).groupBy(F.col("order_year").cast("bigint").alias("order_year"), "status").agg(
        total().alias("n_orders"), rounded(F.sum("price")).alias("price")
    ).withColumn("version", F.lit(m.version))
    return counted(first).unionByName(counted(second))


@query(
    "staging_rejects",
    """
    WITH lines AS (SELECT *, CASE WHEN event_type = 'error' THEN 'type' WHEN event_type = 'view' AND user_id % 10 = 0 THEN 'fields'
      WHEN event_type NOT IN ('view', 'click', 'error', 'purchase') THEN 'domain' END AS reason FROM events)
    SELECT coalesce(reason, 'loaded') AS outcome, count(*) AS n_lines, sum(event_id) AS ids, (SELECT count(*) FROM lines) AS n_read
    FROM lines GROUP BY 1
    """,
)
def staging_rejects(spark, d):
    """Lines that are loaded and lines that are rejected, with the reason, add up to the lines read."""
    path = scratch_path(spark, "lines")
    events = table(spark, d, "events")
    text = F.concat_ws(
        ",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
        F.concat(F.lit('"'), F.when(F.col("event_type") == "error", F.lit("12,5x")).otherwise(F.col("value").cast("string")), F.lit('"')),
        F.col("event_type"),
    )
    # Errors hold no number but a separator between quotes; some lines are cut short.
    cut = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("value").cast("string"))
    events.select(F.when((F.col("event_type") == "view") & (F.col("user_id") % 10 == 0), cut).otherwise(text).alias("line")).write.text(path)
    lines = readers.numbered_lines(spark, path)
    types = {"event_id": "bigint", "user_id": "bigint", "value": "double", "event_type": "string"}
    loaded, rejected = readers.parse_lines(lines, types, domains={"event_type": ["view", "click", "error", "purchase"]})
    one = loaded.select(F.lit("loaded").alias("outcome"), "event_id")
    other = rejected.select(F.col("reason").alias("outcome"), F.substring_index("line", ",", 1).cast("bigint").alias("event_id"))
    n_read = spark.read.text(path).agg(total().alias("n")).scalar()
    return one.unionByName(other).groupBy("outcome").agg(total().alias("n_lines"), F.sum("event_id").alias("ids")).withColumn("n_read", n_read)


@query(
    "bitmap_rollup",
    """
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS n_parts FROM lineitem
    GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())
    """,
)
def bitmap_rollup(spark, d):
    """Distinct parts per two keys, per one, and in all: the rows are read once, coarser groups merge bitmaps."""
    keys = ["l_returnflag", "l_linestatus"]
    fine = bitmaps.distinct_bitmaps(table(spark, d, "lineitem"), keys, "l_partkey")
    out = None
    for by in (keys, keys[:1], []):
        counts = bitmaps.bitmap_counts(fine, by, "n_parts")
        counts = counts.select(*[(F.col(k) if k in by else F.lit(None).cast("string")).alias(k) for k in keys], "n_parts")
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "sql_scalar_function",
    """
    SELECT s_suppkey, (SELECT max(n_name) FROM nation WHERE n_nationkey = s_nationkey) AS nation,
      CASE WHEN s_acctbal < 0 THEN 'owing' ELSE 'paid' END AS state FROM supplier
    """,
)
def sql_scalar_function(spark, d):
    table(spark, d, "nation").createOrReplaceTempView("known_nation")
    table(spark, d, "supplier").createOrReplaceTempView("known_supplier")
    catalog.scalar_function(spark, "nation_of", {"k": "bigint"}, "string", "(SELECT max(n_name) FROM known_nation WHERE n_nationkey = k)")
    catalog.scalar_function(spark, "account_state", {"balance": "double"}, "string", "CASE WHEN balance < 0 THEN 'owing' ELSE 'paid' END")
    return spark.sql("SELECT s_suppkey, nation_of(s_nationkey) AS nation, account_state(s_acctbal) AS state FROM known_supplier")


@query(
    "sql_table_function",
    """
    SELECT 'one' AS asked, c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3
    UNION ALL SELECT 'segment', c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT 'all', c_custkey, c_acctbal FROM customer
    """,
)
def sql_table_function(spark, d):
    """Nullable parameters: a left-out one takes all rows."""
    table(spark, d, "customer").createOrReplaceTempView("known_customer")
    catalog.table_function(
        spark, "customers_of", {"segment": "string", "home": "bigint"}, {"c_custkey": "bigint", "c_acctbal": "double"},
        f"SELECT c_custkey, c_acctbal FROM known_customer WHERE {catalog.any_or('c_mktsegment', 'segment')} AND {catalog.any_or('c_nationkey', 'home')}",
    )
    return spark.sql("""
        SELECT 'one' AS asked, * FROM customers_of('BUILDING', 3) UNION ALL SELECT 'segment', * FROM customers_of('BUILDING')
        UNION ALL SELECT 'all', * FROM customers_of()
    """)
