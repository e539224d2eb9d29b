"""Sources, sinks and table changes on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.aggregates import latest_snapshot
from ledgerloom.operators.changes import delete_cascade, delete_where, merge_upsert, partial_update, update_from, update_where
from ledgerloom.plans.registry import day, query, rounded, table, total
from ledgerloom.session import scratch_path
from ledgerloom.sources import readers, writers


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark, d):
    return readers.read_table(spark, f"{d}/customer.parquet")


@query("csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    table(spark, d, "supplier").write.option("header", True).csv(path)
    return readers.read_delimited(spark, path)


@query(
    "external_delimited",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 1000",
)
def external_delimited(spark, d):
    path = scratch_path(spark, "pipe")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    table(spark, d, "orders").select(*columns).write.option("sep", "|").csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string"
    return readers.read_delimited(spark, path, schema, sep="|", header=False).filter("o_totalprice > 1000")


@query("bulk_load_tab", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def bulk_load_tab(spark, d):
    path = scratch_path(spark, "tab")
    table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("sep", "\t").option(
        "header", True
    ).csv(path)
    return readers.read_delimited(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double", sep="\t")


@query("load_count_check", "SELECT l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY l_returnflag")
def load_count_check(spark, d):
    source = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    loaded = writers.create_table_as(source, scratch_path(spark, "load"))
    return readers.check_row_count(loaded, source.count()).groupBy("l_returnflag").agg(total().alias("n_rows"))


@query(
    "staging_clean",
    """
    SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, event_type
    FROM events
    """,
)
def staging_clean(spark, d):
    path = scratch_path(spark, "stage")
    events = table(spark, d, "events")
    quoted = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    text = events.select(
        F.concat_ws(
            ",", F.col("event_id").cast("string"), quoted("user_id"),
            F.when(F.col("event_type") == "error", "M").otherwise(quoted("value")), quoted("event_type"),
        ).alias("line")
    )
    text.write.text(path)
    staged = readers.read_staged_text(spark, path, ["event_id", "user_id", "value", "event_type"], header=False)
    return readers.clean_staged(
        staged, {"event_id": "bigint", "user_id": "bigint", "value": "double", "event_type": "string"}
    )


@query("ctas", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def ctas(spark, d):
    finished = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    return writers.create_table_as(finished, scratch_path(spark, "ctas"))


@query("schema_clone", "SELECT * FROM supplier WHERE s_acctbal > 0")
def schema_clone(spark, d):
    supplier = table(spark, d, "supplier")
    clone = readers.empty_like(supplier)
    return clone.unionByName(writers.conform(supplier.filter("s_acctbal > 0"), clone.schema))


@query(
    "insert_select",
    """
    SELECT l_linestatus, l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 2) AS quantity
    FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_linestatus, l_returnflag
    """,
)
def insert_select(spark, d):
    path = scratch_path(spark, "append")
    lines = table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", "l_quantity")
    target = writers.create_table_as(lines.filter("l_returnflag = 'A'"), path)
    full = writers.insert_select(lines.filter("l_returnflag = 'R'"), path, target.schema)
    return full.groupBy("l_linestatus", "l_returnflag").agg(
        total().alias("n_rows"), rounded(F.sum("l_quantity")).alias("quantity")
    )


@query(
    "inline_values",
    """
    SELECT p.priority, p.weight, count(*) AS n_orders
    FROM orders JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 3), ('3-MEDIUM', 2), ('5-LOW', 1)) AS p(priority, weight)
      ON o_orderpriority = p.priority GROUP BY p.priority, p.weight
    """,
)
def inline_values(spark, d):
    weights = spark.createDataFrame(
        [("1-URGENT", 5), ("2-HIGH", 3), ("3-MEDIUM", 2), ("5-LOW", 1)], "priority string, weight int"
    )
    counts = table(spark, d, "orders").groupBy("o_orderpriority").agg(total().alias("n_orders"))
    return counts.join(weights, F.col("o_orderpriority") == F.col("priority")).select("priority", "weight", "n_orders")


@query(
    "generate_rows",
    """
    WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
    days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
    SELECT strftime(d, '%Y-%m-%d') AS day, count(o_orderkey) AS n_orders
    FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d
    """,
)
def generate_rows(spark, d):
    orders = table(spark, d, "orders")
    counts = orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(total().alias("n"))
    return (
        readers.daily_calendar(orders, "o_orderdate", "cal").join(counts, F.col("cal") == F.col("d"), "left")
        .select(day("cal").alias("day"), F.coalesce("n", F.lit(0)).alias("n_orders"))
    )


@query(
    "dynamic_overwrite",
    """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year,
           CASE WHEN year(o_orderdate) = 1997 THEN 'X' ELSE o_orderstatus END AS status, count(*) AS n_orders
    FROM orders GROUP BY 1, 2
    """,
)
def dynamic_overwrite(spark, d):
    path = scratch_path(spark, "bypart")
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("order_year")
    )
    writers.overwrite_partitions(orders, path, ["order_year"])
    changed = orders.filter("order_year = 1997").withColumn("status", F.lit("X"))
    writers.publish_if_any(changed, lambda stage: writers.overwrite_partitions(stage, path, ["order_year"]))
    return (
        spark.read.parquet(path).groupBy(F.col("order_year").cast("bigint").alias("order_year"), "status")
        .agg(total().alias("n_orders"))
    )


@query(
    "conform_schema",
    """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_mktsegment,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer
    """,
)
def conform_schema(spark, d):
    target = T.StructType(
        [
            T.StructField("c_custkey", T.IntegerType()),
            T.StructField("c_phone", T.StringType()),
            T.StructField("c_mktsegment", T.StringType()),
            T.StructField("c_nationkey", T.StringType()),
        ]
    )
    return writers.conform(table(spark, d, "customer"), target)


@query(
    "merge_upsert",
    """
    WITH src AS (
      SELECT o_custkey AS c_custkey, round(sum(o_totalprice), 2) AS c_acctbal FROM orders
      WHERE o_orderstatus = 'F' GROUP BY o_custkey
      UNION ALL
      SELECT o_custkey + 1000000000, round(sum(o_totalprice), 2) FROM orders
      WHERE o_orderstatus = 'P' GROUP BY o_custkey)
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal
    FROM customer t FULL JOIN src s ON t.c_custkey = s.c_custkey
    """,
)
def merge_into(spark, d):
    orders = table(spark, d, "orders")
    spent = lambda status, key: (
        orders.filter(F.col("o_orderstatus") == status).groupBy(key.alias("c_custkey"))
        .agg(rounded(F.sum("o_totalprice")).alias("c_acctbal"))
    )
    source = spent("F", F.col("o_custkey")).unionByName(spent("P", F.col("o_custkey") + F.lit(1000000000)))
    target = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return merge_upsert(target, source, ["c_custkey"])


@query(
    "update_where",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment FROM customer
    """,
)
def update_rows(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return update_where(customer, F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0), "c_mktsegment": F.lit("REVIEW")})


@query(
    "update_from",
    """
    SELECT c_custkey, CASE WHEN s.k IS NOT NULL THEN s.top ELSE c_acctbal END AS c_acctbal FROM customer
    LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) AS top FROM orders GROUP BY o_custkey) s ON c_custkey = s.k
    """,
)
def update_join(spark, d):
    top = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"))
    return update_from(
        table(spark, d, "customer").select("c_custkey", "c_acctbal"), top, ["c_custkey"], {"c_acctbal": "top"}
    )


@query(
    "partial_update",
    """
    SELECT c_custkey, c_name, CASE WHEN c_nationkey = 7 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_nationkey = 7 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer
    """,
)
def update_given(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    given = {"c_name": None, "c_mktsegment": "MOVED", "c_acctbal": None}
    return partial_update(customer, F.col("c_nationkey") == 7, given, overwrite=["c_acctbal"]).drop("c_nationkey")


@query(
    "delete_where",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_quantity > 25)",
)
def delete_rows(spark, d):
    gone = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)
    return delete_where(table(spark, d, "lineitem"), gone).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "delete_cascade",
    """
    SELECT o_orderpriority, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority
    """,
)
def delete_parents(spark, d):
    orders, lines = delete_cascade(
        table(spark, d, "orders"), table(spark, d, "lineitem"), "o_orderkey", "l_orderkey", F.col("o_orderstatus") == "P"
    )
    per_order = lines.groupBy("l_orderkey").agg(total().alias("n"))
    return (
        orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderpriority")
        .agg(F.count("o_orderkey").alias("n_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
    )


@query(
    "latest_snapshot",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderstatus FROM (
      SELECT *, max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY date_trunc('month', o_orderdate)) AS last_day FROM orders)
    WHERE CAST(o_orderdate AS DATE) = last_day
    """,
)
def latest_in_month(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    last = latest_snapshot(orders, F.to_date("o_orderdate"), F.trunc("o_orderdate", "month"))
    return last.select("o_orderkey", day("o_orderdate").alias("order_day"), "o_orderstatus")


@query("table_snapshot", "SELECT c_custkey, c_acctbal FROM customer")
def table_snapshot(spark, d):
    root = scratch_path(spark, "versions")
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    writers.write_version(customer, root, 1)
    writers.write_version(customer.withColumn("c_acctbal", F.lit(0.0)), root, 2)
    return writers.read_version(spark, root, 1)


@query("load_audit", "SELECT 'orders-1' AS load_id, count(*) AS n_rows FROM orders")
def load_audit(spark, d):
    root = scratch_path(spark, "audit")
    audit = writers.append_with_audit(
        table(spark, d, "orders").select("o_orderkey", "o_totalprice"), f"{root}/data", f"{root}/log", "orders-1"
    )
    return audit.select("load_id", "n_rows")


@query(
    "json_export",
    """
    SELECT o_orderkey, to_json({'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority,
           'info': {'cust': o_custkey, 'status': o_orderstatus}}) AS doc FROM orders
    """,
)
def json_export(spark, d):
    orders = table(spark, d, "orders").withColumn(
        "info", F.to_json(F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")))
    )
    out = writers.rows_to_json(orders, ["o_orderkey", "o_orderpriority", "info"], fragments=["info"])
    return out.select("o_orderkey", F.col("doc").cast("string").alias("doc"))


@query(
    "json_import",
    """
    SELECT k, count(*) AS n_events FROM (
      SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY k
    """,
)
def json_import(spark, d):
    rows = readers.from_json_text(table(spark, d, "events"), "props", "k int")
    return rows.groupBy("k").agg(total().alias("n_events"))


@query(
    "order_generator",
    """
    WITH keys AS (SELECT l_orderkey AS seed_key, row_number() OVER (ORDER BY l_orderkey) - 1 AS rn FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
    h AS (SELECT order_id, copy, seed_key FROM (
        SELECT o_orderkey * 20 + copy AS order_id, copy, (o_orderkey * 7919 + copy * 104729) % (SELECT count(*) FROM keys) AS rn
        FROM (SELECT o_orderkey, unnest(range(20)) AS copy FROM orders)) JOIN keys USING (rn))
    SELECT copy, count(DISTINCT order_id) AS n_orders, count(*) AS n_lines, round(sum(l_quantity), 1) AS quantity
    FROM h JOIN lineitem ON l_orderkey = seed_key GROUP BY copy
    """,
)
def order_generator(spark, d):
    details = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    new_lines = readers.generate_orders(table(spark, d, "orders"), details, "o_orderkey", "l_orderkey", copies=20, seed="seed")
    # Lines of one new order share its header, so orders can be counted before lines are summed; they share its seed, too.
    per_order = new_lines.groupBy("seed", "order_id", "copy").agg(total().alias("n"), F.sum("l_quantity").alias("q"))
    return per_order.groupBy("copy").agg(
        total().alias("n_orders"), F.sum("n").alias("n_lines"), rounded(F.sum("q"), 1).alias("quantity")
    )
