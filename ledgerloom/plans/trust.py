"""Data quality, masking, row access and encryption."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import governance, quality
from ledgerloom.plans.registry import query, table, total


@query(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_unique(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _order_checks():
    return {
        "date_floor": F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"),
        "known_status": F.col("o_orderstatus").isin("F", "O"),
        "positive_price": F.col("o_totalprice") > 0,
    }


@query(
    "dq_check",
    """
    SELECT 'date_floor' AS check_name, count(*) FILTER (WHERE NOT o_orderdate >= TIMESTAMP '1996-01-01') AS n_failed FROM orders
    UNION ALL SELECT 'known_status', count(*) FILTER (WHERE NOT o_orderstatus IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'positive_price', count(*) FILTER (WHERE NOT o_totalprice > 0) FROM orders
    """,
)
def dq_check(spark, d):
    return quality.check_failures(table(spark, d, "orders"), _order_checks())


@query(
    "dq_foreign_key",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)",
)
def dq_foreign_key(spark, d):
    parts = table(spark, d, "part").filter("p_size > 5")
    return quality.missing_parents(table(spark, d, "lineitem"), parts, "l_partkey", "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    "dq_quarantine",
    """
    WITH c AS (SELECT o_orderkey, o_custkey, CASE WHEN NOT o_orderdate >= TIMESTAMP '1996-01-01' THEN 'date_floor'
        WHEN NOT o_orderstatus IN ('F', 'O') THEN 'known_status' WHEN NOT o_totalprice > 0 THEN 'positive_price' END AS failed FROM orders),
    f AS (SELECT o_custkey AS k, min(o_orderkey) AS first_key FROM c WHERE failed IS NULL GROUP BY 1)
    SELECT o_orderkey, o_custkey, coalesce(failed, CASE WHEN o_orderkey <> first_key THEN 'duplicate' END) AS reason
    FROM c LEFT JOIN f ON o_custkey = k
    """,
)
def dq_quarantine(spark, d):
    orders = table(spark, d, "orders")
    return quality.quarantine(orders, ["o_custkey"], ["o_orderkey"], _order_checks()).select("o_orderkey", "o_custkey", "reason")


def _people(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_nationkey",
        F.concat(F.lower(F.substring("c_mktsegment", 1, 3)), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )


@query(
    "mask_default",
    """
    SELECT c_custkey, 'xxxx' AS c_name, 0.0::DOUBLE AS c_acctbal,
           substr(lower(c_mktsegment), 1, 1) || 'XXX@XXXX.com' AS email FROM customer
    """,
)
def mask_default(spark, d):
    people = _people(spark, d).drop("c_nationkey")
    policy = {"c_name": governance.mask_default, "c_acctbal": governance.mask_default, "email": lambda c, _: governance.mask_email(c)}
    return governance.masked_view(people, policy, unmask=False)


@query(
    "mask_partial",
    """
    SELECT c_custkey, substr(c_name, 1, 2) || 'XXX' || right(c_name, 3) AS name,
           CASE WHEN length(c_mktsegment) > 8 THEN substr(c_mktsegment, 1, 4) || '-' || right(c_mktsegment, 4) ELSE '-' END AS segment
    FROM customer
    """,
)
def mask_partial(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        governance.mask_partial(F.col("c_name"), 2, "XXX", 3).alias("name"),
        governance.mask_partial(F.col("c_mktsegment"), 4, "-", 4).alias("segment"),
    )


@query(
    "mask_by_role",
    """
    SELECT 'analyst' AS role, 'xxxx' AS name, count(*) AS n_people FROM customer
    UNION ALL SELECT 'manager', c_name, count(*) FROM customer GROUP BY c_name
    """,
)
def mask_by_role(spark, d):
    people = _people(spark, d)
    policy = {"c_name": governance.mask_default}
    seen = lambda role, unmask: (
        governance.masked_view(people, policy, unmask).groupBy(F.lit(role).alias("role"), F.col("c_name").alias("name"))
        .agg(total().alias("n_people"))
    )
    return seen("analyst", False).union(seen("manager", True))


def _grants(spark, d):
    """A user per region, with the region's nations as grants."""
    return table(spark, d, "nation").select(
        F.concat(F.lit("user"), F.col("n_regionkey").cast("string")).alias("user_name"), F.col("n_nationkey").alias("granted_key")
    )


@query(
    "row_filter",
    """
    SELECT 'user2' AS reader, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2
    UNION ALL SELECT 'manager', c_custkey FROM customer
    """,
)
def row_filter(spark, d):
    customer, grants = table(spark, d, "customer"), _grants(spark, d)
    view = lambda name, **who: governance.visible_rows(customer, grants, key="c_nationkey", **who).select(
        F.lit(name).alias("reader"), "c_custkey"
    )
    return view("user2", user="user2").union(view("manager", user="boss", manager=True)).union(view("nobody", user=None))


@query(
    "row_block",
    "SELECT c_custkey, n_regionkey = 1 AS allowed FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def row_block(spark, d):
    return governance.split_writes(table(spark, d, "customer"), _grants(spark, d), "user1", "c_nationkey").select(
        "c_custkey", "allowed"
    )


@query(
    "encrypt_roundtrip",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, true AS hidden FROM customer",
)
def encrypt_roundtrip(spark, d):
    # The key only has to be the same on both sides here; real keys come from the caller.
    key = F.unhex(F.sha2(F.lit("roundtrip"), 256))
    plain = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", F.col("c_name").alias("original"))
    secret = governance.encrypt(plain, ["c_name", "c_nationkey"], key).withColumn("hidden", F.col("c_name") != F.col("original"))
    return governance.decrypt(secret, ["c_name", "c_nationkey"], key).drop("original")
