"""System-versioned tables: periods on orders, and a history built from the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import temporal
from ledgerloom.plans.registry import query, table, total, ts

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
AS_OF = "1998-06-15 00:00:00"
FROM_AT, TO_AT = "1997-01-01 00:00:00", "1998-12-31 00:00:00"

ORDER_VERSIONS = """
    WITH h AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS vf,
      CASE o_orderstatus WHEN 'F' THEN o_orderdate + INTERVAL 90 DAY WHEN 'P' THEN o_orderdate + INTERVAL 30 DAY
      ELSE TIMESTAMP '9999-12-31' END AS vt FROM orders)
"""

EVENT_VERSIONS = """
    WITH led AS (SELECT *, ts AS vf, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31') AS vt
      FROM events), h AS (SELECT * FROM led WHERE vf < vt AND event_type <> 'error')
"""


def order_versions(spark, d):
    """Each order is valid from its date until it is closed, by its status."""
    start = F.col("o_orderdate")
    end = (
        F.when(F.col("o_orderstatus") == "F", start + F.expr("interval 90 day"))
        .when(F.col("o_orderstatus") == "P", start + F.expr("interval 30 day"))
        .otherwise(temporal.open_end())
    )
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", start.alias("valid_from"), end.alias("valid_to")
    )


def event_versions(spark, d):
    """A user's state: an event opens a version, the user's next event closes it, an error deletes it."""
    events = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return temporal.build_history(events, ["user_id"], "ts", "event_id", deleted=F.col("event_type") == "error")


@query("temporal_as_of", ORDER_VERSIONS + f"SELECT o_orderkey, o_custkey FROM h WHERE vf <= TIMESTAMP '{AS_OF}' AND vt > TIMESTAMP '{AS_OF}'")
def temporal_as_of(spark, d):
    return temporal.as_of(order_versions(spark, d), AS_OF).select("o_orderkey", "o_custkey")


@query(
    "temporal_all",
    EVENT_VERSIONS + f"SELECT event_id, user_id, strftime(vf, {STAMP}) AS valid_from, CASE WHEN year(vt) = 9999 THEN 1 ELSE 0 END AS is_current FROM h",
)
def temporal_all(spark, d):
    return temporal.all_versions(event_versions(spark, d)).select(
        "event_id", "user_id", ts("valid_from").alias("valid_from"), "is_current"
    )


@query("temporal_between", ORDER_VERSIONS + f"SELECT o_orderkey FROM h WHERE vf <= TIMESTAMP '{TO_AT}' AND vt > TIMESTAMP '{FROM_AT}'")
def temporal_between(spark, d):
    return temporal.between(order_versions(spark, d), FROM_AT, TO_AT).select("o_orderkey")


@query("temporal_contained", ORDER_VERSIONS + f"SELECT o_orderkey FROM h WHERE vf >= TIMESTAMP '{FROM_AT}' AND vt <= TIMESTAMP '{TO_AT}'")
def temporal_contained(spark, d):
    return temporal.contained_in(order_versions(spark, d), FROM_AT, TO_AT).select("o_orderkey")


@query(
    "temporal_apply",
    EVENT_VERSIONS + f"SELECT event_id, user_id, event_type, value, strftime(vf, {STAMP}) AS valid_from, strftime(vt, {STAMP}) AS valid_to FROM h",
)
def temporal_apply(spark, d):
    return event_versions(spark, d).select(
        "event_id", "user_id", "event_type", "value", ts("valid_from").alias("valid_from"), ts("valid_to").alias("valid_to")
    )


@query(
    "temporal_diff",
    EVENT_VERSIONS + """
    SELECT user_id, event_type FROM h WHERE year(vt) = 9999 EXCEPT
    SELECT user_id, event_type FROM h WHERE vf <= TIMESTAMP '2024-01-15' AND vt > TIMESTAMP '2024-01-15'
    """,
)
def temporal_diff(spark, d):
    return temporal.changed_since(event_versions(spark, d), "2024-01-15", ["user_id", "event_type"])


@query(
    "temporal_recover",
    EVENT_VERSIONS + """
    SELECT user_id, arg_max(event_id, vt) AS event_id, arg_max(event_type, vt) AS event_type FROM h
    GROUP BY user_id HAVING max(year(vt)) < 9999
    """,
)
def temporal_recover(spark, d):
    return temporal.recover_deleted(event_versions(spark, d), ["user_id"], ["user_id", "event_id", "event_type"])


@query(
    "temporal_init",
    f"""
    SELECT c_custkey, strftime(TIMESTAMP '2024-02-01' - INTERVAL 1 SECOND, {STAMP}) AS valid_from,
           strftime(TIMESTAMP '9999-12-31', {STAMP}) AS valid_to FROM customer
    """,
)
def temporal_init(spark, d):
    return temporal.start_versioning(table(spark, d, "customer"), "2024-02-01 00:00:00").select(
        "c_custkey", ts("valid_from").alias("valid_from"), ts("valid_to").alias("valid_to")
    )


@query(
    "temporal_evolve",
    ORDER_VERSIONS + "SELECT CASE WHEN year(vt) = 9999 THEN 1 ELSE 0 END AS is_current, count(*) AS n_versions, count(NULL) AS n_notes FROM h GROUP BY 1",
)
def temporal_evolve(spark, d):
    wider = temporal.add_column(order_versions(spark, d), "note", "string")
    narrower = temporal.drop_column(wider, "o_orderstatus")
    return temporal.all_versions(narrower).groupBy("is_current").agg(
        total().alias("n_versions"), F.count("note").alias("n_notes")
    )


@query(
    "temporal_join",
    ORDER_VERSIONS + f""",
    lines AS (SELECT l_orderkey, l_shipdate AS lf, CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 60 DAY
      ELSE TIMESTAMP '9999-12-31' END AS lt FROM lineitem)
    SELECT o_orderstatus, count(*) AS n_lines FROM h JOIN lines ON o_orderkey = l_orderkey
    WHERE vf <= TIMESTAMP '{AS_OF}' AND vt > TIMESTAMP '{AS_OF}' AND lf <= TIMESTAMP '{AS_OF}' AND lt > TIMESTAMP '{AS_OF}' GROUP BY 1
    """,
)
def temporal_join(spark, d):
    shipped = F.col("l_shipdate")
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", shipped.alias("valid_from"),
        F.when(F.col("l_returnflag") == "R", shipped + F.expr("interval 60 day")).otherwise(temporal.open_end()).alias("valid_to"),
    )
    orders = temporal.as_of(order_versions(spark, d), AS_OF).select("o_orderkey", "o_orderstatus")
    return (
        orders.join(temporal.as_of(lines, AS_OF).select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderstatus").agg(total().alias("n_lines"))
    )


@query(
    "temporal_increment",
    f"""
    WITH newest AS (SELECT o_custkey AS k, o_orderdate AS cut, o_orderpriority AS p FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT c_custkey, c_mktsegment AS label, strftime(TIMESTAMP '1990-01-01' - INTERVAL 1 SECOND, {STAMP}) AS valid_from,
           strftime(coalesce(cut, TIMESTAMP '9999-12-31'), {STAMP}) AS valid_to FROM customer LEFT JOIN newest ON k = c_custkey
    UNION ALL SELECT k, p, strftime(cut, {STAMP}), strftime(TIMESTAMP '9999-12-31', {STAMP}) FROM newest
    """,
)
def temporal_increment(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("label"))
    history = temporal.start_versioning(customer, "1990-01-01 00:00:00")
    batch = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("at"), F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("label")
    )
    return temporal.apply_changes(history, batch, ["c_custkey"], "at").select(
        "c_custkey", "label", ts("valid_from").alias("valid_from"), ts("valid_to").alias("valid_to")
    )
