"""Execution-log analytics; an event stands for one execution of its user's query."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.operators import workload
from ledgerloom.plans.registry import query, table, ts

NOW = datetime(2024, 1, 20, 12)

LOG = """
    WITH log AS (SELECT event_id AS execution_id, user_id AS query_id,
      CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS plan_id, ts AS started, value AS duration,
      CASE WHEN event_type = 'error' THEN 'failed' ELSE 'regular' END AS outcome FROM events)
"""
RECENT = LOG + f""", recent AS (SELECT * FROM log WHERE started >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR
    AND started <= TIMESTAMP '{NOW}' AND outcome = 'regular'),
    top AS (SELECT query_id, round(sum(duration), 2) AS total_duration, count(DISTINCT plan_id) AS n_plans FROM recent
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25)
"""
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def execution_log(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("execution_id"),
        F.col("user_id").alias("query_id"),
        (F.get_json_object("props", "$.k").cast("int") % 5).alias("plan_id"),
        F.col("ts").alias("started"),
        F.col("value").alias("duration"),
        F.when(F.col("event_type") == "error", "failed").otherwise("regular").alias("outcome"),
    )


@query(
    "log_last_n",
    LOG + f"SELECT execution_id, query_id, plan_id, strftime(started, {STAMP}) AS started FROM log ORDER BY log.started DESC, execution_id DESC LIMIT 10",
)
def log_last_n(spark, d):
    return workload.last_executions(execution_log(spark, d)).select(
        "execution_id", "query_id", "plan_id", ts("started").alias("started")
    )


@query("log_exec_count", LOG + "SELECT query_id, count(*) AS n_executions FROM log GROUP BY 1")
def log_exec_count(spark, d):
    return workload.execution_counts(execution_log(spark, d)).orderBy(F.col("n_executions").desc(), "query_id")


@query(
    "log_multi_plan",
    LOG + f"""
    SELECT l.query_id, plan_id, n_plans, count(*) AS n_executions, strftime(max(started), {STAMP}) AS last_started FROM log l
    JOIN (SELECT query_id, count(DISTINCT plan_id) AS n_plans FROM log GROUP BY 1 HAVING count(DISTINCT plan_id) > 1) m
      ON l.query_id = m.query_id GROUP BY 1, 2, 3
    """,
)
def log_multi_plan(spark, d):
    return workload.multi_plan_queries(execution_log(spark, d)).withColumn("last_started", ts("last_started"))


@query("log_top_duration", RECENT + "SELECT * FROM top")
def log_top_duration(spark, d):
    return workload.top_by_duration(execution_log(spark, d), NOW, hours=24)


@query(
    "log_top_multi",
    RECENT + f"""
    SELECT r.query_id, plan_id, strftime(date_trunc('hour', started), {STAMP}) AS interval_start, count(*) AS n_executions,
           round(avg(duration), 8) AS avg_duration, total_duration
    FROM recent r JOIN top ON r.query_id = top.query_id WHERE n_plans > 1 GROUP BY 1, 2, 3, total_duration
    """,
)
def log_top_multi(spark, d):
    out = workload.top_multi_plan(execution_log(spark, d), NOW, hours=24)
    return out.withColumns({"interval_start": ts("interval_start"), "avg_duration": F.round("avg_duration", 8)})


@query(
    "event_lookup",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE user_id = (SELECT min(user_id) FROM events WHERE json_extract_string(props, '$.k') = '69')
    """,
)
def event_lookup(spark, d):
    events = table(spark, d, "events").withColumn("tracking", F.get_json_object("props", "$.k"))
    return workload.events_for_tracking(events, "user_id", "tracking", "69").select("event_id", "user_id", "event_type")
