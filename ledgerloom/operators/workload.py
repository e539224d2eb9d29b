"""Analytics over an execution log: (query_id, plan_id, started, duration, outcome)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import top_n


def last_executions(log: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest executions."""
    return top_n(log, n, F.col("started").desc(), F.col("execution_id").desc())


def execution_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_executions"))


def multi_plan_queries(log: DataFrame) -> DataFrame:
    """Queries run under more than one plan: one row per query and plan with its last run."""
    plans = log.groupBy("query_id", "plan_id").agg(
        F.count(F.lit(1)).alias("n_executions"), F.max("started").alias("last_started")
    )
    # ``plans`` holds one row per distinct plan, so counting its rows counts plans.
    several = plans.groupBy(F.col("query_id").alias("__q")).agg(F.count("plan_id").alias("n_plans")).filter("n_plans > 1")
    return plans.join(several, F.col("query_id") == F.col("__q")).select(
        "query_id", "plan_id", "n_plans", "n_executions", "last_started"
    )


def _recent(log: DataFrame, now: datetime, hours: int) -> DataFrame:
    start = now - timedelta(hours=hours)
    return log.filter(
        (F.col("started") >= F.lit(str(start)).cast("timestamp_ntz"))
        & (F.col("started") <= F.lit(str(now)).cast("timestamp_ntz"))
        & (F.col("outcome") == "regular")
    )


def top_by_duration(log: DataFrame, now: datetime, hours: int = 1, n: int = 25) -> DataFrame:
    """The ``n`` queries with the longest total duration of regular runs in the last hours."""
    totals = _recent(log, now, hours).groupBy("query_id").agg(
        F.round(F.sum("duration"), 2).alias("total_duration"), F.countDistinct("plan_id").alias("n_plans")
    )
    return top_n(totals, n, F.col("total_duration").desc(), F.col("query_id"))


def top_multi_plan(log: DataFrame, now: datetime, hours: int = 1, n: int = 25) -> DataFrame:
    """Those of the top ``n`` that used several plans, with the mean duration per plan and interval."""
    top = top_by_duration(log, now, hours, n).filter("n_plans > 1").select(F.col("query_id").alias("__q"), "total_duration")
    parts = _recent(log, now, hours).groupBy("query_id", "plan_id", F.date_trunc("hour", "started").alias("interval_start")).agg(
        F.count(F.lit(1)).alias("n_executions"), F.avg("duration").alias("avg_duration")
    )
    return parts.join(top, F.col("query_id") == F.col("__q")).drop("__q")


def events_for_tracking(events: DataFrame, key: str, tracking: str, wanted: str) -> DataFrame:
    """All events of the key that a tracking number belongs to (the lowest key if several)."""
    owner = events.filter(F.col(tracking) == F.lit(wanted)).agg(F.min(key).alias("k"))
    return events.filter(F.col(key) == owner.scalar())
