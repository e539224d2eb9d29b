"""Text, date, cast and XML functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import documents, scalars
from ledgerloom.plans.registry import day, query, table, total


@query(
    "str_slice",
    """
    SELECT c_custkey, substr(c_name, 1, 4) AS head, CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) END AS rest,
           CAST(length(c_mktsegment) AS INTEGER) AS n_chars FROM customer
    """,
)
def str_slice(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.substring("c_name", 1, 4).alias("head"),
        scalars.without_prefix(F.col("c_name"), "Customer#").alias("rest"),
        F.length("c_mktsegment").alias("n_chars"),
    )


@query(
    "str_clean",
    """
    SELECT p_partkey, trim(replace('  ' || p_name || ' ', 'bolt', 'BOLT')) AS name, lower(p_brand) AS brand,
           repeat('*', p_size) AS stars FROM part
    """,
)
def str_clean(spark, d):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, d, "part").select(
        "p_partkey",
        F.trim(F.replace(padded, F.lit("bolt"), F.lit("BOLT"))).alias("name"),
        F.lower("p_brand").alias("brand"),
        F.repeat(F.lit("*"), F.col("p_size")).alias("stars"),
    )


@query(
    "split_wrap",
    """
    SELECT p_partkey, CAST(split_part(p_size || '|' || (p_size + 1) || '|' || (p_size + 2), '|', CAST(p_partkey % 3 AS INTEGER) + 1) AS DOUBLE)
      AS value FROM part
    """,
)
def split_wrap(spark, d):
    size = F.col("p_size")
    packed = F.concat_ws("|", *[(size + i).cast("string") for i in range(3)])
    return table(spark, d, "part").select("p_partkey", scalars.packed_value(packed, F.col("p_partkey"), size=3).alias("value"))


@query(
    "date_format",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS ym, strftime(o_orderdate, '%Y-%m-%d') AS iso,
           strftime(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS parsed FROM orders
    """,
)
def date_format(spark, d):
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMM").alias("ym"),
        day("o_orderdate").alias("iso"),
        day(F.to_date(compact, "yyyyMMdd")).alias("parsed"),
    )


@query(
    "month_bounds",
    """
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day,
           strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m-%d') AS prior_end FROM orders
    """,
)
def month_bounds(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        day(scalars.month_start(F.col("o_orderdate"))).alias("first_day"),
        day(scalars.prior_month_end(F.col("o_orderdate"))).alias("prior_end"),
    )


@query(
    "ym_to_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders
    """,
)
def ym_to_date(spark, d):
    # Half of the rows come as yyyyMM, half as yyyyMMdd.
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMM")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    return table(spark, d, "orders").select("o_orderkey", day(scalars.year_month_to_date(mixed)).alias("d"))


@query(
    "months_between",
    """
    SELECT o_orderkey, round((year(o_orderdate) - 1996) * 12 + month(o_orderdate) - 3
      + CASE WHEN day(o_orderdate) = 1 THEN 0 ELSE (day(o_orderdate) - 1) / 31.0 END, 6) AS months FROM orders
    """,
)
def months_between(spark, d):
    months = scalars.months_since_model_year(F.to_date("o_orderdate"), F.lit(1996))
    return table(spark, d, "orders").select("o_orderkey", F.round(months, 6).alias("months"))


@query(
    "date_shift",
    """
    SELECT o_orderkey, strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS plus_days,
           strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m-%d') AS plus_months,
           strftime(o_orderdate - INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M') AS minus_minutes FROM orders
    """,
)
def date_shift(spark, d):
    when = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day(F.date_add(F.to_date(when), 10)).alias("plus_days"),
        day(F.add_months(F.to_date(when), 2)).alias("plus_months"),
        F.date_format(when - F.expr("interval 90 minute"), "yyyy-MM-dd HH:mm").alias("minus_minutes"),
    )


@query(
    "add_business_days",
    """
    WITH s AS (SELECT o_orderkey, o_orderdate::DATE AS d, CAST(o_orderkey % 23 AS INTEGER) AS n FROM orders),
    days AS (SELECT d, n, o_orderkey, d + CAST(i AS INTEGER) AS c FROM s, range(0, 40) AS r(i)),
    ranked AS (SELECT o_orderkey, n, d, c, count(*) FILTER (WHERE c > d AND isodow(c) < 6) OVER (PARTITION BY o_orderkey ORDER BY c) AS k FROM days)
    SELECT o_orderkey, strftime(CASE WHEN n = 0 THEN CASE WHEN isodow(d) > 5 THEN d - CAST(isodow(d) - 5 AS INTEGER) ELSE d END
      ELSE min(c) FILTER (WHERE k = n) END, '%Y-%m-%d') AS due FROM ranked GROUP BY o_orderkey, n, d
    """,
)
def add_business_days(spark, d):
    due = scalars.add_business_days(F.to_date("o_orderdate"), (F.col("o_orderkey") % 23).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", day(due).alias("due"))


@query(
    "cast_safe",
    """
    SELECT o_orderkey, CAST(round(o_totalprice, 0) AS BIGINT) AS whole, CAST(NULL AS INTEGER) AS bad,
           TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS cust FROM orders
    """,
)
def cast_safe(spark, d):
    text = F.when(F.col("o_orderstatus") == "F", "x").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.round("o_totalprice", 0).cast("bigint").alias("whole"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
        text.try_cast("int").alias("cust"),
    )


@query(
    "hierarchy_level",
    """
    SELECT c_custkey, '/' || n_regionkey || '/' || c_nationkey || '/' || CASE WHEN c_acctbal > 0 THEN c_custkey || '/' ELSE '' END AS path,
           CASE WHEN c_acctbal > 0 THEN 3 ELSE 2 END AS level FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def hierarchy_level(spark, d):
    customer = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    text = lambda c: F.col(c).cast("string")
    leaf = F.when(F.col("c_acctbal") > 0, F.concat(text("c_custkey"), F.lit("/"))).otherwise("")
    path = F.concat(F.lit("/"), text("n_regionkey"), F.lit("/"), text("c_nationkey"), F.lit("/"), leaf)
    return customer.select("c_custkey", path.alias("path"), scalars.path_level(path).alias("level"))


def _person_xml():
    """An XML person per customer; the optional element is missing for some, the last name for others."""
    key = F.col("c_custkey").cast("string")
    element = lambda tag, value: F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
    middle = F.when(F.col("c_acctbal") > 0, element("MiddleName", F.col("c_mktsegment"))).otherwise("")
    last = F.when(F.col("c_nationkey") != 3, element("LastName", key)).otherwise("")
    return F.concat(F.lit("<Person>"), element("FirstName", F.col("c_name")), middle, last, F.lit("</Person>"))


@query(
    "xml_shred",
    """
    SELECT c_custkey, c_name AS FirstName, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS MiddleName,
           CASE WHEN c_nationkey <> 3 THEN CAST(c_custkey AS VARCHAR) END AS LastName FROM customer
    """,
)
def xml_shred(spark, d):
    people = table(spark, d, "customer").select("c_custkey", _person_xml().alias("doc"))
    return documents.shred_xml(people, "doc", "FirstName string, MiddleName string, LastName string").drop("doc")


@query(
    "xml_validate",
    "SELECT CASE WHEN c_nationkey <> 3 THEN 1 ELSE 0 END AS valid, count(*) AS n_people FROM customer GROUP BY 1",
)
def xml_validate(spark, d):
    people = table(spark, d, "customer").select(_person_xml().alias("doc"))
    schema = "FirstName string, MiddleName string, LastName string"
    valid = documents.xml_has(F.col("doc"), schema, ["FirstName", "LastName"])
    return people.groupBy(valid.alias("valid")).agg(total().alias("n_people"))
