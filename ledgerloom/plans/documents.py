"""JSON in text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import documents as js
from ledgerloom.functions import variants
from ledgerloom.operators.nesting import children_as_json
from ledgerloom.plans.registry import query, rounded, table, total
from ledgerloom.session import scratch_path


def _order_docs(spark, d):
    """A document per order: nested customer, contact list, reasons."""
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    info = F.struct(
        F.struct(F.col("c_name").alias("Name"), F.col("c_nationkey").alias("Nation")).alias("Customer"),
        F.array(F.col("c_mktsegment"), F.col("o_orderpriority")).alias("Tags"),
        F.col("o_orderstatus").alias("Status"),
    )
    reasons = F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>")).otherwise(
        F.array("c_mktsegment", "o_orderpriority")
    )
    phones = F.array(
        F.struct(F.col("o_custkey").cast("string").alias("Number"), F.lit("home").alias("Kind")),
        F.struct((F.col("o_custkey") + 1).cast("string").alias("Number"), F.lit("work").alias("Kind")),
    )
    return orders.select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "c_nationkey",
        F.to_json(info).alias("info"), F.to_json(reasons).alias("reasons"), F.to_json(phones).alias("phones"),
    )


@query(
    "json_value",
    """
    SELECT o_orderkey, c_name AS name, c_nationkey::VARCHAR AS nation, c_mktsegment AS tag0, NULL::VARCHAR AS object_is_null
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def json_value(spark, d):
    info = F.col("info")
    return _order_docs(spark, d).select(
        "o_orderkey",
        js.json_value(info, "$.Customer.Name").alias("name"),
        js.json_value(info, "$.Customer.Nation").alias("nation"),
        js.json_value(info, "$.Tags[0]").alias("tag0"),
        js.json_value(info, "$.Customer").alias("object_is_null"),
    )


@query(
    "json_query",
    """
    SELECT o_orderkey, '{"Name":"' || c_name || '","Nation":' || c_nationkey || '}' AS customer,
           '["' || c_mktsegment || '","' || o_orderpriority || '"]' AS tags, NULL::VARCHAR AS scalar_is_null
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def json_query(spark, d):
    info = F.col("info")
    return _order_docs(spark, d).select(
        "o_orderkey",
        js.json_query(info, "$.Customer").alias("customer"),
        js.json_query(info, "$.Tags").alias("tags"),
        js.json_query(info, "$.Status").alias("scalar_is_null"),
    )


@query(
    "is_json",
    """
    SELECT event_type, sum(1)::BIGINT AS n_docs, 0::BIGINT AS n_scalars, 0::BIGINT AS n_text FROM events
    WHERE json_type(props) = 'OBJECT' GROUP BY 1
    """,
)
def is_json(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        F.sum(js.is_json(F.col("props"))).alias("n_docs"),
        F.sum(js.is_json(F.get_json_object("props", "$.k"))).alias("n_scalars"),
        F.sum(js.is_json(F.col("event_type"))).alias("n_text"),
    )


@query(
    "json_each_object",
    """
    SELECT key, value, count(*) AS n_events FROM (
      SELECT unnest(json_keys(props)) AS key, json_extract_string(props, '$.k') AS value FROM events) GROUP BY 1, 2
    """,
)
def json_each_object(spark, d):
    return js.each_member(table(spark, d, "events").select("props"), "props").groupBy("key", "value").agg(total().alias("n_events"))


@query(
    "json_each_array",
    """
    SELECT o_orderkey, 0 AS i, c_mktsegment AS value FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT o_orderkey, 1, o_orderpriority FROM orders
    """,
)
def json_each_array(spark, d):
    return js.each_element(_order_docs(spark, d).select("o_orderkey", "info"), "info", "$.Tags").select("o_orderkey", "i", "value")


@query(
    "json_typed",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double, NULL::VARCHAR AS missing FROM events
    """,
)
def json_typed(spark, d):
    fields = {"k": ("int", "$.k"), "k_double": ("double", "$.k"), "missing": ("string", "$.a.b")}
    return js.typed_object(table(spark, d, "events").select("event_id", "props"), "props", fields).drop("props")


@query(
    "json_typed_array",
    """
    SELECT o_orderkey, o_custkey::VARCHAR AS "Number", 'home' AS "Kind" FROM orders
    UNION ALL SELECT o_orderkey, (o_custkey + 1)::VARCHAR, 'work' FROM orders
    """,
)
def json_typed_array(spark, d):
    return js.typed_array(_order_docs(spark, d).select("o_orderkey", "phones"), "phones", "Number string, Kind string").drop("phones")


@query(
    "json_search",
    """
    SELECT 'phone' AS found_by, o_orderkey FROM orders WHERE o_custkey = 7 OR o_custkey + 1 = 7
    UNION ALL SELECT 'work phone', o_orderkey FROM orders WHERE o_custkey + 1 = 7
    UNION ALL SELECT 'reason', o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus <> 'P' AND (c_mktsegment = '1-URGENT' OR o_orderpriority = '1-URGENT')
    """,
)
def json_search(spark, d):
    docs = _order_docs(spark, d)
    phone = "struct<Number:string,Kind:string>"
    searches = {
        "phone": js.has_element(F.col("phones"), phone, lambda p: p["Number"] == "7"),
        "work phone": js.has_element(F.col("phones"), phone, lambda p: (p["Number"] == "7") & (p["Kind"] == "work")),
        "reason": js.has_element(F.col("reasons"), "string", lambda r: r == "1-URGENT"),
    }
    # One pass: every row says which searches found it.
    names = [F.when(test, F.lit(name)) for name, test in searches.items()]
    return docs.select("o_orderkey", F.explode(F.array_compact(F.array(*names))).alias("found_by"))


@query(
    "json_report",
    """
    SELECT c_name AS customer, o_orderstatus AS status, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 4 AND o_orderdate > TIMESTAMP '1996-01-01'
    GROUP BY 1, 2 HAVING sum(o_totalprice) > 1000
    """,
)
def json_report(spark, d):
    docs = _order_docs(spark, d).filter(
        (js.json_value(F.col("info"), "$.Customer.Nation") == "4") & (F.col("o_orderdate") > F.expr("TIMESTAMP_NTZ '1996-01-01'"))
    )
    return (
        docs.groupBy(js.json_value(F.col("info"), "$.Customer.Name").alias("customer"), F.col("o_orderstatus").alias("status"))
        .agg(F.sum("o_totalprice").alias("s")).filter("s > 1000").select("customer", "status", rounded("s").alias("total"))
    )


@query(
    "variant_report",
    """
    SELECT c_nationkey::VARCHAR AS nation, o_orderstatus AS status, c_mktsegment AS tag, count(*) AS n_docs, count(DISTINCT c_name) AS n_names,
      2 * count(*) AS n_tags, '["' || c_mktsegment || '","' || min(o_orderpriority) || '"]' AS first_tags, 0::BIGINT AS n_objects
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
    """,
)
def variant_report(spark, d):
    """Documents parsed and stored once; six paths of them are read."""
    docs = variants.stored(_order_docs(spark, d).select("o_orderkey", "info"), "info", "doc", scratch_path(spark, "variants"))
    doc = F.col("doc")
    read = docs.select(
        variants.value_at(doc, "$.Customer.Nation").alias("nation"), variants.value_at(doc, "$.Status").alias("status"),
        variants.value_at(doc, "$.Tags[0]").alias("tag"), variants.value_at(doc, "$.Customer.Name").alias("name"),
        F.size(F.try_variant_get(doc, "$.Tags", "array<string>")).alias("n"), variants.fragment_at(doc, "$.Tags").alias("tags"),
        variants.value_at(doc, "$.Customer").alias("object"),
    )
    return read.groupBy("nation", "status", "tag").agg(
        total().alias("n_docs"), F.count_distinct("name").alias("n_names"), F.sum("n").alias("n_tags"), F.min("tags").alias("first_tags"),
        F.count("object").alias("n_objects"),
    )


@query(
    "json_reason_report",
    """
    SELECT reason, count(*) AS n_orders FROM (
      SELECT unnest([c_mktsegment, o_orderpriority]) AS reason FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus <> 'P' AND c_nationkey = 4) GROUP BY 1
    """,
)
def json_reason_report(spark, d):
    docs = _order_docs(spark, d).filter(js.json_value(F.col("info"), "$.Customer.Nation") == "4")
    return js.each_element(docs.select("o_orderkey", "reasons"), "reasons", value="reason").groupBy("reason").agg(
        total().alias("n_orders")
    )


@query(
    "term_search",
    r"""
    SELECT doc_id, lang FROM (SELECT doc_id, lang, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS w FROM documents)
    WHERE (list_contains(w, 'nation') OR list_contains(w, 'hash') OR list_contains(w, 'er'))
      AND list_contains(w, 'the')
    """,
)
def term_search(spark, d):
    hit = js.contains_terms(F.col("text"), any_of=["Nation", "hash", "er"], all_of=["the"])
    return table(spark, d, "documents").filter(hit).select("doc_id", "lang")


@query(
    "json_computed",
    """
    SELECT k, count(*) AS n_events FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    WHERE k >= 50 GROUP BY 1
    """,
)
def json_computed(spark, d):
    events = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.filter("k >= 50").groupBy("k").agg(total().alias("n_events"))


@query(
    "json_denormalize",
    """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
    SELECT l_orderkey, (rn - 1) // 3 AS page_no, '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_partkey":'
      || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}', ',' ORDER BY rn) || ']' AS items FROM n GROUP BY 1, 2
    """,
)
def json_denormalize(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return children_as_json(lines, "l_orderkey", order, ["l_linenumber", "l_partkey", "l_returnflag"], page=3)
